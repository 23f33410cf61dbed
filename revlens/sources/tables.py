"""Driver test tables (one Parquet file or folder per table)."""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

def read_table(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.parquet(path)``: each call lists the files anew, so files
    added to a table are read."""
    return spark.read.parquet(path)


class Tables:
    """Lazy handles on ``<sf_dir>/<name>.parquet``.

    Each attribute is a plain ``spark.read.parquet`` frame: column pruning and
    filter pushdown reach the Parquet scan through Catalyst.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, os.path.join(self.sf_dir, f"{name}.parquet"))

    @cached_property
    def region(self) -> DataFrame:
        return self.read("region")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")
