"""Batch files in a drop folder.

File names carry the ingestion version: ``orders-YYYY-MM-DD-NNNN.csv``.
Zero padding makes lexical order equal arrival order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlens.sources import hadoop_fs
from revlens.sources.csv import by_header, describe_files, require_names, rows_of
from revlens.sources.records import FileFact

C = F.col

# Batch file name pattern (glob and exact form).
BATCH_GLOB = "orders-????-??-??-????.csv"
BATCH_NAME_REGEX = r"^orders-(\d{4})-(\d{2})-(\d{2})-(\d{4})\.csv$"


def batch_version(file_name: Column) -> Column:
    """``YYYY-MM-DD-NNNN`` from the file name; NULL if it does not parse (A4).

    A name that passes the glob but not this (``orders-abcd-...``) goes to
    quarantine in the incremental job.
    """
    return F.when(file_name.rlike(BATCH_NAME_REGEX), F.substring(file_name, len("orders-") + 1, len("YYYY-MM-DD-NNNN")))


def batch_day(version: Column) -> Column:
    """Batch day as DATE from a version string."""
    return F.to_date(F.substring(version, 1, 10), "yyyy-MM-dd")


def batch_seq(version: Column) -> Column:
    """Sequence number inside the day."""
    return F.substring(version, 12, 4).cast("int")


def archive_dir(file_name: Column) -> Column:
    """``YYYY/MM/DD`` folder of a batch file (A9, C9): split on ``-``,
    take parts 2-4, join with ``/``."""
    return F.concat_ws("/", F.slice(F.split(file_name, "-"), 2, 3))


def file_name(path: Column) -> Column:
    """Name of a file from its path (a URL, so ``%`` codes are read back)."""
    name = F.substring_index(path, "/", -1)
    return F.when(F.contains(name, F.lit("%")), F.url_decode(F.regexp_replace(name, r"\+", "%2B"))).otherwise(name)


def version_of(path: str) -> str | None:
    """Ingestion version of a batch file by its name, on the driver."""
    found = re.match(BATCH_NAME_REGEX, path.rsplit("/", 1)[-1])
    return "-".join(found.groups()) if found else None


def empty_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Names of the 0-byte files among ``paths`` (files, folders or patterns)."""
    found = []
    for path in paths:
        for e in hadoop_fs.glob(spark, path):
            listed = hadoop_fs.entries(spark, path) if e.is_dir else [e]
            found += [x.name for x in listed if not x.is_dir and x.length == 0 and x.name[0] not in "._"]
    return sorted(found)


def read_files(spark: SparkSession, files: list[FileFact], required=None) -> DataFrame:
    """Rows of batch files, columns matched by *name* (A6, HP-2).

    Files of one header are one scan; the scans are stacked by column name, so
    files with columns in another order line up. Nothing but the list
    of files, which Spark lists on the driver anyway, decides which scan a file
    is in: no line is shuffled or joined to its header. Short lines are padded
    with NULL, a line with more fields than its header fails the job, and
    missing-value markers become NULL. Adds ``file_path``, ``file_name``,
    ``ingestion_date`` (from the name) and ``line`` (split and place in it).
    """
    frames = []
    for columns, group in by_header(files).items():
        require_names(columns, required)
        rows = rows_of(spark, group, list(columns))
        name = file_name(C("file_path"))
        frames.append(
            rows.select(
                *columns,
                "file_path",
                name.alias("file_name"),
                batch_version(name).alias("ingestion_date"),
                F.struct("block", "pos").alias("line"),
            )
        )
    if not frames:
        cells = "".join(f"`{c}` string, " for c in required or ())
        schema = cells + "file_path string, file_name string, ingestion_date string, line struct<block:bigint,pos:bigint>"
        return spark.createDataFrame([], schema)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_batches(spark: SparkSession, paths: list[str], required=None) -> DataFrame:
    """Read many batch files; a 0-byte file among them is an error."""
    empty = empty_files(spark, paths)
    if empty:
        raise ValueError(f"No header line in: {', '.join(empty)}")
    return read_files(spark, describe_files(spark, paths), required)


def with_row_index(rows: DataFrame) -> DataFrame:
    """Adds ``row_index``, a row's number in its file from 0 (A5).

    A split counts its rows, the counts add up over the splits of the file, and only
    that table (a row per split) is joined to the rows. ``rows`` must come
    from :func:`read_files` unfiltered: places in a split are then consecutive.
    """
    splits = rows.groupBy("file_path", C("line.block").alias("block")).agg(
        F.min("line.pos").alias("low"), F.count(F.lit(1)).alias("n")
    )
    before = F.sum("n").over(W.partitionBy("file_path").orderBy("block")) - C("n")
    table = splits.select(C("file_path").alias("_path"), "block", (before - C("low")).alias("_shift"))
    same = (rows["file_path"] == table["_path"]) & (rows["line.block"] == table["block"])
    return rows.join(table, same).select(*rows.columns, (C("line.pos") + C("_shift")).alias("row_index"))
