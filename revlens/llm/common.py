"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.sources import hadoop_fs

# White space between words wherever an operator's contract names
# [\x20\x09-\x0D].
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` through Spark's reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is ``spark.checkpoint.dir``. Where that is unset, a local session (as
    in tests) gets a fresh folder of its own; a cluster session raises, as a
    machine-local folder would lose rows there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="revlens-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: the rows outlive any executor, and later branches scan
    only the columns they need.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the folders of stored tables that nothing reads any more."""
    for table in tables:
        hadoop_fs.delete(table.sparkSession, table._stored_at)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    The optimizer may copy an expression into every place that uses it, also
    into a lambda that runs per element. A lambda's own variable is bound
    once, so a one-element ``transform`` keeps such a value from being
    computed again.
    """
    return F.transform(F.array(value), body)[0]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold(column: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; NULL for a NULL id."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(mod)


def local_fold(doc_id, mod: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % mod


def free_name(df: DataFrame, name: str) -> str:
    """``name``, prolonged until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
