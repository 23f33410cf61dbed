"""Versioned Parquet snapshots for the incremental job.

Plain Parquet has no atomic replace, and a job must not overwrite a path it
is reading. So every write goes to a new folder ``<root>/v=<version>`` (the
streaming batch id) and becomes visible when ``_manifest/<version>.json`` is renamed into
place. That file names the folders of the whole current table, so a reader
opens one small file, however long the job lives. Readers of version ``b`` only look at versions
``< b``: a replayed batch never reads its own half-written output, and rewriting
``v=<b>`` is idempotent. A version without data is a commit too, so an
empty table differs from a missing one.

A *partitioned* table keeps only the parts a version rewrote; with ``append`` the
versions of a part add up instead of replacing each other.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.sources import hadoop_fs

WHOLE = ""  # the single part of a table without a part column
PART = "snapshot_part"


class SnapshotTable:
    """A table kept as versioned snapshots, optionally partitioned by one column."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, part_col: str | None = None,
                 append: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.part_col = part_col
        self.append = append

    def version_path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/_manifest/{version}.json"

    def versions(self, before: int | None = None) -> list[int]:
        """Committed versions, ascending."""
        names = (e.name for e in hadoop_fs.entries(self.spark, f"{self.root}/_manifest"))
        found = sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0].isdigit())
        return [v for v in found if before is None or v < before]

    def latest_version(self, before: int | None = None) -> int | None:
        return max(self.versions(before), default=None)

    def exists(self, before: int | None = None) -> bool:
        return self.latest_version(before) is not None

    def _parts(self, version: int | None) -> dict[str, list[int]]:
        """The versions that hold each part as of ``version``."""
        if version is None:
            return {}
        return json.loads(hadoop_fs.read_text(self.spark, self._manifest_path(version)))

    def empty(self) -> DataFrame:
        """Typed empty frame."""
        return self.spark.createDataFrame([], self.schema)

    def _folder(self, version: int, part: str) -> str:
        return self.version_path(version) + (f"/{PART}={part}" if self.part_col else "")

    def paths(self, before: int | None = None, parts: list[str] | None = None) -> list[str]:
        """Folders of the current table as of versions ``< before``."""
        current = self._parts(self.latest_version(before))
        wanted = current if parts is None else [p for p in parts if p in current]
        return [self._folder(v, p) for p in wanted for v in current[p]]

    def read(self, before: int | None = None, parts: list[str] | None = None) -> DataFrame:
        """Current table as of versions ``< before`` (all committed when None);
        ``parts`` reads only those parts of a partitioned table."""
        paths = self.paths(before, parts)
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.empty()

    def write(self, df: DataFrame | None, version: int, parts: list[str] | None = None) -> None:
        """Write ``df`` as ``v=<version>`` and commit it; None commits the table
        as it is. ``parts`` lists every part this version replaces, including
        parts that are now empty."""
        current = self._parts(self.latest_version(before=version))
        if df is not None:
            out = df.select(*[f.name for f in self.schema.fields])
            path = self.version_path(version)
            if self.part_col is None:
                out.write.option("partitionOverwriteMode", "static").mode("overwrite").parquet(path)
                current = {WHOLE: [version]}
            else:
                # The part value is kept inside the files as well, so a part
                # folder can be read on its own. The hint puts the rows of a part
                # together, a large one over several tasks, so that
                # there are few files a part and not one from every task.
                out.withColumn(PART, F.col(self.part_col)).hint("rebalance", PART).write.option(
                    "partitionOverwriteMode", "static"
                ).mode("overwrite").partitionBy(PART).parquet(path)
                prefix = f"{PART}="
                written = {
                    e.name[len(prefix):] for e in hadoop_fs.entries(self.spark, path) if e.name.startswith(prefix)
                }
                for p in written.union(parts or []):
                    kept = current.pop(p, []) if self.append else current.pop(p, [])[:0]
                    if kept or p in written:
                        current[p] = kept + [version] * (p in written)
        hadoop_fs.write_text(self.spark, self._manifest_path(version), json.dumps(current, sort_keys=True))

    def drop_superseded(self, keep: int = 2) -> None:
        """Delete folders that none of the last ``keep`` versions refers to."""
        committed = self.versions()
        kept, old = committed[-keep:], committed[:-keep]
        if not old:
            return
        used = {self._folder(v, p) for k in kept for p, vs in self._parts(k).items() for v in vs}
        for e in hadoop_fs.entries(self.spark, self.root):
            if not e.name.startswith("v=") or int(e.name[2:]) >= kept[0]:
                continue
            folder = f"{self.root}/{e.name}"
            if self.part_col is None:
                folders = [folder]
            else:
                folders = [f"{folder}/{x.name}" for x in hadoop_fs.entries(self.spark, folder) if x.is_dir]
            unused = [f for f in folders if f not in used]
            for f in [folder] if len(unused) == len(folders) else unused:
                hadoop_fs.delete(self.spark, f)
        for version in old:
            hadoop_fs.delete(self.spark, self._manifest_path(version))
