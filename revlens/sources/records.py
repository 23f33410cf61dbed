"""CSV records that span lines, and what a reader must know of each file
(SURVEY A1, A6; HP-2).

Spark's CSV reader is splittable only if a record is a line. Whether a file
keeps to that is found in one pass over its lines: no line of it may leave a
quoted field open. Such files, the usual case, are read by Spark's reader. In
the others a line may start inside a quoted field, which depends on all lines
before it. Each line is a function from "starts inside quotes" to "ends inside quotes";
functions are composed over the lines of each split, and over the splits of
each file, which gives the state at every line without reading a file in one task.
"""

from __future__ import annotations

import csv
import io
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

C = F.col

# States of a CSV field while its characters are read.
_START, _PLAIN, _QUOTED, _QUOTE_SEEN = 0, 1, 2, 3


def ends_open(line: Column, inside: bool) -> Column:
    """Whether a line that starts inside (outside) a quoted field ends inside
    one. A quote opens a field only at its start, and a doubled one inside a
    quoted field is a character; both as CSV readers do."""
    marks = F.split(F.regexp_replace(line, '[^",]+', "x"), "")

    def step(state: Column, mark: Column) -> Column:
        quote = (
            F.when(state == _START, _QUOTED)
            .when(state == _QUOTED, _QUOTE_SEEN)
            .when(state == _QUOTE_SEEN, _QUOTED)
            .otherwise(_PLAIN)
        )
        other = F.when(mark == ",", _START).otherwise(_PLAIN)
        return F.when(mark == "", state).when(mark == '"', quote).when(state == _QUOTED, state).otherwise(other)

    state = F.aggregate(marks, F.lit(_QUOTED if inside else _START), step)
    return F.when(F.contains(line, F.lit('"')), state == _QUOTED).otherwise(F.lit(inside))


class FileFact(NamedTuple):
    path: str
    header: str  # the first record
    spans: bool  # some record may span lines


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with file path, split start and their order."""
    return with_place(spark.read.option("lineSep", "\n").text(paths))


def with_place(text: DataFrame) -> DataFrame:
    """Adds file path, split start and the order of lines (A5): taken right
    after the scan, before any shuffle, so it follows the lines of each split."""
    return text.select(
        "value",
        C("_metadata.file_path").alias("file_path"),
        C("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


def header_columns(header: str) -> list[str]:
    return [c.strip() for c in next(csv.reader(io.StringIO(header.rstrip("\r"))))]


def file_facts(lines: DataFrame) -> list[FileFact]:
    """One row per file: its header and whether its records span lines.
    Aggregated inside each task first; the list is as long as the file list."""
    order = F.struct("block", "pos")
    filled = C("value").rlike(r"\S")
    facts = lines.groupBy("file_path").agg(
        F.min_by(F.when(filled, C("value")), F.when(filled, order)).alias("header"),
        F.max(ends_open(C("value"), False)).alias("spans"),
    )
    # the metadata column holds URLs
    found = [FileFact(unquote(r["file_path"]), r["header"] or "", bool(r["spans"])) for r in facts.collect()]
    return sorted(found)


def _composed(lines: DataFrame) -> DataFrame:
    """Lines with the state before and after each, for either state at the
    start of its split. Partitions of the window are splits, so they are bounded."""
    outside, inside = ends_open(C("value"), False), ends_open(C("value"), True)
    upto = W.partitionBy("file_path", "block").orderBy("pos")
    flips = lines.withColumns({"_o": outside, "_i": inside}).withColumn(
        "_flips", F.sum((C("_o") & ~C("_i")).cast("int")).over(upto)
    )
    # the last line whose end does not depend on its start
    fixed = F.last(F.when(C("_o") == C("_i"), F.struct("_o", "_flips")), ignorenulls=True).over(upto)
    out = flips.withColumn("_fixed", fixed)
    odd = (C("_flips") - F.coalesce(C("_fixed._flips"), F.lit(0))) % 2 == 1

    def after(start: bool) -> Column:
        return F.coalesce(C("_fixed._o"), F.lit(start)) != odd

    out = out.withColumns({"after_out": after(False), "after_in": after(True)})
    return out.withColumns({
        "before_out": F.coalesce(F.lag("after_out").over(upto), F.lit(False)),
        "before_in": F.coalesce(F.lag("after_in").over(upto), F.lit(True)),
    }).withColumns({
        "starts_out": F.sum((~C("before_out")).cast("long")).over(upto),
        "starts_in": F.sum((~C("before_in")).cast("long")).over(upto),
    }).drop("_o", "_i", "_flips", "_fixed")


def _split_starts(composed: DataFrame) -> DataFrame:
    """(file_path, block, inside, records before) of every split: one pass
    over a file's splits, of which there is one per ``maxPartitionBytes``."""
    splits = composed.groupBy("file_path", "block").agg(
        F.max_by("after_out", "pos").alias("end_out"),
        F.max_by("after_in", "pos").alias("end_in"),
        F.max("starts_out").alias("n_out"),
        F.max("starts_in").alias("n_in"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("block", "end_out", "end_in", "n_out", "n_in")))
    empty = F.expr("cast(array() as array<struct<block:bigint,inside:boolean,before:bigint>>)")
    zero = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("long").alias("before"), empty.alias("out"))

    def step(acc: Column, s: Column) -> Column:
        here = F.struct(s["block"].alias("block"), acc["inside"].alias("inside"), acc["before"].alias("before"))
        return F.struct(
            F.when(acc["inside"], s["end_in"]).otherwise(s["end_out"]).alias("inside"),
            (acc["before"] + F.when(acc["inside"], s["n_in"]).otherwise(s["n_out"])).alias("before"),
            F.concat(acc["out"], F.array(here)).alias("out"),
        )

    def finish(acc: Column) -> Column:
        # a file that ends inside quotes has no last record
        return F.when(acc["inside"], F.raise_error(F.lit("A quoted field is open at the end of a file"))).otherwise(
            acc["out"]
        )

    folded = splits.groupBy("file_path").agg(F.aggregate(ordered, zero, step, finish).alias("s"))
    return folded.select("file_path", F.inline("s"))


def assemble(lines: DataFrame) -> DataFrame:
    """Records of files whose records span lines: (file_path, block, pos of
    the first line, record number in the file, value)."""
    composed = _composed(lines)
    starts = _split_starts(composed)
    placed = composed.join(starts, ["file_path", "block"])
    opens_inside = F.when(C("inside"), C("before_in")).otherwise(C("before_out"))
    ends_inside = F.when(C("inside"), C("after_in")).otherwise(C("after_out"))
    number = C("before") + F.when(C("inside"), C("starts_in")).otherwise(C("starts_out")) - 1
    numbered = placed.select(
        "file_path", "block", "pos", "value", number.alias("record"), (opens_inside | ends_inside).alias("part")
    )
    whole = numbered.where(~C("part")).drop("part")
    joined = numbered.where("part").groupBy("file_path", "record").agg(
        F.min(F.struct("block", "pos")).alias("at"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("block", "pos", "value"))), lambda s: s["value"]), "\n"
        ).alias("value"),
    )
    joined = joined.select("file_path", C("at.block").alias("block"), C("at.pos").alias("pos"), "value", "record")
    return whole.unionByName(joined)
