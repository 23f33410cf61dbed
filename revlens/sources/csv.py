"""CSV scan, column checks and CSV sink."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.scalar import MISSING_MARKERS, normalize_missing
from revlens.sources.records import FileFact, assemble, file_facts, header_columns, read_lines

CORRUPT = "_corrupt"


class MissingColumnsError(ValueError):
    """A table lacks columns that a job needs."""


def require_columns(df: DataFrame, required) -> DataFrame:
    """Fail, listing the missing names, when a required column is absent.

    Extra columns pass. Resolved from the schema at plan time: no job runs.
    """
    require_names(df.columns, required)
    return df


def string_schema(columns: list[str], corrupt: bool = True) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def describe_files(spark: SparkSession, paths: list[str]) -> list[FileFact]:
    """Header of each file and whether its records span lines; raises for a
    missing path and for a file without a line."""
    try:
        facts = file_facts(read_lines(spark, paths))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"No file at: {', '.join(paths)}") from exc
        raise
    if not facts:
        raise ValueError(f"No header line in: {', '.join(paths)}")
    return facts


def scan_csv(
    spark: SparkSession,
    path: str,
    required=None,
    columns: list[str] | None = None,
    markers=MISSING_MARKERS,
) -> DataFrame:
    """Read a CSV with a header row, every column as text (A1).

    * missing path -> ``FileNotFoundError``; 0-byte file -> ``ValueError``;
    * header-only file -> 0 rows with the header's columns;
    * short row -> padded with NULL; row with too many fields -> the job fails;
    * a line end inside quotes is part of its field;
    * missing-value markers (``NA``, ``null``, empty, ...) -> NULL.

    Typing is left to the cleaning step (``try_cast``), so no schema
    inference pass over the data is needed; one pass looks for the header and for
    records that span lines. ``columns`` skips it when the caller
    knows the layout and that a record is a line.
    """
    if columns is not None:
        rows = rows_of(spark, [FileFact(path, ",".join(columns), False)], columns, markers)
        return rows.select(*require_names(columns, required))
    facts = describe_files(spark, [path])
    frames = []
    for columns, group in by_header(facts).items():
        require_names(columns, required)
        frames.append(rows_of(spark, group, list(columns), markers).select(*columns))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def require_names(columns, required):
    """``columns``, unless one of ``required`` is not among them."""
    missing = sorted(set(required or ()) - set(columns))
    if missing:
        raise MissingColumnsError(f"Missing columns: {missing}")
    return columns


def by_header(facts: list[FileFact]) -> dict[tuple[str, ...], list[FileFact]]:
    """Files grouped by their columns in order."""
    groups: dict[tuple[str, ...], list[FileFact]] = {}
    for f in facts:
        groups.setdefault(tuple(header_columns(f.header)), []).append(f)
    return groups


#: Where a row stands: file, split start and order in the split.
PLACE = ("file_path", "block", "pos")


def rows_of(spark: SparkSession, files: list[FileFact], columns: list[str], markers=MISSING_MARKERS) -> DataFrame:
    """Rows of files with one header, with their :data:`PLACE`."""
    plain = [f.path for f in files if not f.spans]
    spanning = [f.path for f in files if f.spans]
    frames = []
    if plain:
        raw = (
            spark.read.schema(string_schema(columns))
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("escape", '"')
            .csv(plain)
        )
        frames.append(reject_long_rows(raw.select(
            "*",
            F.col("_metadata.file_path").alias(PLACE[0]),
            F.col("_metadata.file_block_start").alias(PLACE[1]),
            F.monotonically_increasing_id().alias(PLACE[2]),
        ), columns, markers))
    if spanning:
        frames.append(_spanning_rows(spark, spanning, columns, markers))
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def _spanning_rows(spark: SparkSession, paths: list[str], columns: list[str], markers) -> DataFrame:
    """Rows of files whose records span lines: whole records parsed one by one."""
    records = assemble(read_lines(spark, paths)).where(F.col("value").rlike(r"\S"))
    first = records.groupBy("file_path").agg(F.min("record").alias("record"))
    body = records.join(first, ["file_path", "record"], "left_anti")
    probe = ", ".join(f"`f{i}` string" for i in range(len(columns) + 1))
    value = F.regexp_replace("value", "\r$", "")
    parsed = body.select(*PLACE, "value", F.from_csv(value, probe, {"escape": '"'}).alias("_f"))
    too_long = F.col(f"_f.f{len(columns)}").isNotNull()
    checked = parsed.where(F.when(too_long, _too_long("value")).otherwise(F.lit(True)))
    cells = [normalize_missing(F.col(f"_f.f{i}"), markers).alias(c) for i, c in enumerate(columns)]
    return checked.select(*cells, *PLACE)


def _too_long(line: str) -> F.Column:
    return F.raise_error(F.concat(F.lit("A line has too many fields for its header: "), F.col(line)))


def long_row_guard(columns: list[str]) -> F.Column:
    """Boolean that raises for a line with more fields than the header.

    The permissive parser flags both short and long lines in the corrupt
    column; re-parsing the flagged line with one extra field tells them apart.
    Used as a filter, which the optimizer cannot prune away.
    """
    probe = ", ".join(f"`f{i}` string" for i in range(len(columns) + 1))
    extra = F.from_csv(F.col(CORRUPT), probe, {"escape": '"'}).getField(f"f{len(columns)}")
    too_long = F.col(CORRUPT).isNotNull() & extra.isNotNull()
    # Spark refuses a CSV query that reads *only* the corrupt column (e.g. a
    # bare count), so the pass branch also reads the first data column.
    keep = F.length(F.coalesce(F.col(columns[0]), F.lit(""))) >= 0
    return F.when(too_long, _too_long(CORRUPT)).otherwise(keep)


def reject_long_rows(raw: DataFrame, columns: list[str], markers=MISSING_MARKERS) -> DataFrame:
    """Fail on a line with more fields than the header; keep short lines
    (padded with NULL); turn missing markers into NULL."""
    checked = raw.where(long_row_guard(columns))
    others = [c for c in raw.columns if c not in columns and c != CORRUPT]
    return checked.select(*[normalize_missing(F.col(c), markers).alias(c) for c in columns], *others)


def write_csv(df: DataFrame, path: str, order_by: list[str] | None = None, single_file: bool = False) -> None:
    """CSV sink with a header row.

    Small reports may ask for one ordered file (``single_file``); large
    outputs keep their partitioning and write in parallel.
    """
    out = df
    if order_by:
        out = out.orderBy(*order_by)
    if single_file:
        out = out.coalesce(1)
    (
        out.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode("overwrite")
        .csv(path)
    )
