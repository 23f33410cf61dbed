"""Secret scan over an incremental blob ledger (DataFrame functions only).

Every version of every path is content-addressed by the SHA-256 of its text.
The ledger, a Parquet table in a shared folder, has a row for each scanned
blob with the rule versions it was scanned by and the raw matches. A run scans
only (blob, rule version) pairs that the ledger lacks, appends them, and joins
the findings back to all paths that hold the blob.

Defined results: NULL text counts as empty; an empty text has no finding; equal
texts, also repeated rows, share a blob, are scanned once and each path row
gets the findings; an empty table gives an empty result; columns other than
the named ones are ignored, so their names cannot clash. NULL path ids are
kept as rows. Raw matches are stored as lengths (gap before, match), from
which a running sum per blob and rule gives positions in code points, so long
texts with many matches stay linear.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a Java regex. A match counts if ``group`` of it has at
    least ``least`` characters. A changed pattern takes a new ``version``.
    Every match holds one of the literals ``hints`` (in lower case); a plain
    substring search for them spares most texts the regex."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base patterns of the contract (letters of the first
# one's keyword in either case).
BASE_RULES = (
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
        hints=("password", "passwd", "secret", "token", "api_key", "apikey"),
    ),
    # A run is taken whole, so the least length may stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{16,}", hints=("akia",)),
    Rule("hex", r"[0-9a-f]{24,}"),
)

# Public formats of private-key headers and service tokens.
EXTRA_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", hints=("-----begin",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", hints=("eyj",)),
)

RULES = BASE_RULES + EXTRA_RULES

LEDGER_SCHEMA = (
    "blob string, rules array<string>, "
    "raw array<struct<rule:string,nth:int,gap:int,len:int,ok:boolean>>"
)


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _may_match(text: Column, lowered: Column, rule: Rule) -> Column:
    if not rule.hints:
        return text.rlike(rule.pattern)
    return reduce(lambda a, b: a | b, [lowered.contains(h) for h in rule.hints])


def _raw_matches(text: Column, lowered: Column, rule: Rule) -> Column:
    """Array of (rule, nth, gap before it, length, counts) of all matches."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    least = F.transform(
        F.regexp_extract_all(text, pattern, F.lit(rule.group)),
        lambda g: F.length(g) >= rule.least,
    )
    rows = F.transform(
        F.arrays_zip(gaps.alias("gap"), sizes.alias("len"), least.alias("ok")),
        lambda z, i: F.struct(
            F.lit(rule.key).alias("rule"),
            i.alias("nth"),
            z["gap"].alias("gap"),
            z["len"].alias("len"),
            z["ok"].alias("ok"),
        ),
    )
    none = F.array().cast("array<struct<rule:string,nth:int,gap:int,len:int,ok:boolean>>")
    return F.when(
        _may_match(text, lowered, rule), F.filter(rows, lambda z: z["len"].isNotNull())
    ).otherwise(none)


def unseen(versions: DataFrame, text: str, ledger: DataFrame | None, rules=RULES) -> DataFrame:
    """Distinct blobs of ``versions`` with the rule versions still to run.

    ``dropDuplicates`` aggregates inside each map task first, so a text held
    by a third of all paths is moved once per task only.
    """
    keys = F.array(*[F.lit(r.key) for r in rules])
    blobs = versions.select(
        blob_id(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).dropDuplicates(["blob"])
    if ledger is None:
        return blobs.withColumn("todo", keys)
    seen = (
        ledger.select("blob", F.explode("rules").alias("rule"))
        .groupBy("blob")
        .agg(F.collect_set("rule").alias("seen"))
    )
    todo = F.array_except(keys, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    return (
        blobs.join(seen, "blob", "left")
        .select("blob", "text", todo.alias("todo"))
        .where(F.size("todo") > 0)
    )


def scan(pending: DataFrame, rules=RULES) -> DataFrame:
    """Ledger rows of the pending (blob, rule version) pairs."""
    none = F.array().cast("array<struct<rule:string,nth:int,gap:int,len:int,ok:boolean>>")
    raw = let(
        F.lower("text"),
        lambda low: F.concat(
            *[
                F.when(F.array_contains("todo", r.key), _raw_matches(F.col("text"), low, r)).otherwise(none)
                for r in rules
            ]
        ),
    )
    return pending.select("blob", F.col("todo").alias("rules"), raw.alias("raw"))


def read_ledger(spark, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def update_ledger(
    versions: DataFrame, text: str, path: str, rules=RULES, exists: bool = False
) -> DataFrame:
    """Scan what the ledger at ``path`` lacks, append it, return the ledger.

    ``exists`` says whether earlier runs have written it. Spark commits the
    appended files when all tasks are done; a run that failed leaves the
    ledger as it was, and its pairs stay unseen.
    """
    spark = versions.sparkSession
    ledger = read_ledger(spark, path) if exists else None
    scan(unseen(versions, text, ledger, rules), rules).write.mode("append").parquet(path)
    return read_ledger(spark, path)


def findings(ledger: DataFrame, rules=RULES) -> DataFrame:
    """(blob, kind, rank of the kind, start, end) of all findings by ``rules``."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    raw = ledger.where(F.size("raw") > 0).select("blob", F.inline("raw"))
    before = W.partitionBy("blob", "rule").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("len")).over(before)
    return (
        raw.withColumn("end", end)
        .where(F.col("ok"))
        .select(
            "blob",
            F.substring_index("rule", "@", 1).alias("kind"),
            order[F.col("rule")].alias("rank"),
            (F.col("end") - F.col("len")).alias("start"),
            "end",
        )
        .where(F.col("rank").isNotNull())
    )


def by_path(versions: DataFrame, keys: list[str], text: str, found: DataFrame) -> DataFrame:
    """Findings of every path row: ``keys``, ``blob``, ``hits`` (sorted by
    start, rank; an empty array if none). The join's left side holds ids and
    hashes only, and a hot blob's paths can be split."""
    per_blob = found.groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("hits")
    )
    paths = versions.select(*keys, blob_id(F.col(text)).alias("blob"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return paths.join(per_blob, "blob", "left").withColumn("hits", F.coalesce("hits", none))
