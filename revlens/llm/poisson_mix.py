"""Mixing sources to target weights by Poisson replication (DataFrame
functions only).

Every source class gets a repetition rate: target rows times its weight over
the sum of weights, divided by its rows. A document's number of copies is the
inverse of the Poisson distribution with that mean at a uniform number hashed
from seed, id and text, so a rerun or a retried task draws the same. Copies are
exploded and dealt out by a hash of (document, copy), then sorted by it inside
each partition: a global shuffle without a sampling pass.

Classes are the sources named in ``weights``; all other sources, and NULL,
form one more class with weight ``default_weight``. So the rates are at most
``len(weights) + 1`` rows and their broadcast has a fixed bound, however many
sources the data has.

Rates above ``MAX_STEP`` are drawn as sums of independent draws with smaller
means, which has the same distribution and does not underflow.

Defined results: NULL ids and texts take part (hashed as such); rows equal in
id and text draw the same count; empty tables give empty results; a class
with weight 0 vanishes; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import free_name, let

# Production weights: half of the rows from the first listed sources' classes,
# by a plain rule over the twenty source names.
WEIGHTS = {f"src{i}": 2.0 if i % 4 == 0 else 1.0 for i in range(20)}
DEFAULT_WEIGHT = 1.0
SEED = 20
MAX_STEP = 16.0
OTHER = "(other)"


def source_class(source: Column, weights: dict[str, float]) -> Column:
    return F.when(source.isin(*weights), source).otherwise(F.lit(OTHER))


def rates(
    docs: DataFrame,
    weights: dict[str, float],
    default_weight: float,
    source: str = "source",
    target_rows: int | None = None,
) -> DataFrame:
    """(cls, n, rate): one row per class that has documents."""
    weight = F.lit(float(default_weight))
    for name, w in weights.items():
        weight = F.when(F.col("cls") == name, F.lit(float(w))).otherwise(weight)
    counts = (
        docs.groupBy(source_class(F.col(source), weights).alias("cls"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("w", weight)
    )
    # a window over at most len(weights) + 1 rows
    every = W.partitionBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    target = F.sum("n").over(every) if target_rows is None else F.lit(int(target_rows))
    total_w = F.sum("w").over(every)
    rate = F.when(total_w > 0, target * F.col("w") / total_w / F.col("n")).otherwise(0.0)
    return counts.select("cls", "n", rate.alias("rate"))


def uniform(*parts: Column) -> Column:
    """A number inside (0, 1) from the first 52 bits of an MD5."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def poisson_inverse(u: Column, mean: Column) -> Column:
    """Least k with u <= P(X <= k), X Poisson with ``mean`` <= ``MAX_STEP``.

    The steps end where less than 2**-52 of the mass is left, below what ``u``
    can tell.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    p0 = F.exp(-mean)
    start = F.struct(p0.alias("p"), p0.alias("cdf"), F.lit(0).alias("k"))

    def step(a: Column, _: Column) -> Column:
        p = a["p"] * mean / (a["k"] + 1)
        return F.when(
            u > a["cdf"],
            F.struct(p.alias("p"), (a["cdf"] + p).alias("cdf"), (a["k"] + 1).alias("k")),
        ).otherwise(a)

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda a: a["k"])


def copies(key: Column, rate: Column, seed: int = SEED) -> Column:
    """Number of copies of the document with hash key ``key``."""
    draws = F.greatest(F.ceil(rate / MAX_STEP), F.lit(1)).cast("int")
    return let(
        F.struct(key.alias("key"), (rate / draws).alias("mean"), draws.alias("draws")),
        lambda d: F.aggregate(
            F.sequence(F.lit(1), d["draws"]),
            F.lit(0),
            lambda s, j: s
            + let(
                uniform(F.lit(str(seed)), d["key"], j.cast("string")),
                lambda u: F.when(d["mean"] > 0, poisson_inverse(u, d["mean"])).otherwise(0),
            ),
        ),
    )


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    default_weight: float = DEFAULT_WEIGHT,
    seed: int = SEED,
    target_rows: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    detail: bool = False,
) -> DataFrame:
    """``docs`` replicated to the target weights, in globally shuffled order.

    With ``detail`` the columns ``copy`` (from 1) and ``shuffle_key`` follow.
    """
    weights = WEIGHTS if weights is None else weights
    cls, rate, n, copy, order, ident = (
        free_name(docs, x) for x in ("__cls", "__rate", "__n", "copy", "shuffle_key", "__ident")
    )
    by_class = rates(docs, weights, default_weight, source, target_rows).select(
        F.col("cls").alias(cls), F.col("rate").alias(rate)
    )
    key = F.concat_ws(
        ":",
        F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")),
    )
    dealt = (
        docs.withColumn(cls, source_class(F.col(source), weights))
        .join(F.broadcast(by_class), cls)
        .withColumn(ident, key)
        .withColumn(n, copies(F.col(ident), F.col(rate), seed))
        .where(F.col(n) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
        .withColumn(order, F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("order"), F.col(ident), F.col(copy))))
    )
    columns = [F.col(c) for c in docs.columns] + ([F.col(copy), F.col(order)] if detail else [])
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, F.col(order)).sortWithinPartitions(order).select(*columns)
