"""Repeated ids, versions and upserts.

Version picks are ``row_number() = 1`` windows, of which Spark takes one row per
key in every map task already; guards are aggregates that are combined
map-side. Either way a key holding a third of all rows costs a row per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

C = F.col


def _conflict_aggs(cols):
    aggs = []
    for c in cols:
        aggs += [
            F.count(C(c)).alias(f"_nn_{c}"),
            F.min(C(c)).alias(f"_lo_{c}"),
            F.max(C(c)).alias(f"_hi_{c}"),
        ]
    return aggs


def _differs(c: str) -> F.Column:
    """Not exactly one distinct non-missing value: all missing, or min != max."""
    return (C(f"_nn_{c}") == 0) | (C(f"_lo_{c}") != C(f"_hi_{c}"))


def order_conflicts(df: DataFrame, key: str = "order_id", exclude=()) -> DataFrame:
    """Ids whose rows disagree in some other column.

    Per column, "exactly one distinct non-missing value" is tested as
    ``count(c) > 0 and min(c) = max(c)``: an all-missing column conflicts,
    one missing and one value does not. Min/max/count are algebraic, so no
    per-column distinct expansion is needed.
    """
    cols = [c for c in df.columns if c != key and c not in exclude]
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"), *_conflict_aggs(cols))
    flags = [F.when(_differs(c), F.lit(c)) for c in cols]
    any_diff = reduce(lambda a, b: a | b, [_differs(c) for c in cols])
    return g.where((C("row_count") > 1) & any_diff).select(
        key, "row_count", F.concat_ws(",", *flags).alias("conflict_columns")
    )


def dedup_strict(df: DataFrame, ordinal: str, key: str = "order_id") -> DataFrame:
    """Collapse repeated ids whose rows agree; fail naming an id whose rows differ (H1).

    Guard and de-duplication are one aggregation. The survivor is the whole
    first row by ``ordinal`` (file order), also where a later row has a value that the first
    lacks. Missing ids skip the test but collapse to one row, as in the reference.
    """
    cols = [c for c in df.columns if c not in (key, ordinal)]
    first = F.min_by(F.struct(*[C(c) for c in cols]), C(ordinal)).alias("_first")
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *_conflict_aggs(cols), first)
    conflict = (C("_rows") > 1) & C(key).isNotNull() & reduce(lambda a, b: a | b, [_differs(c) for c in cols])
    guard = F.when(
        conflict, F.raise_error(F.concat(F.lit("Rows of one id differ: "), C(key).cast("string")))
    ).otherwise(F.lit(True))
    return g.where(guard).select(key, *[C(f"_first.{c}").alias(c) for c in cols])


def latest_by(df: DataFrame, key, order_cols, keep_order_cols: bool = True) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_cols``.

    ``row_number() = 1``: Spark plans a group limit of one row per key below
    the shuffle, so a hot key sends a row per map task. Version keys must be
    unique within a key for a defined result.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_cols = list(order_cols)
    payload = [c for c in df.columns if c not in keys and (keep_order_cols or c not in order_cols)]
    newest = W.partitionBy(*keys).orderBy(*[C(c).desc() for c in order_cols])
    picked = df.withColumn("_rank", F.row_number().over(newest)).where(C("_rank") == 1)
    return picked.select(*keys, *payload)


def latest_order_version(df: DataFrame, key: str = "order_id",
                         version=("ingestion_date", "row_index")) -> DataFrame:
    """Latest version of each order inside a batch: by ingestion version,
    then line ordinal (H2). Only cleaned rows should be passed in, so an
    invalid late correction never beats a valid earlier version."""
    return latest_by(df, key, version)


def upsert(state: DataFrame, new: DataFrame, key: str = "order_id",
           version=("ingestion_date",), drop_cols=()) -> DataFrame:
    """Stack state and new rows, keep the latest version per key; at equal
    version the new row wins (H3). Idempotent: replaying the same batch gives
    the same table."""
    s = state.withColumn("_is_new", F.lit(0))
    n = new.withColumn("_is_new", F.lit(1))
    stacked = s.unionByName(n, allowMissingColumns=True)
    out = latest_by(stacked, key, list(version) + ["_is_new"], keep_order_cols=True).drop("_is_new")
    return out.drop(*drop_cols) if drop_cols else out


def customer_upsert(current: DataFrame, updates: DataFrame, key: str = "customer_id",
                    ordinal: str | None = None) -> DataFrame:
    """Updates stacked after the current table, last row per customer wins,
    even when the new segment is blank (H4). ``ordinal`` orders rows inside
    the update file."""
    cur = current.withColumn("_src", F.lit(0))
    upd = updates.withColumn("_src", F.lit(1))
    order = ["_src"] + ([ordinal] if ordinal else [])
    if ordinal and ordinal not in current.columns:
        cur = cur.withColumn(ordinal, F.lit(None).cast(dict(updates.dtypes)[ordinal]))
    out = latest_by(cur.unionByName(upd), key, order).drop("_src")
    return out.drop(ordinal) if ordinal else out


def repeated_key_count(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows that repeat an earlier key: rows - distinct keys."""
    return df.agg(
        (F.count(F.lit(1)) - F.count_distinct(C(key))
         - F.coalesce(F.max(F.when(C(key).isNull(), F.lit(1)).otherwise(F.lit(0))), F.lit(0))).alias("repeated")
    )
