"""Dimension joins.

Join strategy is left to the planner: a dimension is broadcast only when its
estimated size at plan time is below ``spark.sql.autoBroadcastJoinThreshold``
(kept small by ``revlens.session``) or its measured size under AQE is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise the join is a
shuffled sort-merge join, whose skewed fact partitions AQE can split. No
``broadcast()`` hint is put on a table whose size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.scalar import UNKNOWN

C = F.col


def _on(fact: DataFrame, dim: DataFrame, keys, null_safe: bool):
    cond = None
    for k in keys:
        term = fact[k].eqNullSafe(dim[k]) if null_safe else fact[k] == dim[k]
        cond = term if cond is None else cond & term
    return cond


def left_join(fact: DataFrame, dim: DataFrame, keys, null_safe: bool = True) -> DataFrame:
    """Left outer equi-join keeping one copy of the key columns.

    ``null_safe`` matches a missing key with a missing key, as the reference
    does; Spark plans ``<=>`` as a hash/sort-merge join on
    ``(coalesce(k, default), isnull(k))``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    joined = fact.join(dim, _on(fact, dim, keys, null_safe), "left")
    dim_cols = [dim[c] for c in dim.columns if c not in keys]
    return joined.select(*[fact[c] for c in fact.columns], *dim_cols)


def join_products(sales: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """J3 enrichment: left join to products, then fill name/category with
    ``UNKNOWN`` and cost with 0 (D1 + C4).

    The fill also covers blanks of *matched* products and runs before numeric
    coercion, so a blank cost becomes 0 while a non-numeric cost is dropped
    later. Repeated product keys multiply rows, as in the reference.
    """
    joined = left_join(sales, products, key)
    return joined.withColumns(
        {
            "product_name": F.coalesce(C("product_name"), F.lit(UNKNOWN)),
            "category": F.coalesce(C("category"), F.lit(UNKNOWN)),
            "unit_cost": F.coalesce(C("unit_cost").cast("string"), F.lit("0")),
        }
    )


def key_conflicts(dim: DataFrame, keys, count_name: str = "key_count") -> DataFrame:
    """Keys that occur more than once (two missing keys count as a repeat)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(C(count_name) > 1)


def _null_safe(c: F.Column, kind: str) -> list[F.Column]:
    """A key as the pair that a null-safe join compares: value (with a stand-in
    for a missing one) and whether it is missing."""
    stand_in = F.lit("") if kind == "string" else F.lit(0).cast(kind)
    return [F.coalesce(c, stand_in), c.isNull()]


def _unique_by_pair(dim: DataFrame, keys: list[str], what: str) -> DataFrame:
    """One row per key with the pairs ``_k<i>``, ``_n<i>``; a repeated key raises."""
    types = dict(dim.dtypes)
    attrs = [c for c in dim.columns if c not in keys]
    pairs = [x for i, k in enumerate(keys) for x in
             (p.alias(f"{n}{i}") for n, p in zip(("_k", "_n"), _null_safe(C(k), types[k]), strict=True))]
    shown = [F.when(C(f"_n{i}"), F.lit("NULL")).otherwise(C(f"_k{i}").cast("string")) for i in range(len(keys))]
    grouped = dim.select(*pairs, *attrs).groupBy(*[f"{n}{i}" for i in range(len(keys)) for n in ("_k", "_n")]).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.first(C(a), ignorenulls=False).alias(a) for a in attrs]
    )
    repeated = F.raise_error(F.concat(F.lit(f"Key conflict: repeated key in {what}: "), F.concat_ws(",", *shown)))
    return grouped.where(F.when(C("_rows") > 1, repeated).otherwise(F.lit(True))).drop("_rows")


def guarded_unique(dim: DataFrame, keys, what: str = "dimension") -> DataFrame:
    """The dimension with a uniqueness guard evaluated inside the plan.

    One aggregation by key (partial aggregation first, so a hot key costs one
    row per map task) carries every attribute; a repeated key raises when the
    join runs, with no separate validation job. String attributes make this
    a sort-based aggregate; its output is one row per key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    unique = _unique_by_pair(dim, keys, what)
    named = [F.when(~C(f"_n{i}"), C(f"_k{i}")).alias(k) for i, k in enumerate(keys)]
    return unique.select(*named, *[c for c in dim.columns if c not in keys])


def join_many_to_one(fact: DataFrame, dim: DataFrame, keys, what: str = "dimension") -> DataFrame:
    """Left join that fails when the right side repeats a key.

    The guard aggregates by the pairs that the null-safe join compares, so
    the join takes over its partitioning and the dimension is shuffled once."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    unique = _unique_by_pair(dim, keys, what)
    types = dict(dim.dtypes)
    same = [
        side == unique[f"{n}{i}"]
        for i, k in enumerate(keys)
        for n, side in zip(("_k", "_n"), _null_safe(fact[k].cast(types[k]), types[k]), strict=True)
    ]
    joined = fact.join(unique, same, "left")
    return joined.select(*[fact[c] for c in fact.columns], *[unique[c] for c in dim.columns if c not in keys])


def join_customers(orders: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """J5/J6 enrichment: orders left join customers, many-to-one checked."""
    return join_many_to_one(orders, customers.select(key, "segment"), key, "customers")


def refresh_segment(
    state: DataFrame, customers: DataFrame, key: str = "customer_id", clear_segment: bool = False
) -> DataFrame:
    """Slowly-changing dimension type 1: take each customer's current segment.

    Joined by customer (the reference's stated intent), not by row position.
    By default a missing new segment keeps the old one (the non-missing-wins
    rule of the reference's update step); ``clear_segment=True`` writes
    ``UNKNOWN`` instead.
    """
    cur = guarded_unique(
        customers.select(key, C("segment").alias("_new_segment"), F.lit(True).alias("_matched")), key, "customers"
    )
    joined = left_join(state, cur, key)
    if clear_segment:
        new = F.when(C("_matched"), F.coalesce(C("_new_segment"), F.lit(UNKNOWN))).otherwise(C("segment"))
    else:
        new = F.coalesce(C("_new_segment"), C("segment"))
    return joined.withColumn("segment", new).drop("_new_segment", "_matched")
