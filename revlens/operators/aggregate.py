"""Aggregations.

Every grouped aggregate is a plain ``groupBy().agg()`` so Spark plans a
partial (map-side) aggregate before the shuffle: a key holding a third of
all rows costs one row per map task, not one overloaded reducer.
Grand totals are global aggregates, which always return one row, even on
empty input (grouping sets ``()`` would return none).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.scalar import round_half_even, safe_ratio

C = F.col

# Fixed value: label of subtotal / grand-total rows.
ALL = "ALL"


def _mean(value: str) -> F.Column:
    """Mean ignoring NULLs, as ``sum / count`` in double (NULL when no value)."""
    return F.try_divide(F.sum(C(value)).cast("double"), F.count(C(value)))


def _total(value: str) -> F.Column:
    """Sum with an empty / all-missing input giving 0, returned as double."""
    return F.coalesce(F.sum(C(value)), F.lit(0)).cast("double")


def filter_metrics(df: DataFrame, filters: dict[str, str], value: str = "revenue") -> DataFrame:
    """Count / sum / mean of the rows matching all equality filters.

    Always one row; the filter values are echoed as columns. No row passes ->
    ``count 0, sum 0.0, mean NULL``. The filter reaches the Parquet scan.
    """
    cond = reduce(lambda a, b: a & b, [C(k) == F.lit(v) for k, v in filters.items()])
    return df.where(cond).agg(
        *[F.lit(v).alias(k) for k, v in filters.items()],
        F.count(F.lit(1)).alias("sales_count"),
        _total(value).alias("total_revenue"),
        _mean(value).alias("average_revenue"),
    )


def group_metrics(df: DataFrame, keys=("region", "product"), value: str = "revenue", digits: int | None = 2) -> DataFrame:
    """GROUP BY keys: row count (missing values included), sum (missing -> 0),
    mean; rounded half-even; rows with a missing key dropped (E3 + C5)."""
    keys = list(keys)
    out = df.dropna(subset=keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sales_count"),
        _total(value).alias("total_revenue"),
        _mean(value).alias("average_revenue"),
    )
    if digits is None:
        return out
    return out.withColumns({c: round_half_even(C(c), digits) for c in ("total_revenue", "average_revenue")})


def line_metrics(df: DataFrame) -> DataFrame:
    """revenue, cost, profit per line."""
    return df.withColumns(
        {
            "revenue": C("quantity") * C("unit_price"),
            "cost": C("quantity") * C("unit_cost"),
        }
    ).withColumn("profit", C("revenue") - C("cost"))


def _profit_finish(df: DataFrame, digits: int, inf_margin: bool) -> DataFrame:
    rounded = df.withColumns(
        {c: round_half_even(C(c), digits) for c in ("total_revenue", "total_cost", "total_profit")}
    )
    # The margin is computed from the *rounded* sums, as in the reference.
    return rounded.withColumn(
        "profit_margin", safe_ratio(C("total_profit"), C("total_revenue"), digits, inf_margin)
    )


def profit_by_group(
    df: DataFrame, keys=("region", "category"), count_col: str = "order_id", digits: int = 2, inf_margin: bool = False
) -> DataFrame:
    """GROUP BY region, category: non-missing id count and three sums, rounded,
    then the margin (E4 + C5 + C6)."""
    keys = list(keys)
    agg = df.dropna(subset=keys).groupBy(*keys).agg(
        F.count(C(count_col)).alias("orders_count"),
        _total("revenue").alias("total_revenue"),
        _total("cost").alias("total_cost"),
        _total("profit").alias("total_profit"),
    )
    return _profit_finish(agg, digits, inf_margin).withColumn("is_total", F.lit(False))


def profit_total(df: DataFrame, keys=("region", "category"), digits: int = 2, inf_margin: bool = False) -> DataFrame:
    """Grand-total row ``ALL, ALL``: counts *rows* (missing keys included) and
    is emitted even for empty input (E5)."""
    agg = df.agg(
        *[F.lit(ALL).alias(k) for k in keys],
        F.count(F.lit(1)).alias("orders_count"),
        _total("revenue").alias("total_revenue"),
        _total("cost").alias("total_cost"),
        _total("profit").alias("total_profit"),
    )
    return _profit_finish(agg, digits, inf_margin).withColumn("is_total", F.lit(True))


def profit_report(df: DataFrame, keys=("region", "category"), count_col: str = "order_id",
                  digits: int = 2, inf_margin: bool = False) -> DataFrame:
    """Group rows plus the grand-total row (E6 + J1), in one pass over the lines.

    ``GROUPING SETS ((keys), ())`` computes both levels together; groups with
    a missing key are dropped while the total still counts their rows, as
    in E4/E5. A one-row neutral total is merged in so that empty input still
    yields the total row (grouping set ``()`` alone yields none). ``is_total``
    separates the total from a real ``ALL`` label; sort with
    :func:`profit_report_order`.
    """
    keys = list(keys)
    g = df.groupingSets([keys, []], *keys).agg(
        F.count(C(count_col)).alias("_ids"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.sum("cost").cast("double").alias("total_cost"),
        F.sum("profit").cast("double").alias("total_profit"),
        (F.grouping_id() > 0).alias("is_total"),
    )
    has_keys = reduce(lambda a, b: a & b, [C(k).isNotNull() for k in keys])
    rows = g.where(C("is_total") | has_keys).select(
        "is_total",
        *[F.when(C("is_total"), F.lit(ALL)).otherwise(C(k)).alias(k) for k in keys],
        F.when(C("is_total"), C("_rows")).otherwise(C("_ids")).alias("orders_count"),
        "total_revenue", "total_cost", "total_profit",
    )
    neutral = df.sparkSession.range(1).select(
        F.lit(True).alias("is_total"), *[F.lit(ALL).alias(k) for k in keys],
        F.lit(0).cast("long").alias("orders_count"),
        *[F.lit(None).cast("double").alias(c) for c in ("total_revenue", "total_cost", "total_profit")],
    )
    merged = rows.unionByName(neutral).groupBy("is_total", *keys).agg(
        F.sum("orders_count").alias("orders_count"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("total_revenue", "total_cost", "total_profit")],
    )
    return _profit_finish(merged, digits, inf_margin).select(
        *keys, "orders_count", "total_revenue", "total_cost", "total_profit", "profit_margin", "is_total"
    )


def profit_report_order(keys=("region", "category"), totals_last: bool = False) -> list:
    """Report order: by keys as text (``ALL`` sorts among the labels, as in
    the reference); ``totals_last`` puts the total row at the end (I1)."""
    return (["is_total"] if totals_last else []) + list(keys)


def month_segment_base(df: DataFrame, month: str = "order_month", segment: str = "segment") -> DataFrame:
    """GROUP BY month, segment: order count, distinct customers (missing
    ignored), revenue, 0 if all are missing (E9); rows with a missing key form no group. One row per
    month, segment and customer first, so that the distinct count is a plain count."""
    per_customer = df.dropna(subset=[month, segment]).groupBy(month, segment, "customer_id").agg(
        F.count(C("order_id")).alias("_orders"), F.sum(C("revenue")).alias("_revenue")
    )
    return per_customer.groupBy(month, segment).agg(
        F.sum("_orders").alias("orders_count"),
        F.count(C("customer_id")).alias("customers_count"),
        F.coalesce(F.sum("_revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
    )


def monthly_totals_additive(base: DataFrame, month: str = "order_month") -> DataFrame:
    """Month ``ALL`` rows summed from the month x segment rows (E8): a customer
    in two segments of one month counts twice, as in the J5 job."""
    return base.groupBy(month).agg(
        F.sum("orders_count").alias("orders_count"),
        F.sum("customers_count").alias("customers_count"),
        F.sum("total_revenue").alias("total_revenue"),
    )
