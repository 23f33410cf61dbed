"""Monthly segment report.

Input: cleaned, enriched orders with ``order_id, customer_id, segment,
revenue, order_month``. Output: one row per (month, segment) plus one
``ALL`` row per month, with cumulative and rolling revenue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.scalar import month_label
from revlens.operators.aggregate import ALL, month_segment_base, monthly_totals_additive
from revlens.operators.windows import add_running_metrics, dense_months

C = F.col

REPORT_COLUMNS = [
    "order_month",
    "segment",
    "orders_count",
    "customers_count",
    "total_revenue",
    "cumulative_revenue",
    "rolling_avg_revenue",
    "is_total",
]

REPORT_ORDER = ["order_month", "is_total", "segment"]


def add_order_metrics(df: DataFrame) -> DataFrame:
    """revenue = quantity x unit_price; order_month = ``yyyy-MM`` of the order date."""
    return df.withColumns({"revenue": C("quantity") * C("unit_price"), "order_month": month_label(C("order_date"))})


def month_segment_rollup(enriched: DataFrame) -> DataFrame:
    """(month, segment) rows and month ``ALL`` rows.

    Orders are first brought to one row per month, segment and customer, by an
    aggregate that is combined map-side. ``GROUPING SETS ((month, segment), (month))``
    then expands those rows and not the orders, with a true distinct count
    of customers per month: a customer in two segments counts once in
    ``ALL``. Totals are told apart by ``grouping(segment)``, not by the label.
    Rows of a missing month or segment form no group (a missing segment still
    counts in its month's total); a group without any revenue has 0.
    """
    per_customer = (
        enriched.where(C("order_month").isNotNull())
        .groupBy("order_month", "segment", "customer_id")
        .agg(F.count(C("order_id")).alias("_orders"), F.sum(C("revenue")).alias("_revenue"))
    )
    g = per_customer.groupingSets([["order_month", "segment"], ["order_month"]], "order_month", "segment").agg(
        F.sum("_orders").alias("orders_count"),
        F.count_distinct(C("customer_id")).alias("customers_count"),
        F.coalesce(F.sum("_revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
        (F.grouping("segment") == 1).alias("is_total"),
    )
    rows = g.where(C("is_total") | C("segment").isNotNull())
    return rows.withColumn("segment", F.when(C("is_total"), F.lit(ALL)).otherwise(C("segment")))


def finish_report(rows: DataFrame) -> DataFrame:
    """Windows per (is_total, segment) in month order, report columns."""
    return add_running_metrics(rows).select(*REPORT_COLUMNS)


def monthly_segment_report(enriched: DataFrame) -> DataFrame:
    """The monthly report with true distinct monthly customers (J6 semantics)."""
    return finish_report(month_segment_rollup(enriched))


def monthly_report_additive(enriched: DataFrame) -> DataFrame:
    """The monthly report with month customers summed over segments (J5 semantics, E8)."""
    base = month_segment_base(enriched).withColumn("is_total", F.lit(False))
    totals = monthly_totals_additive(base).withColumns({"segment": F.lit(ALL), "is_total": F.lit(True)})
    return finish_report(base.unionByName(totals))


def monthly_report_dense(enriched: DataFrame) -> DataFrame:
    """Calendar variant (G5): a segment absent in a month shows zeros from its
    first month on, so rolling means divide by calendar months."""
    return finish_report(dense_months(month_segment_rollup(enriched), ("is_total", "segment")))


def printable_report(report: DataFrame) -> DataFrame:
    """Presentation form (J2): a blank row after each month's ``ALL`` row.

    One pass: every ``ALL`` row also emits an all-NULL row with a sort rank
    after the totals; ``_month`` and ``_rank`` are the sort keys for the sink.
    """
    cols = report.columns
    row = F.struct(*[C(c) for c in cols], C("order_month").alias("_month"),
                   F.when(C("is_total"), F.lit(1)).otherwise(F.lit(0)).alias("_rank"))
    blank = F.struct(*[F.lit(None).cast(t).alias(c) for c, t in report.dtypes],
                     C("order_month").alias("_month"), F.lit(2).alias("_rank"))
    emitted = F.when(C("is_total"), F.array(row, blank)).otherwise(F.array(row))
    return report.select(F.explode(emitted).alias("_r")).select("_r.*")


def printable_order() -> list:
    return ["_month", "_rank", "segment"]
