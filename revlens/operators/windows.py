"""Running and rolling metrics.

Windows run on the month x segment table, whose size is months times
segments whatever the number of orders; they are never applied to raw orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.scalar import month_label

C = F.col


def add_running_metrics(
    df: DataFrame,
    partition_cols=("is_total", "segment"),
    order_col: str = "order_month",
    value: str = "total_revenue",
    window: int = 3,
) -> DataFrame:
    """Cumulative sum and rolling mean over the last ``window`` *present* rows
    (minimum one row) per partition, in month order (G1-G4)."""
    w = Window.partitionBy(*partition_cols).orderBy(order_col)
    return df.withColumns(
        {
            "cumulative_revenue": F.sum(C(value)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "rolling_avg_revenue": F.avg(C(value)).over(w.rowsBetween(-(window - 1), Window.currentRow)),
        }
    )


def dense_months(
    base: DataFrame, keys=("segment",), month: str = "order_month",
    fill=("orders_count", "customers_count", "total_revenue"),
) -> DataFrame:
    """Calendar variant (G5): each key gets every month from its first month to
    the last month of the whole table; absent months get zeros.

    A row also stands for the absent months behind it, up to its key's next
    row or the end of the table, and emits them with zeros. So the gaps
    are filled by two windows over the small table and an ``explode``: no join, and no job
    before the result is asked for.
    """
    own = F.to_date(F.concat(C(month), F.lit("-01")))
    of_key = Window.partitionBy(*keys).orderBy("_month")
    whole = Window.partitionBy(F.lit(0))
    until = F.coalesce(F.add_months(F.lead("_month").over(of_key), -1), F.max("_month").over(whole))
    spans = base.withColumn("_month", own).withColumn("_until", until)
    each = spans.withColumn("_at", F.explode(F.sequence("_month", "_until", F.expr("INTERVAL 1 MONTH"))))
    types = dict(base.dtypes)
    filled = {c: F.when(C("_at") == C("_month"), C(c)).otherwise(F.lit(0).cast(types[c])) for c in fill}
    return each.withColumns(filled | {month: month_label(C("_at"))}).select(*base.columns)
