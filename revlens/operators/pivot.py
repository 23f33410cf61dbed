"""Fixed-domain pivot with margins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from revlens.functions.scalar import row_sum

C = F.col

ALL = "ALL"
TOTAL = "TOTAL"


def pivot_sum(
    df: DataFrame,
    index: str = "region",
    columns: str = "category",
    values: str = "revenue",
    domain=("Hardware", "Services", "Software"),
    other: str | None = None,
) -> DataFrame:
    """Rows ``index``, one column per domain value, ``sum(values)``, gaps 0 (F1, F2).

    Rows with a missing index or column label are dropped. Labels outside the
    domain are dropped too (their index rows stay, with zeros), unless
    ``other`` names a column that collects them. The explicit value list
    spares Spark the extra job that would discover the distinct labels.
    """
    domain = list(domain)
    base = df.where(C(index).isNotNull() & C(columns).isNotNull())
    if other is not None:
        base = base.withColumn(columns, F.when(C(columns).isin(*domain), C(columns)).otherwise(F.lit(other)))
        domain = domain + [other]
    pivoted = base.groupBy(index).pivot(columns, domain).agg(F.sum(C(values)))
    return pivoted.select(index, *[F.coalesce(C(f"`{d}`"), F.lit(0)).cast("double").alias(d) for d in domain])


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns, by type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def with_total_column(pivoted: DataFrame, index: str = "region") -> DataFrame:
    """``TOTAL`` = row-wise sum of the value columns (F3 + C7)."""
    cols = [c for c in numeric_columns(pivoted) if c != index]
    return pivoted.withColumn(TOTAL, row_sum([C(f"`{c}`") for c in cols]))


def with_total_row(table: DataFrame, index: str = "region") -> DataFrame:
    """Append the column-sums row labelled ``ALL`` (E10 + F4 + J1).

    The sums are one global aggregate over the (small) pivoted table, whose
    size is regions x domain whatever the number of sales lines.
    ``is_total`` keeps the row apart from a real ``ALL`` label.
    """
    cols = [c for c in numeric_columns(table) if c != index]
    totals = table.agg(*[F.coalesce(F.sum(C(f"`{c}`")), F.lit(0)).cast("double").alias(c) for c in cols]).select(
        F.lit(ALL).alias(index), *[C(f"`{c}`") for c in cols]
    )
    return table.withColumn("is_total", F.lit(False)).unionByName(totals.withColumn("is_total", F.lit(True)))


def pivot_with_totals(df: DataFrame, index: str = "region", columns: str = "category", values: str = "revenue",
                      domain=("Hardware", "Services", "Software"), other: str | None = None) -> DataFrame:
    """Pivot + ``TOTAL`` column + ``ALL`` row; order with ``orderBy("is_total", index)``."""
    return with_total_row(with_total_column(pivot_sum(df, index, columns, values, domain, other), index), index)
