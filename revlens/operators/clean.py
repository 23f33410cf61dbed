"""Cleaning rules and data-quality counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from revlens.functions.scalar import any_missing, coerce_numeric, fill_unknown, parse_date_strict
from revlens.sources.csv import require_columns

C = F.col

ORDER_COLUMNS = ("order_id", "customer_id", "order_date", "quantity", "unit_price")


def coerce_columns(df: DataFrame, columns) -> DataFrame:
    """Lenient numeric parse of each named column in place."""
    return df.withColumns({c: coerce_numeric(C(c)) for c in columns})


def valid_quantity_price(quantity: str = "quantity", unit_price: str = "unit_price") -> F.Column:
    """Validity rule: quantity > 0 and unit_price >= 0 (zero price is valid).

    NULL on either side is rejected too, so the rule also drops rows whose
    numbers did not parse (B3 + B4).
    """
    return (C(quantity) > 0) & (C(unit_price) >= 0)


def clean_sales_lines(df: DataFrame, numeric=("quantity", "unit_price")) -> DataFrame:
    """J3/J4 cleaning: coerce numbers, drop unparsable rows, apply the validity rule."""
    out = coerce_columns(df, numeric)
    keep = valid_quantity_price()
    for c in numeric:
        keep = keep & C(c).isNotNull()
    return out.where(keep)


def typed_orders(df: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """Order rows with numbers and dates parsed, NULL where they do not parse."""
    require_columns(df, set(ORDER_COLUMNS) | {"segment"})
    out = coerce_columns(df, ("quantity", "unit_price"))
    return out.withColumn("order_date", parse_date_strict(C("order_date"), lenient=lenient_dates))


def clean_orders(df: DataFrame, lenient_dates: bool = False, typed: bool = False) -> DataFrame:
    """J5/J6 cleaning up to (not including) de-duplication: fill segment, drop
    rows with unparsable numbers, apply the validity rule, drop bad dates.
    ``typed`` says that :func:`typed_orders` has been applied."""
    out = df if typed else typed_orders(df, lenient_dates)
    out = out.withColumn("segment", fill_unknown(C("segment")))
    return out.where(valid_quantity_price() & C("order_date").isNotNull())


def _rule_counts() -> dict[str, F.Column]:
    """Counters per cleaning rule over typed orders, in the cascade's order.

    Each counter sees only rows that survived the earlier *removals*; a row
    with quantity <= 0 and price < 0 counts in both."""
    numeric = ~any_missing(["quantity", "unit_price"])
    valid = numeric & valid_quantity_price()
    return {
        "rows_in": F.count(F.lit(1)),
        "missing_segment": F.count_if(C("segment").isNull()),
        "non_numeric": F.count_if(~numeric),
        "non_positive_quantity": F.count_if(numeric & (C("quantity") <= 0)),
        "negative_price": F.count_if(numeric & (C("unit_price") < 0)),
        "bad_date": F.count_if(valid & C("order_date").isNull()),
        "kept": F.count_if(valid & C("order_date").isNotNull()),
    }


def dq_counters(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Counts per cleaning rule, in the reference's cascade, as one row (L1).

    The repeated-id counter is rows minus distinct ids (a NULL id counts as
    one more distinct value). One aggregation pass; nothing is collected.
    """
    typed = typed_orders(df)
    kept = valid_quantity_price() & C("order_date").isNotNull()
    counts = _rule_counts()
    return typed.agg(
        *[c.alias(name) for name, c in counts.items()],
        F.count_distinct(F.when(kept, C(key))).alias("_distinct"),
        F.max(F.when(kept & C(key).isNull(), F.lit(1)).otherwise(F.lit(0))).alias("_null_key"),
    ).select(
        *[name for name in counts if name != "kept"],
        (C("kept") - C("_distinct") - F.coalesce(C("_null_key"), F.lit(0))).alias("duplicate_ids"),
        (C("_distinct") + F.coalesce(C("_null_key"), F.lit(0))).alias("rows_out"),
    )


class QualityCounts:
    """The counters of :func:`dq_counters` taken along the way (L1, L2).

    ``observed`` are the typed orders with counters attached; what comes out of
    cleaning and the version pick passes through :meth:`observe_rows_out`. One
    write of that result fills both, so no rows are read twice.
    """

    def __init__(self, typed: DataFrame):
        self._in, self._out = Observation("cleaning"), Observation("rows_out")
        self._typed = typed
        self.observed = typed.observe(self._in, *[c.alias(name) for name, c in _rule_counts().items()])

    def observe_rows_out(self, df: DataFrame, **sets: F.Column) -> DataFrame:
        """Counts the rows that are left; ``sets`` are expressions of few
        values, such as months, whose values are gathered as well."""
        self._after, self._sets = df, sets
        found = [F.collect_set(c).alias(name) for name, c in sets.items()]
        return df.observe(self._out, F.count(F.lit(1)).alias("rows_out"), *found)

    def values(self, name: str) -> list[str]:
        after = _metrics(self._out)
        if after is None:
            return sorted(r[0] for r in self._after.select(self._sets[name]).distinct().collect())
        return sorted(after[name])

    def result(self) -> dict[str, int]:
        """The counters, once the write is done. Adaptive execution may cut out a plan whose
        rows are all rejected together with its counters; only then they are counted anew."""
        before, after = _metrics(self._in), _metrics(self._out)
        if before is None:
            before = self._typed.agg(*[c.alias(name) for name, c in _rule_counts().items()]).first().asDict()
        kept = before.pop("kept")
        rows_out = after["rows_out"] if after is not None else (self._after.count() if kept else 0)
        return before | {"duplicate_ids": kept - rows_out, "rows_out": rows_out}


def _metrics(observation: Observation) -> dict[str, int] | None:
    """What an observation has, without waiting for what may never come."""
    found = observation._jo.getRowOrEmpty()
    return observation.get if found.isDefined() else None


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter to a step without an extra job (L2).

    The count is filled in when the first action over the returned frame
    completes: ``obs.get["rows"]``.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
