"""Scalar column expressions.

All built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen. Each takes and returns a ``Column``.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text markers a CSV reader of the reference treats as a
# missing value (the pandas ``read_csv`` default ``na_values`` list).
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Fixed value: the label that fills a missing segment / product attribute.
UNKNOWN = "UNKNOWN"

# Fixed value: strict order-date format.
STRICT_DATE_FORMAT = "yyyy-MM-dd"
LENIENT_DATE_FORMAT = "yyyy-M-d"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_missing(c: Column | str, markers=MISSING_MARKERS) -> Column:
    """Text cell -> NULL when it is one of the missing markers (exact match)."""
    c = _col(c)
    return F.when(c.isin(*markers), F.lit(None).cast("string")).otherwise(c)


def coerce_numeric(c: Column | str) -> Column:
    """Lenient number parse; unparsable text becomes NULL.

    ``try_cast`` to double accepts ``1e3``, `` 5 ``, ``+3``, ``inf`` and rejects
    ``1_000``, ``0x10``, ``12abc``, ``1,5``. Spark's extras are removed so
    the result matches a strict float parse: a trailing ``d``/``f`` type
    suffix (``5d``), hexadecimal floats (``0x1p3``), and ``nan`` (Spark NaN, which would poison sums).

    The optimizer copies a parse into the filter that reads it, so it is made
    of plain string functions, without a regex: the last character is an
    ``f`` or ``d`` in no number but infinity, and an ``x`` in none.
    """
    text = _col(c).cast("string")
    end = F.rtrim(text, F.lit(" \t\n\r\x0b\x0c"))
    suffix = F.substring(end, -1, 1).isin("d", "D", "f", "F") & (F.lower(F.substring(end, -3, 3)) != "inf")
    extra = suffix | F.contains(text, F.lit("x")) | F.contains(text, F.lit("X"))
    value = F.when(~extra, text.try_cast("double"))
    return F.nanvl(value, F.lit(None).cast("double"))


def parse_date_strict(c: Column | str, lenient: bool = False) -> Column:
    """``yyyy-MM-dd`` text -> DATE; anything else (time part, slashes,
    compact form, impossible day) -> NULL (C2). ``lenient`` also takes
    single-digit month/day."""
    fmt = LENIENT_DATE_FORMAT if lenient else STRICT_DATE_FORMAT
    text = _col(c).cast("string")
    # the parser also takes signed years and years of more than four digits
    plain_year = text.rlike(r"^\d{4}-")
    return F.when(plain_year, F.to_date(F.try_to_timestamp(text, F.lit(fmt))))


def fill_unknown(c: Column | str, label: str = UNKNOWN) -> Column:
    """Missing label -> ``UNKNOWN``."""
    return F.coalesce(_col(c), F.lit(label))


def round_half_even(c: Column | str, digits: int = 2) -> Column:
    """Round like numpy: half-to-even on the scaled binary value.

    The scaling multiply rounds first, so 0.125 -> 0.12, 2.675 -> 2.68
    (267.5 is even-rounded up), 0.575 -> 0.57 (57.4999...), as in the reference.
    """
    scale = float(10**digits)
    return F.rint(_col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def safe_ratio(num: Column | str, den: Column | str, digits: int = 2, inf_margin: bool = False) -> Column:
    """Rounded ``num / den``; 0/0 and (by default) x/0 give 0.

    ``inf_margin=True`` keeps the reference code's +-inf for x/0 with x != 0.
    """
    num, den = _col(num).cast("double"), _col(den).cast("double")
    ratio = F.coalesce(round_half_even(F.try_divide(num, den), digits), F.lit(0.0))
    if not inf_margin:
        return ratio
    return (
        F.when((den == 0) & (num > 0), F.lit(float("inf")))
        .when((den == 0) & (num < 0), F.lit(float("-inf")))
        .otherwise(ratio)
    )


def row_sum(cols: list[Column | str]) -> Column:
    """Row-wise sum over columns, missing counted as 0."""
    return reduce(add, [F.coalesce(_col(c), F.lit(0)) for c in cols])


def month_label(c: Column | str) -> Column:
    """DATE -> ``yyyy-MM`` text."""
    return F.date_format(_col(c), "yyyy-MM")


def any_missing(cols: list[Column | str]) -> Column:
    """True when any of the columns is NULL."""
    return reduce(lambda a, b: a | b, [_col(c).isNull() for c in cols])
