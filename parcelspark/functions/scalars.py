"""Column functions shared by the operators; all of them stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds and labels of the coarse size bands.
SIZE_BANDS = [(40, "<40"), (100, "40-100"), (200, "100-200"), (None, "200+")]

# float64 machine epsilon, the floor of the denominator in the absolute percentage error.
EPS = 2.220446049250313e-16


def size_band(size: Column) -> Column:
    """Coarse band, closed on the left; a null size has no band."""
    out = F.when(size.isNull(), F.lit(None).cast("string"))
    for bound, label in SIZE_BANDS[:-1]:
        out = out.when(size < bound, F.lit(label))
    return out.otherwise(F.lit(SIZE_BANDS[-1][1]))


def fine_band(size: Column, width: int = 10) -> Column:
    """Lower edge of the band of ``width`` square metres."""
    return (F.floor(size / F.lit(width)) * width).cast("int")


def month_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def month_index(month: Column) -> Column:
    """Months since year 0 of a ``YYYY-MM`` string, for RANGE frames."""
    return F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int")


def half_even(x: Column, step: float = 100) -> Column:
    """Round to a multiple of ``step``; halves go to the even multiple."""
    return F.bround(x / F.lit(float(step)), 0) * F.lit(float(step))


def abs_pct_error(actual: Column, pred: Column) -> Column:
    return F.abs(actual - pred) / F.greatest(F.abs(actual), F.lit(EPS))


def laplace(u: Column, scale: Column) -> Column:
    """Laplace variate with the given scale from a uniform number (inverse of its CDF)."""
    v = F.least(F.greatest(u, F.lit(1e-9)), F.lit(1 - 1e-9)) - F.lit(0.5)
    return -scale * F.signum(v) * F.log(F.lit(1.0) - F.lit(2.0) * F.abs(v))


def prefix(code: Column, length: int = 3) -> Column:
    return F.substring(code, 1, length)


def first_of(df, name: str, default) -> Column:
    """The column filled with ``default``, or the default itself when the column is absent."""
    return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)
