"""Array arithmetic in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    terms = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))
