"""Array helpers: per-row reductions with higher-order functions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from astroframe.functions.columns import col_


def mean_square(c) -> Column:
    """mean(x_k^2) of an array, left-to-right sum."""
    x = col_(c)
    s = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    return s / F.size(x)


def mean_square_diff(a, b) -> Column:
    """mean((a_k - b_k)^2) of two equal-length arrays (reconstruction error)."""
    d = F.zip_with(col_(a), col_(b), lambda u, v: (u.cast("double") - v.cast("double")) * (u.cast("double") - v.cast("double")))
    return F.aggregate(d, F.lit(0.0), lambda acc, v: acc + v) / F.size(d)
