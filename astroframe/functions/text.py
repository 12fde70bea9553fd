"""String helpers used by reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from astroframe.functions.columns import col_


def capitalize(c) -> Column:
    """First character upper, the rest lower (Python ``str.capitalize``)."""
    x = col_(c)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))


def part(c, sep: str, n: int) -> Column:
    """n-th (1-based) piece of a split on a literal separator; '' when absent."""
    return F.split_part(col_(c), F.lit(sep), F.lit(n))


def prefix(c, n: int) -> Column:
    return F.substring(col_(c), 1, n)
