"""Generic NULL-safe column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``least/greatest`` would not keep it)."""
    x = col_(c)
    out = x
    if hi is not None and lo is not None:
        return F.when(x > hi, F.lit(float(hi))).when(x < lo, F.lit(float(lo))).otherwise(x)
    if hi is not None:
        out = F.when(x > hi, F.lit(float(hi))).otherwise(x)
    if lo is not None:
        out = F.when(x < lo, F.lit(float(lo))).otherwise(x)
    return out


def null_outside(c: str | Column, lo: float, hi: float) -> Column:
    """Values outside [lo, hi] become NULL."""
    x = col_(c)
    return F.when((x < lo) | (x > hi), F.lit(None)).otherwise(x)


def null_nonpositive(c: str | Column) -> Column:
    """Values <= 0 become NULL."""
    x = col_(c)
    return F.when(x <= 0, F.lit(None)).otherwise(x)


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL (``nanvl`` keeps the generated code small)."""
    return F.nanvl(col_(c), F.lit(None).cast("double"))


def to_double(c: str | Column) -> Column:
    """Text or number to double; unparsable text and NaN become NULL (ANSI-safe)."""
    return nan_to_null(col_(c).try_cast("double"))


def safe_div(n: str | Column, d: str | Column) -> Column:
    """n / d, NULL when d = 0 or NULL (never raises under ANSI mode)."""
    return F.try_divide(col_(n), col_(d))


def rounded(c: str | Column, places: int = 6) -> Column:
    """Round to ``places`` with IEEE operations only: floor(x*10^p + 0.5) / 10^p.

    Unlike ``round`` (decimal text based in Spark, multiply based in other
    engines) this gives identical bits wherever x is identical, so results
    can be compared across engines; ``+ 0.0`` folds -0.0 into 0.0.  From
    2^52 / 10^p on, x * 10^p has no fraction left, so x is its own rounding.
    """
    x = col_(c)
    scale = float(10 ** places)
    r = F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale) + F.lit(0.0)
    return F.when(F.abs(x) * F.lit(scale) < float(1 << 52), r).otherwise(x)


def fresh_name(df, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
