"""Orbit tables: sampled trajectories as rows (key, j, x, y, z).

Each body expands to n points with ``explode(sequence(0, n-1))``: the work
is a narrow projection per point, partitioned like the input rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astroframe.functions.columns import col_


def _points(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def _linspace(lo: Column, hi: Column, n: int) -> Column:
    """numpy.linspace value at index j (endpoint included)."""
    step = (hi - lo) / F.lit(float(n - 1))
    return F.when(F.col("j") == n - 1, hi).otherwise(lo + F.col("j") * step)


def hyperbolic_path(df: DataFrame, e="e", q="q", i="i", n: int = 500, margin: float = 0.1) -> DataFrame:
    """Plane hyperbola tilted by inclination: nu in +-(acos(-1/e) - margin), r = q(1+e)/(1+e cos nu)."""
    e_, q_, i_ = col_(e), col_(q), col_(i)
    out = _points(df.where(e_ > 1.0), n)
    nu_max = F.acos(F.lit(-1.0) / e_) - F.lit(margin)
    nu = _linspace(-nu_max, nu_max, n)
    p = q_ / (e_ - F.lit(1.0)) * (e_ * e_ - F.lit(1.0))
    r = p / (F.lit(1.0) + e_ * F.cos(nu))
    inc = F.radians(i_)
    return out.withColumns({"nu": nu, "r": r}).withColumns({
        "x": F.col("r") * F.cos("nu"),
        "y": F.col("r") * F.sin("nu") * F.cos(inc),
        "z": F.col("r") * F.sin("nu") * F.sin(inc),
    })


def hyperbolic_path_3d(df: DataFrame, e="e", q="q", i="i", om="om", w="w", n: int = 500,
                       frac: float = 0.95, degrees: bool = False) -> DataFrame:
    """Hyperbola with the full (w, i, om) rotation; nu in +-frac*acos(-1/e).

    ``degrees=False`` uses the angle columns as radians, as the reference does.
    """
    e_, q_ = col_(e), col_(q)
    conv = F.radians if degrees else (lambda c: c)
    inc, om_, w_ = conv(col_(i)), conv(col_(om)), conv(col_(w))
    out = _points(df.where(e_ > 1.0), n)
    vmax = F.acos(F.lit(-1.0) / e_) * F.lit(frac)
    v = _linspace(-vmax, vmax, n)
    out = out.withColumn("nu", v)
    r = q_ * (F.lit(1.0) + e_) / (F.lit(1.0) + e_ * F.cos("nu"))
    out = out.withColumn("r", r).withColumns({"xo": F.col("r") * F.cos("nu"), "yo": F.col("r") * F.sin("nu")})
    cw, sw, ci, si, co, so = F.cos(w_), F.sin(w_), F.cos(inc), F.sin(inc), F.cos(om_), F.sin(om_)
    xo, yo = F.col("xo"), F.col("yo")
    return out.withColumns({
        "x": (co * cw - so * sw * ci) * xo + (-co * sw - so * cw * ci) * yo,
        "y": (so * cw + co * sw * ci) * xo + (-so * sw + co * cw * ci) * yo,
        "z": (sw * si) * xo + (cw * si) * yo,
    }).drop("xo", "yo")


def polar_path(df: DataFrame, e="e", a="a", i="i", n: int = 100, r_max: float = 50.0) -> DataFrame:
    """theta in [-pi/2, pi/2]; r = |a|(e^2-1)/(1+e cos theta) clipped to [0, r_max]."""
    e_, a_, i_ = col_(e), col_(a), col_(i)
    out = _points(df, n)
    th = _linspace(F.lit(-math.pi / 2), F.lit(math.pi / 2), n)
    out = out.withColumn("theta", th)
    r = F.abs(a_) * (e_ * e_ - F.lit(1.0)) / (F.lit(1.0) + e_ * F.cos("theta"))
    r = F.when(r > r_max, F.lit(r_max)).when(r < 0, F.lit(0.0)).otherwise(r)
    inc = F.radians(i_)
    return out.withColumn("r", r).withColumns({
        "x": F.col("r") * F.cos("theta"),
        "y": F.col("r") * F.sin("theta") * F.cos(inc),
        "z": F.col("r") * F.sin("theta") * F.sin(inc),
    })


def circular_path(df: DataFrame, radius: str, n: int = 200) -> DataFrame:
    """Circle of the given radius in the ecliptic plane, theta in [0, 2 pi]."""
    out = _points(df, n)
    th = _linspace(F.lit(0.0), F.lit(2 * math.pi), n)
    return out.withColumn("theta", th).withColumns({
        "x": F.col(radius) * F.cos("theta"), "y": F.col(radius) * F.sin("theta"), "z": F.lit(0.0)})


def radius_progress(df: DataFrame, n: int, index: str = "j") -> DataFrame:
    """Distance to the origin and percent of the path done."""
    return df.withColumns({
        "dist": F.sqrt(F.col("x") ** 2 + F.col("y") ** 2 + F.col("z") ** 2),
        "progress": F.col(index) / F.lit(float(n)) * F.lit(100.0),
    })


def unit_vector_offset(df: DataFrame, length: float = 1.5) -> DataFrame:
    """Point + length * unit vector away from the origin (NULL tail at the origin)."""
    d = F.sqrt(F.col("x") ** 2 + F.col("y") ** 2 + F.col("z") ** 2)
    ok = d > 0
    return df.withColumns({
        f"tail_{c}": F.when(ok, F.col(c) + F.col(c) / d * F.lit(length)) for c in ("x", "y", "z")})


def date_spine(df: DataFrame, key: str, date_col: str) -> DataFrame:
    """Daily calendar per key from its first to its last date, with days since the first."""
    bounds = df.groupBy(key).agg(F.min(F.to_date(date_col)).alias("d0"), F.max(F.to_date(date_col)).alias("d1"))
    return (bounds.select(key, "d0", F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("date"))
                  .withColumn("days", F.datediff("date", "d0")).drop("d0"))
