"""Orbital-mechanics column formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from astroframe.constants import A_JUPITER, V_INF_SCALE
from astroframe.functions.columns import col_, safe_div


def tisserand(a="a", e="e", i="i", a_ref: float = A_JUPITER) -> Column:
    """T = a_ref/a + 2 cos(i) sqrt(|a/a_ref| (1 - e^2)).

    NULL when a = 0 (no division) or e > 1 (square root of a negative).
    """
    a, e, i = col_(a), col_(e), col_(i)
    value = safe_div(F.lit(a_ref), a) + F.lit(2.0) * F.cos(F.radians(i)) * F.sqrt(
        F.abs(a / F.lit(a_ref)) * (F.lit(1.0) - e * e))
    return F.when(e <= 1.0, value)


def v_inf(a="a", e="e", k: float = V_INF_SCALE) -> Column:
    """Hyperbolic excess speed: e > 1 ? sqrt(|1/a|) * k : 0."""
    a, e = col_(a), col_(e)
    return F.when(e > 1.0, F.sqrt(F.abs(safe_div(F.lit(1.0), a))) * F.lit(k)).otherwise(F.lit(0.0))


def energy(a="a") -> Column:
    """Orbital energy parameter -1/(2a); NULL when a = 0."""
    return safe_div(F.lit(-1.0), F.lit(2.0) * col_(a))


def q_over_a(q="q", a="a") -> Column:
    """|q / a|; NULL when a = 0."""
    return F.abs(safe_div(col_(q), col_(a)))


def perihelion(a="a", e="e") -> Column:
    return col_(a) * (F.lit(1.0) - col_(e))


def aphelion(a="a", e="e") -> Column:
    return col_(a) * (F.lit(1.0) + col_(e))


def period_years(a="a") -> Column:
    """Kepler's third law in solar units: a^1.5."""
    return F.pow(col_(a), F.lit(1.5))
