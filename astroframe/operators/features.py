"""Feature engineering: orbital features, derived rows, colour indices, the ETL chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from astroframe.constants import A_JUPITER, NUMERIC_COLUMNS, V_INF_SCALE
from astroframe.functions import columns as C
from astroframe.functions.columns import rounded
from astroframe.functions import orbital as O
from astroframe.operators import classify as K
from astroframe.operators.clean import available, require_columns


def add_tisserand(df: DataFrame, a="a", e="e", i="i", a_ref=A_JUPITER, out="tisserand_j") -> DataFrame:
    return df.withColumn(out, O.tisserand(a, e, i, a_ref))


def add_v_inf(df: DataFrame, a="a", e="e", k=V_INF_SCALE, out="v_inf") -> DataFrame:
    return df.withColumn(out, O.v_inf(a, e, k))


def add_energy(df: DataFrame, a="a", out="energy_param") -> DataFrame:
    return df.withColumn(out, O.energy(a))


def add_q_over_a(df: DataFrame, q="q", a="a", out="q_over_a") -> DataFrame:
    return df.withColumn(out, O.q_over_a(q, a))


def derive_orbital(df: DataFrame, a="a", e="e", moid="moid", neo="neo") -> DataFrame:
    """q = a(1-e), ad = a(1+e), per_y = a^1.5 (rounded 6/6/4); pha = NEO and moid < 0.05."""
    return df.withColumns({
        "q": rounded(O.perihelion(a, e), 6),
        "ad": rounded(O.aphelion(a, e), 6),
        "per_y": rounded(O.period_years(a), 4),
        "pha": F.when((F.col(neo) == "Y") & (F.col(moid) < 0.05), "Y").otherwise("N"),
    })


def derive_visibility(df: DataFrame, date_col: str, event_col: str,
                      r0: float, k1: float, k2: float, mag0: float,
                      ra0: float, ra_rate: float, alpha0: float, alpha_rate: float) -> DataFrame:
    """Per-day visibility quantities from the day offset to an event (noise left out).

    days = date - event; r = r0 + k1|days| + k2 days^2;
    V = mag0 - 2.5 log10(max(0.01, 1/r^2)); RA = (ra0 + ra_rate days) mod 360;
    alpha = max(0, alpha0 - alpha_rate |days|).
    """
    days = F.datediff(F.col(date_col), F.col(event_col)).cast("double")
    r = F.lit(r0) + F.lit(k1) * F.abs(days) + F.lit(k2) * days * days
    return df.withColumns({
        "days": days,
        "r": rounded(r, 4),
        "V": rounded(F.lit(mag0) - F.lit(2.5) * F.log10(F.greatest(F.lit(0.01), F.lit(1.0) / (r * r))), 2),
        "RA": rounded(F.pmod(F.lit(ra0) + days * F.lit(ra_rate), F.lit(360.0)), 4),
        "alpha": rounded(F.greatest(F.lit(0.0), F.lit(alpha0) - F.abs(days) * F.lit(alpha_rate)), 2),
    })


def color_index(df: DataFrame, mags: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Differences of neighbouring magnitudes (u-g, g-r, ...)."""
    pairs = list(zip(mags[:-1], mags[1:]))
    names = names or [f"{x}_{y}" for x, y in pairs]
    return df.withColumns({n: F.col(x) - F.col(y) for n, (x, y) in zip(names, pairs)})


def clean_catalogue(df: DataFrame) -> DataFrame:
    """Cast, drop incomplete/negative-e rows, clamp i, NULL bad H / diameter."""
    require_columns(df, ["e", "a", "i", "H", "diameter"])
    df = df.withColumns({c: C.to_double(c) for c in available(df, NUMERIC_COLUMNS)})
    df = df.filter(F.col("e").isNotNull() & F.col("a").isNotNull() & (F.col("e") >= 0))
    return df.withColumns({
        "i": C.clamp("i", 0.0, 180.0),
        "H": C.null_outside("H", -5.0, 35.0),
        "diameter": C.null_nonpositive("diameter"),
    })


def engineer(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "tisserand_j": O.tisserand(),
        "v_inf": O.v_inf(),
        "energy_param": O.energy(),
        "q_over_a": O.q_over_a(),
    })


def etl_full(df: DataFrame) -> DataFrame:
    """Raw catalogue -> processed catalogue (raw + 4 features + object_type).

    Stateless and narrow: one scan, Project/Filter collapsed by Catalyst,
    no shuffle, so it also runs unchanged on a streaming DataFrame.
    """
    require_columns(df, ["class"])
    df = engineer(clean_catalogue(df))
    return df.withColumn("object_type", K.object_type_expr(
        "class", "e", "kind" if "kind" in df.columns else None))
