"""Preprocessing: exact-median imputation, population-std scaling, assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from astroframe.functions.columns import nan_to_null
from astroframe.operators.aggregate import moments
from astroframe.operators.quantiles import exact_quantiles


def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact median of every column (distributed; see ``operators.quantiles``)."""
    return exact_quantiles(df, cols, 0.5)


def apply_fill(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """NULL/NaN -> the fitted literal (a column with no value at all stays NULL)."""
    return df.withColumns({c: F.coalesce(nan_to_null(c), F.lit(v)) if v is not None else nan_to_null(c)
                           for c, v in values.items()})


def impute_median(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill NULL/NaN by the exact column median of ``fit_on`` (default: ``df`` itself)."""
    return apply_fill(df, fit_medians(fit_on if fit_on is not None else df, cols))


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population std) per column in one aggregate; std 0 or NULL -> 1."""
    out = {}
    for c, (m, s) in moments(df, cols).items():
        out[c] = (m if m is not None else 0.0, s if s else 1.0)
    return out


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()})


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std, the moments fitted on ``fit_on`` (default ``df``)."""
    return apply_scaler(df, fit_scaler(fit_on if fit_on is not None else df, cols))


def assemble_features(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)
