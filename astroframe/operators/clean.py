"""Projections, filters and NULL-preserving cleaning steps (one lazy plan)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astroframe.functions import columns as C


def project_fields(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.select(*cols)


def project_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def available(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in wanted if c in present]


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def tag_literal(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def cast_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Listed (present) columns to double; bad text and NaN -> NULL."""
    return df.withColumns({c: C.to_double(c) for c in available(df, cols)})


def nan_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: C.nan_to_null(c) for c in available(df, cols)})


def drop_incomplete(df: DataFrame, cols: Iterable[str] = ("e", "a")) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


def filter_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    if lo is not None:
        df = df.filter(F.col(col) >= lo)
    if hi is not None:
        df = df.filter(F.col(col) <= hi)
    return df


def filter_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def filter_equals(df: DataFrame, col: str, value, negate: bool = False) -> DataFrame:
    cond = F.col(col) == F.lit(value)
    return df.filter(~cond if negate else cond)


def clamp(df: DataFrame, col: str, lo: float = 0.0, hi: float = 180.0) -> DataFrame:
    return df.withColumn(col, C.clamp(col, lo, hi))


def null_outside(df: DataFrame, col: str, lo: float = -5.0, hi: float = 35.0) -> DataFrame:
    return df.withColumn(col, C.null_outside(col, lo, hi))


def null_nonpositive(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, C.null_nonpositive(col))


def rows_removed(df: DataFrame, keep: Column) -> DataFrame:
    """(total, kept, dropped) in ONE aggregate pass instead of two counts."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(keep, F.lit(False))).alias("kept"),
    ).withColumn("dropped", F.col("total") - F.col("kept"))


def require_columns(df: DataFrame, cols: Iterable[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
