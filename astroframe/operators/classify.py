"""Conditional mapping, binning and encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from astroframe.constants import CLASS_MAPPING, DETECTED_LABELS, OBJECT_CLASSES, PHASE_CUTS, PHASE_LABELS
from astroframe.functions.columns import col_
from astroframe.operators.ordering import in_order, with_rank
from astroframe.session import stored


def map_literal(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def mapped_class(c="class", mapping: Mapping[str, str] = CLASS_MAPPING) -> Column:
    """Lookup in a literal map; unmapped codes pass through, NULL stays NULL."""
    x = col_(c)
    return F.coalesce(F.try_element_at(map_literal(mapping), x), x)


def object_type_expr(c="class", e="e", kind: str | None = "kind",
                     mapping: Mapping[str, str] = CLASS_MAPPING, value: str = "ISO") -> Column:
    """Class map, then e > 1 -> ISO, then kind = 'iso' -> ISO (last override wins)."""
    out = F.when(col_(e) > 1.0, F.lit(value)).otherwise(mapped_class(c, mapping))
    if kind is not None:
        out = F.when(col_(kind) == "iso", F.lit(value)).otherwise(out)
    return out


def map_class(df: DataFrame, col: str = "class", mapping: Mapping[str, str] = CLASS_MAPPING,
              out: str = "object_type") -> DataFrame:
    return df.withColumn(out, mapped_class(col, mapping))


def override_type(df: DataFrame, e: str = "e", kind: str | None = "kind", col: str = "object_type",
                  value: str = "ISO") -> DataFrame:
    out = F.when(F.col(e) > 1.0, F.lit(value)).otherwise(F.col(col))
    if kind is not None and kind in df.columns:
        out = F.when(F.col(kind) == "iso", F.lit(value)).otherwise(out)
    return df.withColumn(col, out)


def class_dimension(spark: SparkSession, mapping: Mapping[str, str] = OBJECT_CLASSES,
                    key: str = "object_type", value: str = "description") -> DataFrame:
    """The fixed code -> description dimension as a (tiny, fixed-size) DataFrame."""
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")


def label_dim(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join to a code -> description dimension; the planner broadcasts it by its size, or not."""
    return df.join(dim, key, "left")


def cut_bins(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str],
             out: str, out_of_range: str = "nan") -> DataFrame:
    """Right-closed bins (e_k, e_k+1] with labels; outside / NULL -> ``out_of_range``."""
    x = F.col(col)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return df.withColumn(out, expr.otherwise(F.lit(out_of_range)))


def phase_label(df: DataFrame, progress: str, out: str = "phase",
                cuts=PHASE_CUTS, labels=PHASE_LABELS) -> DataFrame:
    p = F.col(progress)
    return df.withColumn(out, F.when(p < cuts[0], labels[0]).when(p < cuts[1], labels[1])
                         .otherwise(labels[2]))


def detected_label(df: DataFrame, flag: Column, out: str = "verdict",
                   yes: str = DETECTED_LABELS[0], no: str = DETECTED_LABELS[1]) -> DataFrame:
    return df.withColumn(out, F.when(flag, F.lit(yes)).otherwise(F.lit(no)))


def label_list(df: DataFrame, col: str) -> list:
    """Sorted distinct non-NULL labels, for models that need their classes as a list (a class is a model output)."""
    return sorted(r[col] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())


def label_codes(df: DataFrame, col: str, out: str = "label") -> DataFrame:
    """Sorted distinct non-NULL labels -> 0..k-1 as a (label, code) table, ranked by a range sort."""
    labels = df.select(col).where(F.col(col).isNotNull()).distinct()
    return with_rank(stored(in_order(labels, col), "labels")).select(col, F.col("rank").cast("int").alias(out))


def label_encode(df: DataFrame, col: str, out: str = "label") -> DataFrame:
    """Attach the 0-based alphabetical code of ``col`` (NULL labels get NULL): a join to the written code table."""
    codes = stored(label_codes(df, col, out), "codes")
    return df.join(codes, col, "left").select(*[df[c] for c in df.columns if c != out], codes[out])


def argmax_label(df: DataFrame, prob_col: str, out: str = "pred") -> DataFrame:
    """0-based position of the largest probability (first on ties)."""
    from pyspark.ml.functions import vector_to_array

    dtype = dict(df.dtypes)[prob_col]
    arr = F.col(prob_col) if dtype.startswith("array") else vector_to_array(F.col(prob_col))
    return df.withColumn(out, (F.array_position(arr, F.array_max(arr)) - 1).cast("int"))
