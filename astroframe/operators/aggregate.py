"""Aggregations: counts, quantiles, moments, classification metrics.

Everything here is a partial + final hash aggregate (map-side combine);
outputs are bounded by the number of groups, classes or columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astroframe.operators.comoments import comoments
from astroframe.operators.quantiles import exact_quantiles


def count_by(df: DataFrame, col: str, desc: bool = True) -> DataFrame:
    """Group count (partial + final hash aggregate), ordered by count then key."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    order = F.desc("count") if desc else F.asc("count")
    return out.orderBy(order, F.asc_nulls_last(col))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per value, NULL excluded (pandas ``value_counts``)."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def having_min_count(df: DataFrame, col: str, min_count: int = 50) -> DataFrame:
    return value_counts(df, col).where(F.col("count") >= min_count)


def distinct_types(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(F.asc_nulls_last(col))


def quantile_table(df: DataFrame, cols: Sequence[str], p: float, name: str = "value") -> DataFrame:
    """Exact quantile per column as a (column, value) table."""
    q = exact_quantiles(df, cols, p)
    return df.sparkSession.createDataFrame([(c, q[c]) for c in cols], f"column string, {name} double")


def percentile_threshold(df: DataFrame, col: str, p: float = 0.99, where: Column | None = None) -> float | None:
    """Exact linear-interpolated percentile of ``col`` over the rows matching ``where``."""
    if where is not None:
        df = df.where(where)
    return exact_quantiles(df, [col], p)[col]


def anomaly_rate(df: DataFrame, flag: Column) -> DataFrame:
    """Number and share of flagged rows, one pass."""
    return (df.agg(F.count_if(F.coalesce(flag, F.lit(False))).alias("n_anomalies"),
                   F.count(F.lit(1)).alias("n_rows"))
              .withColumn("share", F.col("n_anomalies") / F.col("n_rows")))


def all_detected(flag: Column, where: Column) -> Column:
    """Tri-state: all flagged / not all / NULL when no row matches ``where``."""
    return F.every(F.when(where, flag))


def column_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation of every column: one aggregate, then unpivot."""
    one = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std"))
        for c in cols])))


def moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Driver-side (mean, population std) per column -- k numbers, one job."""
    r = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (r[f"m_{c}"], r[f"s_{c}"]) for c in cols}


def covariance_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long-form population covariance of every column pair (i <= j), from one pass over the complete rows.

    NULL where no row is complete.
    """
    state = comoments(df, cols)
    cov = state.covariance()
    rows = [(a, b, float(cov[i, j]) if state.n else None) for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]
    return df.sparkSession.createDataFrame(rows, "col_i string, col_j string, cov double")


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """k x k counts including zero cells.

    The label grid comes from the (bounded) set of observed classes, gathered
    in one aggregate and expanded with two ``explode`` -- no join of rows.
    """
    classes = df.select(F.array_sort(F.array_union(F.collect_set(label), F.collect_set(pred))).alias("k"))
    grid = classes.select(F.explode("k").alias(label), "k").select(label, F.explode("k").alias(pred))
    counts = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("count"))
    return (grid.join(counts, [label, pred], "left")
                .select(label, pred, F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.agg(F.avg(F.when(F.col(label) == F.col(pred), 1.0).otherwise(0.0)).alias("accuracy"))


def weighted_prf(df: DataFrame, label: str, pred: str, with_accuracy: bool = False) -> DataFrame:
    """Support-weighted precision / recall / F1 with zero-division -> 0.

    Built from the confusion counts (k^2 rows at most), so the row data is
    read once: per-class support, predicted count and true positives.
    """
    cells = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    support = cells.groupBy(F.col(label).alias("c")).agg(F.sum("n").alias("support"))
    predicted = cells.groupBy(F.col(pred).alias("c")).agg(F.sum("n").alias("predicted"))
    tp = cells.where(F.col(label) == F.col(pred)).select(F.col(label).alias("c"), F.col("n").alias("tp"))
    per = (support.join(predicted, "c", "full").join(tp, "c", "left")
                  .select("c", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("support", "predicted", "tp")]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.withColumns({"p": prec, "r": rec})
    f1 = F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0)
    per = per.withColumn("f", f1)
    tot = F.sum("support")
    metrics = [(F.sum(F.col("p") * F.col("support")) / tot).alias("precision"),
               (F.sum(F.col("r") * F.col("support")) / tot).alias("recall"),
               (F.sum(F.col("f") * F.col("support")) / tot).alias("f1")]
    if with_accuracy:
        metrics.insert(0, (F.sum("tp") / tot).alias("accuracy"))
    return per.agg(*metrics)


def best_by(df: DataFrame, group: str, value: str, name: str, highest: bool = True,
            out: str = "best") -> DataFrame:
    """Per group, the ``name`` with the highest (lowest) ``value``; ties -> smallest name.

    ``min_by`` over a (+-value, name) struct: a plain aggregate with map-side
    combine (no window sort), deterministic on ties.  NULL values are skipped.
    """
    v = F.col(value)
    order = F.struct((-v if highest else v).alias("v"), F.col(name).alias("n"))
    pick = F.min_by(F.struct(F.col(name).alias(out), v.alias(f"{out}_{value}")), order)
    return (df.where(v.isNotNull()).groupBy(group).agg(pick.alias("_p"))
              .select(group, f"_p.{out}", f"_p.{out}_{value}"))


def total_by(df: DataFrame, group: str, value: str, out: str = "total") -> DataFrame:
    return df.groupBy(group).agg(F.sum(value).alias(out))


def min_max(df: DataFrame, col: str) -> tuple[float | None, float | None]:
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return r["lo"], r["hi"]


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Fixed-width density histogram over the finite [min, max]: every bin, empty ones too.

    density = n / (N * width).  Two passes: min/max/N (one tiny aggregate),
    then a grouped count of the bucket index, joined to the list of bins.
    """
    x = F.col(col).cast("double")
    finite = df.select(F.when(F.abs(x) < float("inf"), x).alias("x")).where(F.col("x").isNotNull())
    r = finite.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n")).first()
    lo, hi, n = r["lo"], r["hi"], r["n"]
    spark = df.sparkSession
    if not n:
        return spark.createDataFrame([], "bin int, lo double, hi double, count long, density double")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = finite.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    count = F.coalesce("count", F.lit(0))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        count.alias("count"),
        (count / F.lit(n * width)).alias("density"))
