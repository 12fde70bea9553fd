"""Deterministic splits, caps and samples without one-task windows.

Rows are ordered inside a group by ``(md5(id || '-' || seed), id)`` -- the
same hex string in every engine.  "The first k rows of a group" is then a
comparison with the group's k-th key.

* A fixed k (caps, samples) needs no sort of the table: hashes are even, so a
  bound on the key follows from the group's row count.  Rows under the bound,
  about k and a margin per group, are counted by key with map-side combining; the
  k-th of them is exact if they are at least k, else that group alone gets a
  wider bound.
* A share of the rows (splits): the (group, key, id) rows are range partitioned
  and sorted once, which cuts a hot group into even slices like any other;
  ranks within a group follow from the rows per slice.

The k-th keys form a table with one row per group that the rows are joined
with.  No window over a group's rows, no switch on the number or size of groups.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from astroframe.functions.columns import fresh_name
from astroframe.operators.ordering import in_order
from astroframe.session import stored

_ALL = "__all__"
#: hex digits of a key that a bound fixes, and a bound above every key
_DIGITS, _OPEN = 12, "g"
_WIDEN = 4.0


def hash_key(id_col: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


class KRule:
    """How many rows a group of n keeps: ceil(n * frac) or min(n, cap), in exact integers."""

    def __init__(self, frac: float | None = None, cap: int | None = None):
        self.frac = Fraction(str(frac)) if frac is not None else None
        self.cap = cap

    def col(self, n: str) -> Column:
        """The same count as a SQL expression over the integer column ``n``."""
        if self.frac is not None:
            num, den = self.frac.numerator, self.frac.denominator
            return F.expr(f"(`{n}` * {num} + {den - 1}) div {den}")
        return F.least(F.col(n), F.lit(self.cap))


def keyed_rows(df: DataFrame, id_col: str, group: str | None, seed: int) -> DataFrame:
    """(g, key, id) of the rows that have a group."""
    g = F.col(group) if group else F.lit(_ALL)
    return df.select(g.alias("g"), hash_key(id_col, seed).alias("key"), F.col(id_col).alias("id")).where(F.col("g").isNotNull())


def untied(cuts: DataFrame, id_col: str) -> DataFrame:
    """``cuts`` without its column ``tied``; raises where equal ids lie on both sides of a cut."""
    cuts = stored(cuts, "cuts")
    tied = cuts.where("tied").limit(1).collect()
    if tied:
        raise ValueError(f"{id_col} is not unique: several rows with {tied[0]['cut']['id']!r} lie on the cut of a group")
    return cuts.drop("tied")


def share_cuts(df: DataFrame, id_col: str, rule: KRule, group: str | None = None, seed: int = 42) -> DataFrame:
    """One row per group that keeps rows: ``tg`` (group), ``whole`` (false) and ``cut``, the (key, id) of its k-th row."""
    placed = stored(in_order(keyed_rows(df, id_col, group, seed), "g", "key", "id"), "first_k")
    slices = placed.groupBy("part", "g").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("start"))
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        "part", "g", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("start") + 1).alias("shift"),
        F.sum("n").over(Window.partitionBy("g")).alias("total"))
    slices = slices.withColumn("k", rule.col("total").cast("long")).where(F.col("k") > 0)
    around = placed.join(slices, ["part", "g"]).withColumn("after", F.col("idx") + F.col("shift") - F.col("k"))
    around = around.where(F.col("after").isin(0, 1))
    cuts = around.groupBy("g").agg(F.max(F.when(F.col("after") == 0, F.struct("key", "id"))).alias("cut"),
                                   F.max(F.when(F.col("after") == 1, F.struct("key", "id"))).alias("next"))
    return untied(cuts.select(F.col("g").alias("tg"), F.lit(False).alias("whole"), "cut",
                              F.coalesce(F.col("cut") == F.col("next"), F.lit(False)).alias("tied")), id_col)


def smallest_keys(keyed: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """(g, key, id, rows) of at least the ``k`` smallest keys of every group of ``sizes`` (g, n with n > k).

    A bound lets through ``k`` and six standard deviations more; a group that it leaves short is
    scanned again under a wider one, and a bound above the whole range ends it.
    """
    margin, found, left = k + 6.0 * math.sqrt(k) + 20.0, None, sizes
    while True:
        share = F.lit(margin) / F.col("n")
        bound = F.when(share < 1, F.lpad(F.lower(F.hex(F.floor(share * F.lit(float(16 ** _DIGITS))).cast("long"))), _DIGITS, "0")).otherwise(_OPEN)
        bounds = stored(left.select(F.col("g").alias("bg"), bound.alias("bound"), "n"), "key_bounds")
        under = keyed.join(bounds, F.col("g") == F.col("bg")).where(F.col("key") < F.col("bound"))
        under = stored(under.groupBy("g", "key", "id").agg(F.count(F.lit(1)).alias("rows")), "smallest_keys")
        reached = under.groupBy("g").agg(F.sum("rows").alias("rows")).where(F.col("rows") >= k).select("g")
        enough = under.join(reached, "g", "left_semi")
        found = enough if found is None else found.unionByName(enough)
        left = bounds.select(F.col("bg").alias("g"), "n").join(reached, "g", "left_anti")
        if not left.limit(1).collect():
            return found
        left, margin = stored(left, "short_groups"), margin * _WIDEN


def fixed_cuts(df: DataFrame, id_col: str, k: int, group: str | None = None, seed: int = 42) -> DataFrame:
    """As ``share_cuts`` for a fixed ``k``; ``whole`` is true (and ``cut`` null) for groups of at most ``k`` rows."""
    keyed = keyed_rows(df, id_col, group, seed)
    sizes = stored(keyed.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "group_sizes")
    whole = sizes.where(F.col("n") <= k).select(F.col("g").alias("tg"), F.lit(True).alias("whole"),
                                                F.lit(None).cast(keyed.select(F.struct("key", "id")).dtypes[0][1]).alias("cut"), F.lit(False).alias("tied"))
    if k < 1:
        return untied(whole, id_col)
    found = smallest_keys(keyed, sizes.where(F.col("n") > k), k)
    upto = F.sum("rows").over(Window.partitionBy("g").orderBy("key", "id"))
    at = found.withColumn("upto", upto).where((F.col("upto") >= k) & (F.col("upto") - F.col("rows") < k))
    cuts = at.select(F.col("g").alias("tg"), F.lit(False).alias("whole"), F.struct("key", "id").alias("cut"), (F.col("upto") > k).alias("tied"))
    return untied(whole.unionByName(cuts), id_col)


def with_first_k(df: DataFrame, id_col: str, rule: KRule, group: str | None = None, seed: int = 42,
                 out: str = "_first") -> DataFrame:
    """Adds boolean ``out``: the row is among the first k(n_group) rows of its group in hash order.

    Rows of a NULL group are never first.  Without a group the one cut is a
    literal; otherwise the cuts are joined by group, broadcast by their
    written size or else with run-time splitting of hot groups.
    """
    cuts = share_cuts(df, id_col, rule, group, seed) if rule.frac is not None else fixed_cuts(df, id_col, rule.cap, group, seed)
    mine = F.struct(hash_key(id_col, seed).alias("key"), F.col(id_col).alias("id"))
    if group is None:
        row = cuts.first()
        if row is None or row["whole"]:
            return df.withColumn(out, F.lit(row is not None))
        last = F.struct(F.lit(row["cut"]["key"]).alias("key"), F.lit(row["cut"]["id"]).cast(dict(df.dtypes)[id_col]).alias("id"))
        return df.withColumn(out, F.coalesce(mine <= last, F.lit(False)))
    of, cut = fresh_name(df, "tg"), fresh_name(df, "cut")
    cuts = cuts.select(F.col("tg").alias(of), F.struct("whole", "cut").alias(cut))
    flagged = df.join(cuts, F.col(group) == F.col(of), "left")
    return flagged.withColumn(out, F.coalesce(F.col(cut)["whole"] | (mine <= F.col(cut)["cut"]), F.lit(False))).drop(of, cut)


def first_k(df: DataFrame, id_col: str, rule: KRule, group: str | None = None, seed: int = 42) -> DataFrame:
    """The first k rows of each group."""
    mark = fresh_name(df, "first")
    return with_first_k(df, id_col, rule, group, seed, mark).where(F.col(mark)).drop(mark)


def split_by(df: DataFrame, id_col: str, rule: KRule, group: str | None, seed: int, out: str) -> DataFrame:
    mark = fresh_name(df, "first")
    f = with_first_k(df, id_col, rule, group, seed, mark)
    return f.withColumn(out, F.when(F.col(mark), "test").otherwise("train")).drop(mark)


def stratified_split(df: DataFrame, label: str, id_col: str, test: float = 0.2, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """Per class, exactly ceil(n_c * test) rows (first in hash order) go to 'test'."""
    return split_by(df, id_col, KRule(frac=test), label, seed, out)


def holdout_split(df: DataFrame, id_col: str, frac: float = 0.15, seed: int = 42,
                  out: str = "split") -> DataFrame:
    """Unstratified: exactly ceil(n * frac) rows (hash order) go to 'test'."""
    return split_by(df, id_col, KRule(frac=frac), None, seed, out)


def sample_per_group(df: DataFrame, group: str, id_col: str, n: int = 3000, seed: int = 42) -> DataFrame:
    """At most n rows per group (all rows of smaller groups), first in hash order."""
    return first_k(df, id_col, KRule(cap=n), group, seed)


def cap_rows(df: DataFrame, id_col: str, n: int = 20000, seed: int = 42) -> DataFrame:
    """The first n rows in hash order (all rows if fewer)."""
    return first_k(df, id_col, KRule(cap=n), None, seed)


def sample_keep_rare(df: DataFrame, rare: Column, id_col: str, limit: int = 8000, n: int = 7000,
                     seed: int = 42) -> DataFrame:
    """If more than ``limit`` rows: n common rows (hash order) plus every rare row; else all."""
    total = df.count()
    if total <= limit:
        return df
    is_rare = F.coalesce(rare, F.lit(False))
    return first_k(df.where(~is_rare), id_col, KRule(cap=n), None, seed).unionByName(df.where(is_rare))


def topk(df: DataFrame, col: str, k: int, tie: str) -> DataFrame:
    """Top k by ``col`` desc (ties by ``tie``): per-partition top-k then a k-bounded merge."""
    return df.orderBy(F.desc(col), F.asc(tie)).limit(k)


def head_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First n rows by a total order (deterministic ``head``)."""
    return df.orderBy(*order).limit(n)
