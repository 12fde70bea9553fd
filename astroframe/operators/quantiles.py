"""Exact quantiles without gathering a column into one task.

Spark's exact ``percentile``/``median`` keeps every distinct value of the
group in one aggregation buffer -- for a global aggregate that is a single
task holding the whole column.  Here all columns go through three scans:

1. one aggregate of mergeable quantile sketches with a guaranteed rank error
   (``percentile_approx``: at most n / ``SKETCH`` ranks) and the counts gives, per column,
   two of its own values below and above the wanted rank;
2. one aggregate counts the rows below, at and between the two values; ranks
   on one of the two are read off;
3. the rows between them, about 4 n / ``SKETCH``, are read: gathered if a column has
   at most ``GATHER`` of them, else range-sorted and looked up by rank, so that
   nothing on the driver grows with the data.

Only comparisons are used, so infinities and any spread of finite values are
ordinary values.  The interpolation is the linear one of numpy /
SQL ``quantile_cont``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astroframe.operators.ordering import in_order, part_starts
from astroframe.session import stored

SKETCH = 10_000
GATHER = 4096
#: ranks, in units of the sketch's error, between the wanted rank and the bracket's ends
MARGIN = 2.0


def exact_quantiles(df: DataFrame, cols: Sequence[str], p: float) -> dict[str, float | None]:
    """Exact linear-interpolated quantile ``p`` of every column (NULL/NaN ignored); scans ``df`` three times at most."""
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}
    values = df.select(*[F.when(~F.isnan(F.col(c)), F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])
    names = {f"x{i}": c for i, c in enumerate(cols)}
    ranks: dict[str, tuple[int, int]] = {}
    found: dict[tuple[str, int], float] = {}
    pending, margin = list(names), MARGIN
    while pending:
        pending = _three_scans(values, pending, p, margin, ranks, found)
        margin *= 16  # not seen, as the sketch's error is guaranteed; the last bracket is the whole column
    out: dict[str, float | None] = {}
    for x, c in names.items():
        out[c] = None
        if x in ranks:
            k, after, h = ranks[x]
            lo, hi = found[x, k], found[x, after]
            out[c] = lo if lo == hi or h == k else lo + (h - k) * (hi - lo)
    return out


def _three_scans(values: DataFrame, cols: list[str], p: float, margin: float, ranks: dict, found: dict) -> list[str]:
    """Fills ``ranks`` (two ranks and the fractional one) and ``found`` (value at a rank); returns columns whose bracket missed."""
    aims = [max(0.0, p - margin / SKETCH), min(1.0, p + margin / SKETCH)]
    first = values.agg(*[e for x in cols for e in (F.count(x).alias(f"n_{x}"), F.percentile_approx(x, aims, SKETCH).alias(f"m_{x}"))]).first()
    marks = {}
    for x in cols:
        n = first[f"n_{x}"]
        if n:
            h = (n - 1) * p
            k = math.floor(h)
            ranks[x] = k, min(k + 1, n - 1), h
            marks[x] = tuple(first[f"m_{x}"]) if n > GATHER else (-math.inf, math.inf)  # small: all values are gathered
    if not marks:
        return []
    counts = values.agg(*[e for x, (u, v) in marks.items() for e in (
        F.count_if(F.col(x) < F.lit(u)).alias(f"under_{x}"), F.count_if(F.col(x) == F.lit(u)).alias(f"low_{x}"),
        F.count_if((F.col(x) > F.lit(u)) & (F.col(x) < F.lit(v))).alias(f"mid_{x}"),
        F.count_if((F.col(x) == F.lit(v)) & F.lit(v > u)).alias(f"high_{x}"))]).first()
    inside: dict[str, list[tuple[int, int]]] = {}  # column -> (rank, its place between the two values)
    missed = []
    for x, (u, v) in marks.items():
        start = counts[f"under_{x}"]
        mid = start + counts[f"low_{x}"]
        high = mid + counts[f"mid_{x}"]
        wanted = set(ranks[x][:2])
        if min(wanted) < start or max(wanted) >= high + counts[f"high_{x}"]:
            missed.append(x)
            continue
        found.update({(x, rank): u if rank < mid else v for rank in wanted if rank < mid or rank >= high})
        if between := [(rank, rank - mid) for rank in wanted if mid <= rank < high]:
            inside[x] = between
    small = {x: want for x, want in inside.items() if counts[f"mid_{x}"] <= GATHER}
    found.update(_gathered(values, marks, small))
    for x in inside.keys() - small.keys():
        found.update(_looked_up(values, x, marks[x], inside[x]))
    return missed


def _between(x: str, marks: tuple[float, float]) -> Column:
    u, v = marks
    return F.when((F.col(x) > F.lit(u)) & (F.col(x) < F.lit(v)), F.col(x))


def _gathered(values: DataFrame, marks: dict, inside: dict[str, list[tuple[int, int]]]) -> dict[tuple[str, int], float]:
    """Ranks in brackets of at most ``GATHER`` rows each: one scan for all columns."""
    if not inside:
        return {}
    items = [F.when(_between(x, marks[x]).isNotNull(), F.struct(F.lit(x).alias("x"), F.col(x).alias("v"))) for x in inside]
    rows = values.select(F.explode(F.array_compact(F.array(*items))).alias("s")).select("s.*")
    held: dict[str, list[float]] = {x: [] for x in inside}
    for r in rows.collect():
        held[r["x"]].append(r["v"])
    out = {}
    for x, want in inside.items():
        ordered = sorted(held[x])
        out |= {(x, rank): ordered[place] for rank, place in want}
    return out


def _looked_up(values: DataFrame, x: str, marks: tuple[float, float], want: list[tuple[int, int]]) -> dict[tuple[str, int], float]:
    """Ranks in a bracket of any size: its rows are range-sorted, and the rows at the wanted places read."""
    rows = values.select(_between(x, marks).alias("v")).where(F.col("v").isNotNull())
    placed = stored(in_order(rows, "v", F.monotonically_increasing_id()), "quantile_bracket")
    starts = part_starts(placed)
    at = {}
    for rank, place in want:
        part, begin, _ = next(s for s in starts if s[1] <= place < s[1] + s[2])
        at[part, place - begin] = rank
    hit = F.lit(False)
    for part, idx in at:
        hit = hit | ((F.col("part") == part) & (F.col("idx") == idx))
    return {(x, at[r["part"], r["idx"]]): r["v"] for r in placed.where(hit).collect()}


def exact_median(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    return exact_quantiles(df, cols, 0.5)
