"""Quality rules at host level (DataFrame functions only).

Method: every document is judged by its own rules, the failures are counted by host, the
hosts' failure rates are shrunk with a beta prior fitted to all hosts (empirical Bayes), and
hosts whose shrunk rate is too high take their remaining documents with them.

Defined cases: a null text has no words, so it fails; an empty text likewise; a null host
belongs to no host and is judged by its own rules alone; repeated rows are judged each; an
empty table gives an empty result; other columns are passed through packed in one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astroframe.llm.common import stored, words

MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
#: a host is rejected when its shrunk failure rate is above this
MAX_HOST_RATE = 0.5

RULE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def with_rules(df: DataFrame, text: str, window: int = WINDOW) -> DataFrame:
    """Adds the rule columns of each text, all within the row: no shuffle, n log n in its words.

    ``n_repeat_words`` counts the words that lie in a ``window``-word window found twice or
    more in the text.  Windows are compared by a 64-bit hash of their words' hashes.
    """
    keep = df.columns
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0)
    out = df.select(*keep, words(text).alias("_words"), F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                    lines.alias("_lines"))
    out = out.select(*keep, "n_symbols", F.size("_words").cast("long").alias("n_words"),
                     F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
                     (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                     F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    starts = F.when(F.size("_h") >= window, F.sequence(F.lit(0), F.size("_h") - window)).otherwise(F.array().cast("array<int>"))
    out = out.select(*keep, *base, F.transform(
        starts, lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(window)])).alias("_win"))
    found = F.size(F.array_distinct("_win")) < F.size("_win")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.select(*keep, *base, F.when(found, F.sort_array(F.transform(
        "_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none).alias("_by_hash"))

    def again(e: Column, j: Column) -> Column:
        near = [F.get(F.col("_by_hash"), j + k)["h"] for k in (-1, 1)]
        return F.coalesce(near[0] == e["h"], F.lit(False)) | F.coalesce(near[1] == e["h"], F.lit(False))

    out = out.select(*keep, *base, F.sort_array(F.transform(F.filter("_by_hash", again), lambda e: e["i"])).alias("_at"))
    covered = F.aggregate(
        "_at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(window), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"])
    out = out.select(*keep, *base, covered.alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return out.withColumn("base_failed", failed)


def rejected_hosts(judged: DataFrame, host: str = "host", failed: str = "base_failed",
                   max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Hosts (columns ``host``, ``host_rate``) whose shrunk failure rate is above ``max_rate``.

    Host counts come from one aggregate with map-side combining; the prior from one row of
    sums over the hosts.  With k of n documents failing per host, m = sum k / sum n and
    S = sum n (k/n - m)^2, the within-host correlation is
    rho = (S / (m (1 - m)) - (H - 1)) / (N - sum n^2 / N - (H - 1)) and the prior's weight
    is (1 - rho) / rho documents; rho <= 0 means that all hosts share the rate m.
    """
    hosts = (judged.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
             .agg(F.count("*").cast("double").alias("n"), F.count_if(F.col(failed)).cast("double").alias("k")))
    sums = hosts.agg(F.sum("n").alias("N"), F.sum("k").alias("K"), F.sum(F.col("n") * F.col("n")).alias("N2"),
                     F.sum(F.col("k") * F.col("k") / F.col("n")).alias("KK"), F.count("*").alias("H")).first()
    empty = hosts.select("host", F.lit(0.0).alias("host_rate")).limit(0)
    if not sums["H"] or not sums["K"]:
        return empty
    total, fails, n_hosts = sums["N"], sums["K"], sums["H"]
    mean = fails / total
    spread = sums["KK"] - fails * mean
    room = total - sums["N2"] / total - (n_hosts - 1)
    rho = (spread / (mean * (1 - mean)) - (n_hosts - 1)) / room if mean < 1 and room > 0 else 0.0
    if rho <= 0:
        rate: Column = F.lit(mean)
    else:
        weight = max(0.0, (1 - rho) / rho)
        rate = (F.col("k") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return hosts.select("host", F.round(rate, 9).alias("host_rate")).where(F.col("host_rate") > max_rate)


def judge(docs: DataFrame, text: str = "text", host: str = "source", carry: list[str] | None = None,
          max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: ``doc`` (the carried columns as a struct), the rules, ``host_rejected``, ``kept``.

    The judged rows are written once (with only the carried columns), so texts are read
    and parsed a single time.  The verdicts are joined back by host: Spark broadcasts the
    rejected hosts when their table is small and otherwise splits skewed hosts at run time.
    """
    cols = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("doc"),
                       F.col(host).alias("host"), F.col(text).alias("_text"))
    judged = with_rules(rows, "_text").drop("_text")
    judged = stored(judged, "quality")
    bad = stored(rejected_hosts(judged, max_rate=max_host_rate), "hosts")
    out = judged.join(bad, "host", "left").withColumn("host_rejected", F.col("host_rate").isNotNull())
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("host_rate")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents (all their columns) that pass their own rules and whose host is not rejected."""
    return judge(docs).where("kept").select("doc.*")
