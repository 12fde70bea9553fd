"""Registered queries of the corpus operators, and their DuckDB oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from astroframe.llm import bpe, decontam, langid, linededup, merkle, mixing, packing, quality, search, sharding, simhash, substrings, warc
from astroframe.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: the word white space as a pattern, and as the characters that are stripped from lines
SQL_WORD = r"[^\x20\x09-\x0D]+"
SQL_SPACE = "(chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
SQL_UPPER, SQL_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


SQL_QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
base AS (SELECT *, regexp_extract_all(t, '{SQL_WORD}') AS ws,
                list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{SQL_WORD}')) AS ls FROM docs),
windows AS (SELECT rid, i, list_slice(ws, i, i + 4) AS w
            FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM base)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS c FROM windows) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM again) GROUP BY rid),
rules AS (SELECT b.rid, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
                 CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
                 CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
          FROM base b LEFT JOIN covered c ON b.rid = c.rid),
judged AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
           FROM rules),
hosts AS (SELECT source AS host, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed) AS DOUBLE) AS k
          FROM judged WHERE source IS NOT NULL GROUP BY source),
sums AS (SELECT sum(n) AS nn, sum(k) AS kk, sum(n * n) AS n2, sum(k * k / n) AS k2, count(*) AS h FROM hosts),
moments AS (SELECT *, kk / nn AS m, k2 - kk * kk / nn AS s, nn - n2 / nn - (h - 1) AS room FROM sums),
prior AS (SELECT *, CASE WHEN m > 0 AND m < 1 AND room > 0 THEN (s / (m * (1 - m)) - (h - 1)) / room ELSE 0 END AS rho FROM moments),
rates AS (SELECT host, CASE WHEN rho <= 0 THEN m
                 ELSE (k + m * greatest(0, (1 - rho) / rho)) / (n + greatest(0, (1 - rho) / rho)) END AS rate
          FROM hosts, prior),
bad AS (SELECT host FROM rates WHERE round(rate, 9) > {quality.MAX_HOST_RATE})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       source IS NOT NULL AND source IN (SELECT host FROM bad) AS host_rejected,
       NOT base_failed AND NOT (source IS NOT NULL AND source IN (SELECT host FROM bad)) AS kept
FROM judged
"""


@register("op1_quality_rules", SQL_QUALITY)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc.doc_id", *quality.RULE_COLUMNS, "host_rejected", "kept")


SQL_LINES = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT rid, i, ls[i] AS line, translate(trim(ls[i], {SQL_SPACE}), '{SQL_UPPER}', '{SQL_LOWER}') AS k
          FROM (SELECT rid, ls, unnest(range(1, len(ls) + 1)) AS i FROM docs)),
frequent AS (SELECT k FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= {linededup.MIN_DOCS}),
kept AS (SELECT rid, i, line FROM lines WHERE k NOT IN (SELECT k FROM frequent)),
joined AS (SELECT rid, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM kept GROUP BY rid)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - coalesce(n, 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs d LEFT JOIN joined j ON d.rid = j.rid
"""


@register("op3_line_dedup", SQL_LINES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


SQL_MIX = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{SQL_WORD}')) AS BIGINT) AS size,
                     CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15)
                          AS BIGINT) AS h FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
        FROM docs GROUP BY source),
filled AS (SELECT source, s, w, row_number() OVER o AS k, sum(s) OVER () - {mixing.MAX_EPOCHS} * coalesce(sum(s) OVER p, 0) AS rest,
                  sum(w) OVER () - coalesce(sum(w) OVER p, 0) AS rest_w
           FROM src WINDOW o AS (ORDER BY {mixing.MAX_EPOCHS}.0 * s / w, source),
                p AS (ORDER BY {mixing.MAX_EPOCHS}.0 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT rest, rest_w FROM filled WHERE w * rest <= {mixing.MAX_EPOCHS} * s * rest_w ORDER BY k LIMIT 1),
targets AS (SELECT f.source, s, CASE WHEN w * l.rest > {mixing.MAX_EPOCHS} * s * l.rest_w THEN CAST(s AS DOUBLE) * {mixing.MAX_EPOCHS}
                                ELSE CAST(w * l.rest AS DOUBLE) / CAST(l.rest_w AS DOUBLE) END AS target
            FROM filled f, level l),
parts AS (SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS whole FROM targets),
mixed AS (SELECT doc_id, size, p.s, p.target, least({mixing.MAX_EPOCHS}, whole + CAST(
                 2 * coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 + size <= 2 * (target - whole * s) AS INTEGER)) AS copies
          FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, s AS source_size, target, CAST(copies AS BIGINT) AS copies, CAST(size * copies AS BIGINT) AS taken FROM mixed
"""


@register("op5_source_mixing", SQL_MIX)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc.doc_id", "size", "source_size", "target", "copies", "taken")


@register("op7_simhash_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


SHARDS = 24


@register("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS, carry=["doc_id"])
    return out.select("doc.doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@register("op8_benchmark_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "windows", "item_windows", "form")


@register("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "text")
    return langid.identify(rows, langid.train(docs)).drop("text")


SQL_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS response_id FROM p),
d AS (SELECT *, sha1(h) AS hex FROM r)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(hex, CAST(floor(i / 4) AS BIGINT) * 5 + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '')
           AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM response_id THEN NULL ELSE response_id END AS refers_to
FROM d
"""


@register("op6_warc_index", SQL_WARC)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_and_index(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeated(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@register("op2_token_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def sql_value(col: str) -> str:
    return f"coalesce(octet_length(encode(CAST({col} AS VARCHAR))) || ':' || CAST({col} AS VARCHAR), '-')"


def sql_leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(sql_value(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


#: one climb: every two nodes of a tree become one while the tree has several
SQL_CLIMB = """SELECT {tree}, level + 1, place // 2, CAST((any_value(n) + 1) // 2 AS BIGINT), sha256(string_agg(digest, '' ORDER BY place))
             FROM {nodes} WHERE n > 1 GROUP BY {tree}, level, place // 2"""
SQL_STEP = "CASE WHEN s.digest IS NULL THEN '.' WHEN s.place > a.place THEN 'R' || s.digest ELSE 'L' || s.digest END"
SQL_MERKLE = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, {sql_leaf('n_chars')} AS leaf, {sql_leaf('(CAST(n_chars AS HUGEINT) + 1)')} AS changed FROM documents),
crc_bits AS (SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
               lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT))),
               lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(0, 8) AS BIGINT[])),
                  lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)) AS c
             FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
hit AS (SELECT doc_id FROM crc_bits WHERE xor(c, 4294967295::BIGINT) % 7 = 0),
leaves AS (SELECT d.*, row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY lang) AS n,
                  CASE WHEN h.doc_id IS NULL THEN leaf ELSE changed END AS shown
           FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id WINDOW w AS (PARTITION BY lang ORDER BY d.doc_id NULLS FIRST, leaf, rid)),
nodes(lang, level, place, n, digest) AS (
  SELECT lang, 0, place, n, leaf FROM leaves UNION ALL {SQL_CLIMB.format(tree='lang', nodes='nodes')}),
roots AS (SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(tree, level, place, n, digest) AS (
  SELECT 0, 0, place, n, digest FROM roots UNION ALL {SQL_CLIMB.format(tree='tree', nodes='tops')}),
steps AS (
  SELECT l.rid, a.level, {SQL_STEP} AS step
  FROM leaves l JOIN nodes a ON a.lang IS NOT DISTINCT FROM l.lang AND a.n > 1 AND a.place = l.place >> a.level
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM a.lang AND s.level = a.level AND s.place = xor(a.place, 1)
  UNION ALL
  SELECT l.rid, 1000 + a.level, {SQL_STEP}
  FROM leaves l JOIN roots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN tops a ON a.n > 1 AND a.place = r.place >> a.level
  LEFT JOIN tops s ON s.level = a.level AND s.place = xor(a.place, 1)),
proofs AS (SELECT rid, list(step ORDER BY level) AS proof FROM steps GROUP BY rid),
out AS (
  SELECT l.doc_id, leaf, r.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
         sha256(regexp_replace(array_to_string(coalesce(proof, []), ''), '[LR.]', '', 'g')) AS proof_sha256,
         list_reduce(list_prepend(shown, coalesce(proof, [])), lambda d, s: sha256(
             CASE s[1] WHEN 'L' THEN s[2:] || d WHEN 'R' THEN d || s[2:] ELSE d END)) AS folded_root
  FROM leaves l JOIN roots r ON r.lang IS NOT DISTINCT FROM l.lang LEFT JOIN proofs p ON p.rid = l.rid)
SELECT *, folded_root = root AS verified FROM out
"""


@register("op12_merkle_manifest", SQL_MERKLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.verified_manifest(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


SQL_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SQL_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{SQL_UPPER}', '{SQL_LOWER}'), '{SQL_TERM}')"
SQL_SEARCH = f"""
WITH occurs AS (SELECT rid, doc_id, unnest({SQL_TERMS}) AS t FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
freq AS (SELECT rid, any_value(doc_id) AS doc_id, t, count(*) AS tf FROM occurs GROUP BY rid, t),
sizes AS (SELECT rid, CAST(sum(tf) AS BIGINT) AS n FROM freq GROUP BY rid),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
asked AS (SELECT DISTINCT iid, item_id, unnest({SQL_TERMS}) AS t FROM (SELECT row_number() OVER () AS iid, item_id, text FROM benchmark)),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT t, count(*) AS df FROM freq WHERE t IN (SELECT t FROM asked) GROUP BY t), total),
parts AS (SELECT f.*, 50 + (50 * n * docs) // terms AS m FROM freq f JOIN sizes s ON f.rid = s.rid, total),
scores AS (SELECT iid, item_id, rid, p.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
           FROM asked a JOIN weights w ON a.t = w.t JOIN parts p ON p.t = a.t GROUP BY iid, item_id, rid, p.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@register("op11_ranked_search", SQL_SEARCH)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@register("op13_bpe_round_trip")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"])
    return out.select("doc.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
