"""WARC archives of captures, their read-back, and the merged capture index.

Method: captures are written as WARC/1.1 files; every file's records give a locally sorted run of
index lines; the runs are cut at common splitters of (URL key, timestamp) and each slice is
merged from its runs by a loser tree, which yields globally ordered capture histories.

Archives are written by Spark's text sink: a record's value is its header and payload, and the line
separator is the blank lines that end a record; gzip compresses each file as a whole.  So a failed
or repeated task leaves no half file, any file system Spark knows will do, and files are bounded by
``records_per_file``.  They are read back whole through the ``binaryFile`` source; offsets count
uncompressed bytes.

Defined cases: a null payload is empty; equal payloads are told apart by length and SHA-1; of equal
payloads of at least ``min_bytes`` bytes the record with the largest id is the response and
the others revisit it (rows that repeat this id are all responses); a null id is smaller than any
other, a null URL has the empty URL key; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from astroframe.llm.common import scratch_path, shuffle_parts, stored

RECORD_END = "\r\n\r\n"
RECORDS_PER_FILE = 2000
#: captures carry no time of their own here: the id counts seconds from this moment
EPOCH = "2024-01-01T00:00:00Z"
INDEX = ("url_key string, ts string, page_id long, record_type string, refers_to long, payload_bytes long, "
         "payload_digest string, file string, offset long, length long, run int")


def url_key(url: str | None) -> str:
    """Sort-friendly key: reversed host labels, then path and query, lower-cased, without scheme, www and fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").lower()
    except ValueError:
        return url.strip().lower()
    host = re.sub(r"^www\d*\.", "", host)
    path = parts.path.lower() or "/"
    return ",".join(reversed(host.split("."))) + ")" + path + ("?" + parts.query.lower() if parts.query else "")


BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(col: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a text's UTF-8 bytes: 32 letters of five bits, 20 bits from every five hex digits."""
    hexed = F.sha1(col)
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda g: F.conv(F.substring(hexed, g * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    def letter(v: Column, low: int) -> Column:
        return F.substring(F.lit(BASE32), F.shiftright(v, low).bitwiseAND(F.lit(31)) + 1, F.lit(1))

    return F.array_join(F.transform(groups, lambda v: F.concat(*[letter(v, low) for low in (15, 10, 5, 0)])), "")


def with_roles(captures: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds payload_bytes, payload_digest and ``response_id``: the largest id with this payload.

    The largest id comes from a group maximum, combined before the shuffle and written, so that the captures of a
    payload that a third of them have are split at run time when they meet it; digests, not payloads, are joined.
    """
    payload = F.coalesce("payload", F.lit(""))
    own = captures.withColumns({"payload_bytes": F.octet_length(payload).cast("long"), "payload_digest": base32_sha1(payload)})
    largest = own.groupBy("payload_bytes", "payload_digest").agg(F.max("id").alias("response_id"))
    out = own.join(stored(largest, "payloads"), ["payload_bytes", "payload_digest"])
    return out.withColumn("response_id", F.when(F.col("payload_bytes") >= min_bytes, F.col("response_id")).otherwise(F.col("id")))


def record(head: list[tuple[str, Column]], payload: Column) -> Column:
    """One WARC record (without its end): version line, the non-null header fields, a blank line, the payload."""
    fields = [F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")) for name, value in head]
    return F.concat(F.lit("WARC/1.1\r\n"), *[F.coalesce(f, F.lit("")) for f in fields], F.lit("\r\n"), payload)


def write_archive(captures: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write captures (id long, url string, payload string) as WARC files below ``path``."""
    rows = with_roles(captures.select(F.col("id").cast("long").alias("id"), "url", "payload"), min_bytes)
    revisit = ~F.col("id").eqNullSafe(F.col("response_id"))
    body = F.when(revisit, F.lit("")).otherwise(F.coalesce("payload", F.lit("")))
    when = F.date_format(F.to_timestamp(F.lit(EPOCH)) + F.make_dt_interval(secs=F.coalesce("id", F.lit(0)).cast("decimal(18,6)")),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    clean_url = F.regexp_replace("url", r"[\r\n]+", " ")
    head = [("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))),
            ("WARC-Date", when), ("WARC-Target-URI", clean_url),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            ("X-Payload-Length", F.col("payload_bytes")),
            ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("response_id").cast("string"), F.lit(">")))),
            ("Content-Type", F.lit("text/html;charset=utf-8")), ("Content-Length", F.octet_length(body))]
    (rows.select(record(head, body).alias("value")).write.option("lineSep", RECORD_END)
     .option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path))


def records(raw: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, body) of each record of an archive."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        body = raw[end + 4:end + 4 + int(head["Content-Length"])]
        done = end + 4 + len(body)
        if len(body) != int(head["Content-Length"]) or raw[done:done + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield at, done + 4 - at, head, body
        at = done + 4


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def index_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index lines of every archive below ``path``, sorted within each file (a run); digests are checked on the way."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, raw in zip(batch["path"], batch["content"]):
                lines = []
                for offset, length, head, body in records(gzip.decompress(raw)):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response" and digest != base64.b32encode(hashlib.sha1(body).digest()).decode():
                        raise ValueError(f"{file}: payload at byte {offset} does not match its digest")
                    lines.append((url_key(head.get("WARC-Target-URI")), head["WARC-Date"], _page(head["WARC-Record-ID"]),
                                  head["WARC-Type"], _page(head.get("WARC-Refers-To")), int(head["X-Payload-Length"]), digest,
                                  file.rsplit("/", 1)[-1], offset, length))
                lines.sort(key=merge_key)
                out = pd.DataFrame(lines, columns=[c.split()[0] for c in INDEX.split(", ")[:-1]])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"}).assign(run=0)

    return files.mapInPandas(run, INDEX).withColumn("run", F.hash("file"))


def merge_key(line: tuple) -> tuple:
    """URL key, timestamp, then id (null first), file and place."""
    return line[0], line[1], line[2] is not None, line[2] or 0, line[7], line[8]


class LoserTree:
    """k-way merge of sorted runs: each pop replays one leaf against the losers on its path to the root."""

    def __init__(self, runs: list[list], key: Callable):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = len(runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * self.k
        self.winner = -1
        for leaf in range(self.k):
            self._replay(leaf)

    def _next(self, i: int):
        item = next(self.runs[i], None)
        return None if item is None else (self.key(item), i, item)

    def _beats(self, a: int, b: int) -> bool:
        """Does run ``a`` come before run ``b``? Ended runs come last; -1 stands for a leaf not yet seen and always wins."""
        if a == -1 or b == -1:
            return a == -1
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def _replay(self, leaf: int) -> None:
        now, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self._beats(self.losers[node], now):
                now, self.losers[node] = self.losers[node], now
            node //= 2
        self.winner = now

    def __iter__(self):
        while self.k and self.heads[self.winner] is not None:
            yield self.heads[self.winner][2]
            self.heads[self.winner] = self._next(self.winner)
            self._replay(self.winner)


def merged_index(runs: DataFrame) -> DataFrame:
    """Capture histories in global order of (URL key, timestamp, id): INDEX columns, ``slice`` and ``place`` within it.

    The runs are cut into slices at splitters of the whole sort key, so a URL that holds a third
    of all captures spans many slices; a slice, never a URL's history, is what a task merges.
    """
    n = shuffle_parts(runs.sparkSession)
    names = [c.split()[0] for c in INDEX.split(", ")]
    sliced = runs.repartitionByRange(n, "url_key", "ts", "page_id", "file", "offset")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[tuple, list[tuple]] = {}
        for batch in batches:
            for line in zip(*(batch.column(i).to_pylist() for i in range(len(names)))):
                parts.setdefault((line[7], line[10]), []).append(line)
        for part in parts.values():  # a run's lines may come from several fetched blocks
            if any(merge_key(a) > merge_key(b) for a, b in zip(part, part[1:])):
                part.sort(key=merge_key)
        block, place = [], 0
        for line in LoserTree(list(parts.values()), merge_key):
            block.append((*line, place))
            place += 1
            if len(block) == 10_000:
                yield to_batch(block)
                block = []
        if block:
            yield to_batch(block)

    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
             pa.int64(), pa.int32(), pa.int64()]

    def to_batch(block: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*block), kinds)], names=[*names, "place"])

    out = sliced.mapInArrow(merge, INDEX + ", place long")
    return out.withColumn("slice", F.spark_partition_id())


def archive_and_index(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                      min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write the pages as WARC files (below the shared scratch folder unless ``path`` is given) and return their merged index."""
    spark = pages.sparkSession
    if path is None:
        path = scratch_path(spark, "warc")
    write_archive(pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), F.col(html).alias("payload")), path, min_bytes)
    return merged_index(index_runs(spark, path))
