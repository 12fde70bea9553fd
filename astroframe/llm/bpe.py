"""BPE encoding and decoding as a streaming transducer with bounded lookahead.

Encoding.  A text becomes code points, then words (runs of letters, single digits, runs of other signs, English
clitics), then the bytes of each word, the last one marked as the word's end; merges never leave a word.
Whether the merge that makes token ``uv`` happens at some place depends on the text to the right of it only as
far as a chain of competing merges reaches, each of a lower rank than the one before.  ``lookahead`` follows
these chains over the whole merge list:

    reach(uv) = max(reach(v), reach(u) - |v|, |y| + reach(vy) over merges (v, y) of lower rank, 0)

so that the first token of a stream is fixed once ``max(|t| + reach(t))`` bytes of it are known.  A word is
read through a window of ``WINDOW`` bytes; of a window that does not reach the word's end, the tokens
that start at least that many bytes before its end are stable and leave, and the window moves on to the
first token that is not.  ``Stream`` takes a text in parts of any length and holds at most an open word's last
window.  Words of all documents of an Arrow batch go through their windows side by side in numpy, each distinct
one once.

Decoding.  ``Decoder`` feeds the tokens' bytes to an incremental UTF-8 state machine, which may stop within a
character.  ``Decoder.text`` is what the tokenizer file's own (missing) decoder gives, the vocabulary strings
joined by blanks; ``Decoder.restore`` gives words back as text.

Defined cases: a null text encodes like an empty one, to no ids; strings of the special tokens in a text become
their ids, as in the tokenizer file; repeated rows are encoded each; an empty table gives an empty result; texts
of any length are taken in parts, also within one endless word.  Other columns travel in a struct ``doc``.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

#: bytes of a word that are merged at once; longer words move on window by window
WINDOW = 512
#: characters of one document that are taken at once, and of a batch of documents
PART = 1 << 20
BATCH = 1 << 21
SPACE, LETTER, DIGIT, OTHER = range(4)
#: fixed values: Unicode's White_Space characters
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
NO_RANK = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


@lru_cache(maxsize=1)
def char_kinds() -> np.ndarray:
    """SPACE, LETTER, DIGIT or OTHER of every code point, by the Unicode tables that the tokenizer files are read with."""
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for part in (range(0xD800), range(0xE000, 0x110000)):
        every = "".join(map(chr, part))
        for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+")):
            runs = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every)
            for run, _ in runs:
                kinds[ord(run[0]):ord(run[-1]) + 1] = kind
    kinds[WHITE] = SPACE
    return kinds


@lru_cache(maxsize=1)
def own_lower() -> tuple[re.Pattern, dict[int, str]]:
    """Capitals that ``str.lower`` does not treat as the tokenizers do: sigma, and letters newer than its Unicode tables."""
    unknown = "".join(chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)] if unicodedata.category(chr(c)) == "Cn")
    pairs = zip(unknown, normalizers.Lowercase().normalize_str(unknown), strict=True)
    changed = {ord("Σ"): "σ"} | {ord(c): low for c, low in pairs if c != low}
    return re.compile("[" + "".join(map(chr, changed)) + "]"), changed


def lookahead(merges: list[tuple[int, int]], made: list[int], lengths: np.ndarray) -> int:
    """Bytes of a stream that fix its first token (see the module's docstring)."""
    reach = np.zeros(len(lengths), dtype=np.int64)
    rivals: dict[int, int] = {}
    for (u, v), t in zip(merges, made):
        reach[t] = max(reach[v], reach[u] - lengths[v], rivals.get(v, 0), 0)
        rivals[u] = max(rivals.get(u, 0), int(lengths[v] + reach[t]))
    return int((lengths + reach).max())


class PairTable:
    """Rank and product of every merge, looked up for whole arrays of pairs (open addressing)."""

    def __init__(self, merges: list[tuple[int, int]], made: list[int]):
        bits = max(10, (8 * len(merges)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << bits, NO_RANK, dtype=np.int32)
        self.made = np.array(made, dtype=np.int64)
        self.mask = np.int64((1 << bits) - 1)
        keys = np.array([(u << 32) | v for u, v in merges], dtype=np.uint64)
        for key, rank, slot in zip(keys, range(len(merges)), self.slots(keys)):
            while self.ranks[slot] != NO_RANK:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.ranks[slot] = key, rank

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slots = self.slots(keys)
        out = self.ranks[slots]
        lost = np.flatnonzero((self.keys[slots] != keys) & (out != NO_RANK))
        while len(lost):
            slots[lost] = (slots[lost] + 1) & self.mask
            out[lost] = self.ranks[slots[lost]]
            lost = lost[(self.keys[slots[lost]] != keys[lost]) & (out[lost] != NO_RANK)]
        return out


class Vocabulary:
    """Symbols, merges, lookahead and special tokens of a byte-level tokenizer file with word-end marks."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        ids, self.end = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.strings = [""] * size
        for s, i in [*ids.items(), *self.special.items()]:
            self.strings[i] = s
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], dtype=np.int64)
        self.final = np.array([ids[c + self.end] for c in letters], dtype=np.int64)
        pairs, made = [(ids[a], ids[b]) for a, b in merges], [ids[a + b] for a, b in merges]
        born = {t: r for r, t in enumerate(made)}
        if len(born) < len(made) or any(max(born.get(u, -1), born.get(v, -1)) >= r for r, (u, v) in enumerate(pairs)):
            raise ValueError("the merge list is not proper: a merge must follow those that make its parts, and make a token of its own")
        self.lengths = np.zeros(size, dtype=np.int64)
        self.lengths[self.inner] = self.lengths[self.final] = 1
        for (u, v), t in zip(pairs, made):
            self.lengths[t] = self.lengths[u] + self.lengths[v]
        self.pairs = PairTable(pairs, made)
        self.lookahead = lookahead(pairs, made, self.lengths)
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None


def normalised(text: str) -> str:
    """Composed and lower-cased, each character for itself (no final sigma)."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    some, table = own_lower()
    return (text.translate(table) if some.search(text) else text).lower()


def split_words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of a normalised text, with the bounds (in bytes) and the kind of its words."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    points = raw if text.isascii() else np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    kinds = np.concatenate([char_kinds()[points], np.zeros(4, np.uint8)])
    n = len(points)
    fresh = np.empty(n + 4, dtype=bool)
    fresh[0] = True
    fresh[1:] = kinds[1:] != kinds[:-1]
    # clitics: an apostrophe that starts a run, with the letters after it
    marks = np.flatnonzero((points == 39) & fresh[:n])
    if len(marks):
        after = np.concatenate([points, np.zeros(4, points.dtype)])
        one, two = after[marks + 1], after[marks + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        clitic = marks[short | long]
        fresh[clitic + 1] = False
        fresh[clitic + 2 + long[short | long]] = True
    fresh |= kinds == DIGIT
    starts = np.flatnonzero(fresh & (kinds != SPACE))
    stop = fresh | (kinds == SPACE)
    ends = np.flatnonzero(stop[1:] & (kinds[:-1] != SPACE)) + 1
    kinds = kinds[starts]
    if len(raw) != n:
        place = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))])
        starts, ends = place[starts], place[ends]
    return raw, starts, ends, kinds


def spread(offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of runs that start at ``offsets`` and have ``counts`` entries each."""
    total = np.cumsum(counts)
    return np.repeat(offsets - total + counts, counts) + np.arange(total[-1] if len(total) else 0)


class Encoder:
    """Encodes words, many at a time; holds the vocabulary's tables and nothing of the texts."""

    def __init__(self, vocabulary: Vocabulary, window: int = WINDOW):
        self.vocab = vocabulary
        self.window = max(window, 2 * vocabulary.lookahead)

    def merged(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merge list applied to windows of ``counts`` symbols: their tokens, and tokens per window."""
        rank_of, made = self.vocab.pairs.rank, self.vocab.pairs.made
        done_at, done_tokens, done_counts = [], [], []
        names = np.arange(len(counts))
        while len(names):
            starts = np.cumsum(counts) - counts
            ranks = np.full(len(symbols), NO_RANK, dtype=np.int32)
            ranks[:-1] = rank_of(symbols[:-1], symbols[1:])
            ranks[starts[1:] - 1] = NO_RANK
            least = np.minimum.reduceat(ranks, starts)
            going = least != NO_RANK
            if not going.all():
                over = np.repeat(~going, counts)
                done_at.append(names[~going])
                done_counts.append(counts[~going])
                done_tokens.append(symbols[over])
                symbols, ranks, names, counts, least = symbols[~over], ranks[~over], names[going], counts[going], least[going]
                if not len(names):
                    break
                starts = np.cumsum(counts) - counts
            hits = np.flatnonzero(ranks == np.repeat(least, counts))
            if len(hits) > 1 and (hits[1:] == hits[:-1] + 1).any():  # aaa: the left pair first
                run = np.concatenate([[True], hits[1:] != hits[:-1] + 1])
                first = hits[np.flatnonzero(run)]
                hits = hits[(hits - first[np.cumsum(run) - 1]) % 2 == 0]
            symbols[hits] = made[ranks[hits]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hits + 1] = False
            symbols = symbols[keep]
            counts = counts - np.bincount(np.searchsorted(starts, hits, side="right") - 1, minlength=len(counts))
        if not done_at:
            return symbols, counts
        order = np.argsort(np.concatenate(done_at))
        counts, tokens = np.concatenate(done_counts), np.concatenate(done_tokens)
        offsets = np.cumsum(counts) - counts
        return tokens[spread(offsets[order], counts[order])], counts[order]

    def words(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, closed: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of words given by their bytes; tokens per word; bytes used of each.

        With ``closed`` false the words may go on, and only stable tokens leave.
        """
        vocab, n = self.vocab, len(starts)
        at, live = starts.copy(), np.arange(n)
        found = []
        while len(live):
            lengths = np.minimum(ends[live] - at[live], self.window)
            whole = (at[live] + lengths == ends[live]) & closed
            symbols = vocab.inner[raw[spread(at[live], lengths)]]
            tails = np.cumsum(lengths) - 1
            symbols[tails[whole]] = vocab.final[raw[at[live] + lengths - 1][whole]]
            tokens, counts = self.merged(symbols, lengths)
            if whole.all():
                at[live] = ends[live]
                found.append((live, tokens, counts))
                break
            # of an open window, the tokens that start at least the lookahead before its end are stable
            offsets = np.cumsum(counts) - counts
            sizes = vocab.lengths[tokens]
            ended = np.cumsum(sizes)
            begun = ended - sizes - np.repeat((ended - sizes)[offsets], counts)
            stable = np.repeat(whole, counts) | (begun <= np.repeat(lengths - vocab.lookahead, counts))
            used = np.add.reduceat(np.where(stable, sizes, 0), offsets)
            counts = np.add.reduceat(stable.astype(np.int64), offsets)
            found.append((live, tokens[stable], counts))
            at[live] += used
            live = live[~whole & (used > 0)] if closed else live[(used > 0) & (at[live] < ends[live])]
        if len(found) == 1 and len(found[0][0]) == n:
            return found[0][1], found[0][2], at - starts
        names = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
        counts = np.concatenate([f[2] for f in found]) if found else np.empty(0, np.int64)
        tokens = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)
        order = np.argsort(names, kind="stable")
        offsets = np.cumsum(counts) - counts
        per_word = np.bincount(names, weights=counts, minlength=n).astype(np.int64)
        return tokens[spread(offsets[order], counts[order])], per_word, at - starts

    def distinct_words(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of closed words, and tokens per word; equal words of up to 16 bytes are merged once."""
        if not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lengths = ends - starts
        padded = np.concatenate([raw, np.zeros(16, np.uint8)])
        eights = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), shape=(len(padded) - 7,), strides=(1,))
        masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
        head = eights[starts] & masks[np.minimum(lengths, 8)]
        tail = eights[np.minimum(starts + 8, len(eights) - 1)] & masks[np.clip(lengths - 8, 0, 8)]
        key = (head * np.uint64(0x9E3779B97F4A7C15)) ^ (tail * np.uint64(0xC2B2AE3D27D4EB4F) + lengths.astype(np.uint64) * np.uint64(0x165667B19E3779F9))
        codes, kept = pd.factorize(key)
        chosen = np.empty(len(kept), dtype=np.int64)
        chosen[codes[::-1]] = np.arange(len(codes))[::-1]
        own = chosen[codes]
        odd = np.flatnonzero((lengths > 16) | (head != head[own]) | (tail != tail[own]) | (lengths != lengths[own]))
        if len(odd):  # long words, and words whose keys collide, stand for themselves
            codes[odd] = len(chosen) + np.arange(len(odd))
            chosen = np.concatenate([chosen, odd])
        tokens, counts, _ = self.words(raw, starts[chosen], ends[chosen])
        offsets = np.cumsum(counts) - counts
        return tokens[spread(offsets[codes], counts[codes])], counts[codes]

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without special tokens, all at once."""
        parts = [normalised(t) for t in texts]
        bounds = np.cumsum([len(p.encode("utf-8", "replace")) + 1 for p in parts])
        raw, starts, ends, _ = split_words("\n".join(parts))
        tokens, counts = self.distinct_words(raw, starts, ends)
        last = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, bounds)]
        return np.split(tokens, last[:-1])


def cuts(text: str, size: int) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut before white space, or else between two characters that
    neither compose nor stand near an apostrophe."""
    at = 0
    while len(text) - at > size:
        end = at + size
        for place in range(end, min(end + 2000, len(text))):
            if text[place] in " \n\t\r":
                end = place
                break
        else:
            while end < len(text) and ("'" in text[max(0, end - 3):end + 3] or unicodedata.combining(text[end]) or not unicodedata.is_normalized("NFC", text[end - 1:end + 1])):
                end += 1
        yield text[at:end]
        at = end
    yield text[at:]


class Stream:
    """The transducer for one text given in parts: ``feed`` returns the ids that are stable, ``close`` the rest.

    Between parts it holds the bytes of an open word that no stable token covers, at most a window.
    """

    def __init__(self, encoder: Encoder):
        self.encoder, self.kind, self.held = encoder, SPACE, np.empty(0, np.uint8)

    def word(self, closed: bool) -> np.ndarray:
        if not len(self.held):
            return np.empty(0, np.int64)
        tokens, _, used = self.encoder.words(self.held, np.array([0]), np.array([len(self.held)]), closed)
        self.held = self.held[int(used[0]):]
        return tokens

    def feed(self, part: str) -> np.ndarray:
        if not part:
            return np.empty(0, np.int64)
        raw, starts, ends, kinds = split_words(normalised(part))
        out = []
        if self.kind != SPACE:
            if len(starts) and starts[0] == 0 and kinds[0] == self.kind:
                self.held = np.concatenate([self.held, raw[:ends[0]]])
                if ends[0] == len(raw):
                    return self.word(False)
                starts, ends, kinds = starts[1:], ends[1:], kinds[1:]
            out.append(self.close())
        opened = len(starts) and ends[-1] == len(raw) and kinds[-1] != DIGIT
        n = len(starts) - 1 if opened else len(starts)
        out.append(self.encoder.distinct_words(raw, starts[:n], ends[:n])[0])
        if opened:
            self.kind, self.held = int(kinds[-1]), raw[starts[-1]:]
            out.append(self.word(False))
        return np.concatenate(out)

    def close(self) -> np.ndarray:
        tokens, self.kind = self.word(True), SPACE
        return tokens


def segments(text: str, vocabulary: Vocabulary) -> Iterator[str | int]:
    """The text between special tokens, and their ids."""
    at = 0
    if vocabulary.specials:
        for m in vocabulary.specials.finditer(text):
            yield text[at:m.start()]
            yield vocabulary.special[m.group()]
            at = m.end()
    yield text[at:]


def streamed(encoder: Encoder, text: str, part: int = PART) -> Iterator[np.ndarray]:
    """The ids of one text, part by part."""
    for segment in segments(text, encoder.vocab):
        if isinstance(segment, int):
            yield np.array([segment])
            continue
        stream = Stream(encoder)
        for piece in cuts(segment, part):
            yield stream.feed(piece)
        yield stream.close()


def encoded(encoder: Encoder, texts: list[str | None], part: int = PART, batch: int = BATCH) -> Iterator[Iterator[np.ndarray]]:
    """For each text, in order, the parts of its ids: short texts side by side, others as streams."""
    held: list[str] = []
    size = 0

    def simple(text: str) -> bool:
        return len(text) <= part and not (encoder.vocab.specials and encoder.vocab.specials.search(text))

    for text in texts:
        text = text or ""
        if simple(text):
            held.append(text)
            size += len(text)
            if size < batch:
                continue
            text = None
        if held:
            yield from (iter([ids]) for ids in encoder.texts(held))
            held, size = [], 0
        if text is not None:
            yield streamed(encoder, text, part)
    if held:
        yield from (iter([ids]) for ids in encoder.texts(held))


class Decoder:
    """Ids to text, in parts of any length; ``close`` ends an unfinished character."""

    def __init__(self, vocabulary: Vocabulary, restore: bool = False):
        self.machine, self.begun, self.restore = codecs.getincrementaldecoder("utf-8")("replace"), False, restore
        self.table = byte_table(vocabulary) if restore else string_table(vocabulary)

    def feed(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        if self.restore:
            return self.machine.decode(b"".join(self.table[ids].tolist()))
        lead, self.begun = b" " if self.begun else b"", True
        return self.machine.decode(lead + b" ".join(self.table[ids].tolist()))

    def close(self) -> str:
        return self.machine.decode(b"", True)


def string_table(vocabulary: Vocabulary) -> np.ndarray:
    """The UTF-8 bytes of each vocabulary string."""
    if not hasattr(vocabulary, "as_strings"):
        vocabulary.as_strings = np.array([s.encode() for s in vocabulary.strings], dtype=object)
    return vocabulary.as_strings


def byte_table(vocabulary: Vocabulary) -> np.ndarray:
    """The bytes that each token stands for, with a blank after a word's end."""
    if not hasattr(vocabulary, "as_bytes"):
        value = {c: b for b, c in enumerate(byte_letters())}

        def of(s: str) -> bytes:
            if s in vocabulary.special:
                return s.encode()
            ended = s.endswith(vocabulary.end)
            body = s[:-len(vocabulary.end)] if ended else s
            return bytes(value[c] for c in body) + b" " * ended

        vocabulary.as_bytes = np.array([of(s) for s in vocabulary.strings], dtype=object)
    return vocabulary.as_bytes


@lru_cache(maxsize=2)
def encoder_of(content: str) -> Encoder:
    return Encoder(Vocabulary(content))


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def carried(docs: DataFrame, carry: list[str] | None, value: str) -> DataFrame:
    return docs.select(F.struct(*(carry or docs.columns)).alias("doc"), F.col(value).alias("value"))


def encode(docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``doc`` (the carried columns) and ``ids``: little-endian unsigned 32-bit numbers of the whole text.

    The tokenizer file (of fixed size) is read on the driver and broadcast.
    """
    rows = carried(docs, carry, text)
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(content.value)
        for batch in batches:
            ids = [b"".join(p.astype("<u4").tobytes() for p in parts) for parts in encoded(encoder, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc", "ids"])

    return rows.mapInArrow(run, rows.select("doc").schema.add("ids", "binary"))


def decode(encoded_docs: DataFrame, path: str, restore: bool = False) -> DataFrame:
    """``doc`` and the ``text`` of its ``ids`` (null ids: null)."""
    rows = encoded_docs.select("doc", "ids")
    content = encoded_docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def one(vocabulary: Vocabulary, ids: bytes | None) -> str | None:
        if ids is None:
            return None
        decoder, numbers = Decoder(vocabulary, restore), np.frombuffer(ids, "<u4")
        return "".join([*(decoder.feed(numbers[i:i + PART]) for i in range(0, len(numbers), PART)), decoder.close()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder_of(content.value).vocab
        for batch in batches:
            texts = [one(vocabulary, ids.as_py()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc", "text"])

    return rows.mapInArrow(run, rows.select("doc").schema.add("text", "string"))


def round_trip(docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``doc``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: ids are encoded, decoded and hashed part by
    part, so that neither a document's ids nor its decoded text are ever held whole."""
    rows = carried(docs, carry, text)
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(content.value)
        for batch in batches:
            found = []
            for parts in encoded(encoder, batch.column(1).to_pylist()):
                n, ids, back, decoder = 0, hashlib.sha256(), hashlib.sha256(), Decoder(encoder.vocab)
                for part in parts:
                    n += len(part)
                    ids.update(part.astype("<u4").tobytes())
                    back.update(decoder.feed(part).encode())
                back.update(decoder.close().encode())
                found.append((n, ids.hexdigest(), back.hexdigest()))
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                                             names=["doc", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, rows.select("doc").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string"))
