"""BPE transducer: against the tokenizers library, over windows and parts of all sizes; exact round trips; defined cases."""

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from astroframe.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = ["'s", "'re", "'ll", "''s", "it's", "'", "-", "...", "1a2", "é", "é", "ΣΑΣ", "ß", "ǅ", "日本語", "🙂", "‍", "\x00", "a\tb", " ", "<|endoftext|>",
         "<|startoftext|>", "<|end", "İ", "ﬁ", "x'd'm've", "don't've"]


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(PATH)
    own.no_truncation()
    own.no_padding()
    return own


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_vocabulary(PATH))


def ids(encoder, text, part=bpe.PART):
    return np.concatenate(list(bpe.streamed(encoder, text, part))).tolist()


def noise(rng, n):
    return "".join(rng.choice(SIGNS + [" ", " ", "\n", "the", "tion", "Qu", "ll", "aaaa", "z" * 9]) for _ in range(n))


def test_batches_equal_the_library(library, vocabulary):
    rng = random.Random(1)
    texts = [noise(rng, rng.randint(0, 60)) for _ in range(400)] + [None, "", " ", "'", "a" * 5000, "'s" * 300]
    got = [np.concatenate(list(parts)).tolist() for parts in bpe.encoded(bpe.Encoder(vocabulary), texts, batch=500)]
    assert got == [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("part", [1, 7, 64, 4000])
def test_streams_equal_the_library(library, vocabulary, part):
    """Parts that end anywhere, within words longer than many windows."""
    rng = random.Random(part)
    encoder = bpe.Encoder(vocabulary, 1)  # the least window: twice the lookahead
    for _ in range(6):
        text = noise(rng, 50) + "".join(rng.choice("etaoinshr") for _ in range(1500)) + "é" * 300 + "ab" * 400 + "!?" * 300 + noise(rng, 30)
        assert ids(encoder, text, part) == library.encode(text, add_special_tokens=False).ids


def test_a_stream_holds_a_window_at_most(vocabulary):
    encoder = bpe.Encoder(vocabulary)
    stream = bpe.Stream(encoder)
    for _ in range(40):
        stream.feed("thequickbrown" * 77)
        assert len(stream.held) <= encoder.window


def test_lookahead_is_sufficient_and_follows_the_merges(vocabulary):
    """The first tokens of a word do not change with what follows the lookahead."""
    rng, encoder = random.Random(3), bpe.Encoder(vocabulary)
    vocab = encoder.vocab
    strings = [s for s in vocab.strings[512:20000:37] if not s.endswith("</w>") and s.isascii()]
    for _ in range(60):
        word = "".join(rng.choice(strings) for _ in range(60)).encode()
        raw = np.frombuffer(word, np.uint8)
        full = encoder.words(raw, np.array([0]), np.array([len(raw)]))[0].tolist()
        n = rng.randint(vocab.lookahead, len(raw))
        part = encoder.words(raw[:n], np.array([0]), np.array([n]), closed=False)[0].tolist()
        assert part and part == full[:len(part)]
    # two rival merges: (b, c) of rank 0 decides whether (a, b) of rank 1 can happen
    assert bpe.lookahead([(1, 2), (0, 1)], [3, 4], np.array([1, 1, 1, 2, 2])) == 3
    assert bpe.lookahead([(0, 1), (1, 2)], [3, 4], np.array([1, 1, 1, 2, 2])) == 2


def test_decoding(library, vocabulary):
    rng = random.Random(8)
    encoder = bpe.Encoder(vocabulary)
    for _ in range(30):
        found = np.array(ids(encoder, noise(rng, 40)) or [320])
        for size in (1, 3, 1000):
            decoder = bpe.Decoder(vocabulary)
            text = "".join(decoder.feed(found[i:i + size]) for i in range(0, len(found), size)) + decoder.close()
            assert text == library.decode(found.tolist(), skip_special_tokens=False)
    words = "the quick élan 日本 🙂 über"
    back = bpe.Decoder(vocabulary, restore=True)
    assert "".join([*(back.feed(np.array([i])) for i in ids(encoder, words)), back.close()]) == unicodedata.normalize("NFC", words) + " "


def test_round_trip_query_and_defined_cases(spark, make_docs, library):
    texts = ["Hello world", None, "", "it's <|endoftext|> é", "x" * 200_000, "Hello world"] + ["wörter und " * 20_000]
    docs = make_docs([(i, t) for i, t in enumerate(texts)]).withColumns({c: F.lit("mine") for c in ("doc", "ids", "value", "n_tokens")})
    got = {r["doc"]["doc_id"]: r for r in bpe.round_trip(docs, PATH).collect()}
    assert len(got) == len(texts) and got[0]["doc"]["n_tokens"] == "mine"
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(want)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    whole = bpe.decode(bpe.encode(docs, PATH), PATH, restore=True).collect()
    assert {r["doc"]["doc_id"]: r["text"] for r in whole}[0] == "hello world "
    assert bpe.round_trip(make_docs([]), PATH).collect() == []
