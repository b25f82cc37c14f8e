import io
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyguard.llm import packing, token_counts, token_files
from tallyguard.llm.encoders import Encoder
from tests.llm.data import awkward, frame

BYTE, WORD, RANKS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def rows():
    return awkward(more=25)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


def plain(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_library(path):
    rng, encode, ours = random.Random(3), plain(path), Encoder(path)
    alphabet = [" ", "\n", "\t", "\r", "\x0b", "a", "Bc", "é", "É", ".", ",", "1", "'s", "　", "\xa0", "漢", "\x1c", "́",
                "İ", "Σ", "<|endoftext|>", " thand", "\x85", "😀", "</w>", "ß", "ª", "ﬁ"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    for t in texts + [t for _, t in awkward() if t] + [x * 200 for x in alphabet]:
        ids = encode(t)
        assert ours.encode(t) == struct.pack(f"<{len(ids)}I", *ids), repr(t)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing_places_every_piece_once(docs, rows, capacity):
    encode = plain(BYTE)
    expected = []
    for i, t in rows:
        ids = encode(t) + [0]
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    got = packing.packed_documents(docs, BYTE, capacity, 0).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([tuple(r[:5]) for r in got], key=key) == sorted(expected, key=key)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(e[3] for e in expected)
    assert len(bins) <= 1.15 * -(-total // capacity) + 1


def test_packing_in_several_rounds_and_tasks(spark):
    rng = random.Random(4)
    sizes = [rng.randint(1, 999) for _ in range(9000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, length long")
    got = packing.pack(items, 1000, per_task=500).collect()
    assert sorted((r.item, r.length) for r in got) == list(enumerate(sizes))
    bins = defaultdict(int)
    for r in got:
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 1000
    assert len(bins) <= 1.03 * sum(sizes) / 1000 + 2


def test_items_that_cannot_be_joined_end_the_rounds(spark):
    items = spark.range(3000).selectExpr("id as item", "cast(600 as long) as length")
    got = packing.pack(items, 1000, per_task=200).collect()
    assert len({r.sequence_id for r in got}) == len(got) == 3000 and {r.offset for r in got} == {0}


def test_best_fit_takes_the_fullest_bin():
    place, offset, n = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert n == 2 and sorted(zip(place.tolist(), offset.tolist())) == [(0, 0), (0, 6), (1, 0), (1, 5), (1, 8)]


def test_sequences_hold_the_ids(docs, rows):
    cut = packing.pieces(docs, BYTE, 256, 0)
    whole = packing.sequences(packing.pack(cut, 256)).collect()
    total = sum(len(plain(BYTE)(t)) + 1 for _, t in rows)
    assert sum(len(r.ids) for r in whole) == 4 * total and all(len(r.ids) <= 1024 for r in whole)


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        v = rng.integers(0, 1 << 17, n, dtype=np.uint32)
        assert (token_files.unplanes(token_files.planes(v, bits), n, v.dtype, bits) == v).all()


@pytest.mark.parametrize("bits", [False, True])
def test_a_file_gives_back_its_documents(tmp_path, bits):
    rng = np.random.default_rng(2)
    docs = [(None if i == 3 else i - 2, rng.integers(0, 60_000, n, dtype=np.uint32).tobytes())
            for i, n in enumerate([1, 0, 5000, 3, 64, 63, 65, 0, 9000])]
    sink = io.BytesIO()
    writer = token_files.Writer(sink, bits, block=64)
    for d, ids in docs:
        writer.add(d, ids)
    writer.close()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    reader = token_files.Reader(Source(sink.getvalue()))
    assert [(d, b"".join(p)) for d, n, p in reader.each()] == docs
    assert len(reader.index["chunks"]) == -(-sum(len(x) // 4 for _, x in docs) // 64)
    with pytest.raises(ValueError):
        token_files.Reader(Source(sink.getvalue()[:-3]))


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_round_trip(docs, rows, bits):
    encode = plain(WORD)
    got = sorted((tuple(r) for r in token_files.round_trip(docs, WORD, 1, bits).collect()), key=lambda r: r[1])
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    expected = []
    for i, t in rows:
        x = encode(t) + [1]
        expected.append((i, len(x), zlib.crc32(struct.pack(f"<{len(x)}I", *x))))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(i, n, c) for i, _, n, c in got], key=key) == sorted(expected, key=key)


def greedy(word, entries, longest):
    n = 0
    while word:
        size = next((k for k in range(min(longest, len(word)), 0, -1) if word[:k] in entries), 1)
        word, n = word[size:], n + 1
    return n


def test_automaton_equals_the_longest_match():
    rng = random.Random(6)
    for _ in range(60):
        entries = {bytes(rng.choice(b"abc ") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 25))}
        auto = token_counts.Automaton(entries)
        for _ in range(40):
            word = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 20)))
            assert auto.pieces(b" " + word) == greedy(b" " + word, entries, 6)


def test_token_counts_match_the_longest_match(docs, rows):
    entries = set(token_counts.rank_file(RANKS))
    longest = max(map(len, entries))
    expected = []
    for i, t in rows:
        words = (t or "").encode().split()
        expected.append((i, len(words), sum(greedy(b" " + w, entries, longest) for w in words)))
    key = lambda r: tuple((x is None, x) for x in r)
    got = [tuple(r) for r in token_counts.token_counts(docs, RANKS).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert packing.packed_documents(none, BYTE).collect() == []
    assert token_files.round_trip(none, WORD).collect() == []
    assert token_counts.token_counts(none, RANKS).collect() == []


def test_token_files_name_their_file_system(spark, tmp_path):
    assert [token_files._uri(u) for u in ("file:/a/b", "file:///a/b", "s3a://b/k", "hdfs://n:1/k")] == [
        "file:///a/b", "file:///a/b", "s3://b/k", "hdfs://n:1/k"]
    for bad in ("/a/b", "dbfs:/a/b", "a/b"):
        with pytest.raises(ValueError):
            token_files._uri(bad)
    docs = spark.createDataFrame([(2, "some words"), (1, "")], "doc_id long, text string")
    files = token_files.write_files(docs, WORD, str(tmp_path / "out")).collect()
    assert all(f.path.startswith("file:/") for f in files) and sum(f.n_docs for f in files) == 2


def test_packing_goes_on_while_a_round_joins_any(spark):
    """Many tasks at the end of the rounds: no two sequences of one task could be one, so few are half empty."""
    rng = random.Random(9)
    sizes = [rng.randint(1, 400) for _ in range(3000)] + [600] * 300
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, length long")
    filled = [r.n for r in packing.pack(items, 1000, per_task=60).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert sum(filled) == sum(sizes) and max(filled) <= 1000
    assert len(filled) <= 1.03 * -(-sum(sizes) // 1000) + 1


def test_a_worker_keeps_the_chunks_of_a_long_run():
    """What decides the CPU time of token ids: 400,000 different words are merged once."""
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    words = [f"x{i:x}" for i in range(400_000)]
    some = set(words[::50_000])
    for a in range(0, len(words), 20_000):
        encoder.encode("a " + " ".join(words[a:a + 20_000]))
    assert some <= encoder.rest.keys()
    assert len(encoder.first) + len(encoder.rest) <= encoder.limit
