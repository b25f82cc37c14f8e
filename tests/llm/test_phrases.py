import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyguard.llm import phrases
from tests.llm.data import awkward

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, longest, least, share, top):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    held = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    around = {}
    for (lang, ws), a in held.items():
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                part = lang, ws[i:i + k]
                around[part] = max(around.get(part, 0), a)
    by = {}
    for (lang, ws), a in held.items():
        if 100 * around.get((lang, ws), -1) >= share * a:
            continue
        score, _, left, right = min((10 ** 6 * a * a // (counts[lang, ws[:j]] * counts[lang, ws[j:]]), j,
                                     counts[lang, ws[:j]], counts[lang, ws[j:]]) for j in range(1, len(ws)))
        by.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, sizes[lang], -s) for lang, found in by.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def made(spark, rows):
    full = [(lang, text, "s", 1, 2) for lang, text in rows]
    return spark.createDataFrame(full, "lang string, text string, word string, id int, n int").repartition(4)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    rows = [(rng.choice(["en", "de", None, "und"]), t) for _, t in awkward(more=100)]
    few = "Aa b. c,d e é 漢字 \x1c f".split(" ")
    for _ in range(120):
        rows.append((rng.choice(["en", "en", "de"]), rng.choice([" ", "\t", "  "]).join(rng.choice(few) for _ in range(rng.randint(0, 60)))))
    rows += [("xx", "one two three four " * 40), ("xx", "same " * 200), ("yy", ""), ("yy", None), ("zz", "a b! a b? a b\x0ba b"),
             ("en", "long run of words. " * 30)]
    return rows


@pytest.mark.parametrize("longest,least,share,top,sizes", [
    (3, 10, 50, 2000, {}),
    (3, 2, 50, 40, {"shard": 50, "trie": 3000, "buckets": 64, "chunk": 8}),
    (4, 3, 80, 2000, {"shard": 1, "trie": 3000, "buckets": 1 << 12, "chunk": 1000}),
    (2, 1, 50, 5, {"trie": 6000, "buckets": 1}),
    (3, 190, 50, 9, {})])
def test_phrases_match_a_plain_count(spark, rows, longest, least, share, top, sizes):
    got = phrases.collocations(made(spark, rows), longest, least, share, top, **sizes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = plain(rows, longest, least, share, top)
    assert sorted(map(tuple, got.collect())) == expected and expected


def test_no_phrases(spark, rows):
    assert phrases.collocations(made(spark, rows).limit(0)).collect() == []
    assert phrases.collocations(made(spark, [("en", None), ("en", ""), (None, "one two")])).collect() == []


def test_scores_beyond_64_bits_are_exact(spark):
    table = spark.createDataFrame([(3 * 10 ** 12 - 1, 3 * 10 ** 12, 3 * 10 ** 12 + 7)], "a long, l long, r long")
    a, left, right = 3 * 10 ** 12 - 1, 3 * 10 ** 12, 3 * 10 ** 12 + 7
    assert table.select(phrases._score(table.a, table.l, table.r)).first()[0] == 10 ** 6 * a * a // (left * right)


def test_the_trie_holds_what_was_put_in_and_nothing_else():
    rng = np.random.default_rng(4)
    rows = np.unique(np.minimum(rng.geometric(0.02, (6000, 4)), 255), axis=0)
    trie = phrases.DoubleArray.build(rows)
    walk = lambda table: [trie.step(s, table[:, d]) for s in [np.zeros(len(table), np.int64)] for d in range(1)][0]

    def ends(table):
        s, alive = np.zeros(len(table), np.int64), np.ones(len(table), bool)
        for d in range(4):
            s = trie.step(s, table[:, d])
            alive &= s > 0
        return np.where(alive, s, 0)

    found = ends(rows)
    assert (walk(rows) > 0).all() and (found > 0).all() and len(set(found.tolist())) == len(rows)
    back, states = np.zeros_like(rows), found
    for d in reversed(range(4)):
        states, back[:, d] = trie.up(states)
    assert (back == rows).all() and (states == 0).all()
    other = rng.integers(0, 256, (50_000, 4))
    known = set(map(tuple, rows.tolist()))
    assert [s > 0 for s in ends(other).tolist()] == [tuple(r) in known for r in other.tolist()]


def test_phrases_and_counts_are_shuffled_in_columns(spark, rows, monkeypatch):
    """A row for each task and part, not one for each phrase, and a shard's words are moved once."""
    plans, real = {}, phrases.stage

    def watched(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, label)
    monkeypatch.setattr(phrases, "stage", watched)
    phrases.collocations(made(spark, rows), 2, 3)
    assert plans["numbered-shards"].count("SortMergeJoin") <= 1 and "CoGroup" in plans["numbered-shards"]
    assert "phrases" in plans["candidates-2"] and not any("HashAggregate" in plans[x] for x in ("candidates-2", "phrases-2"))


@pytest.mark.parametrize("k", [1, 2, 3])
def test_packed_rows_come_back(k):
    rng = np.random.default_rng(k)
    words = [rng.integers(1, 1 << 40, 5000) % 50 * (1 << 33) + rng.integers(0, 9, 5000) for _ in range(k)]
    got, part = phrases._distinct(words, words[0] % 3)
    assert sorted(set(zip(*(w.tolist() for w in words)))) == sorted(zip(*(w.tolist() for w in got)))
    assert part.tolist() == sorted(part.tolist()) and (got[0] % 3 == part).all()
    own, _ = phrases._distinct(words)
    assert [w.tolist() for w in phrases._unpacked(phrases._packed(own), k)] == [w.tolist() for w in own]
    assert [w.tolist() for w in phrases._unpacked(phrases._packed([w[:0] for w in own]), k)] == [[]] * k


def test_the_shards_are_read_twice_a_level_whatever_the_number_of_tries(spark, rows, monkeypatch):
    labels, real = Counter(), phrases.stage

    def watched(df, label):
        labels[label] += 1
        return real(df, label)
    monkeypatch.setattr(phrases, "stage", watched)
    got = phrases.collocations(made(spark, rows), 3, 2, 50, 40, trie=20)
    assert sorted(map(tuple, got.collect())) == plain(rows, 3, 2, 50, 40)
    assert all(labels[f"{what}-{k}"] == 1 for what in ("candidates", "phrases") for k in (2, 3)), labels


@pytest.mark.parametrize("size", [30, 10 ** 6])
def test_rows_of_a_part_are_summed_for_each_phrase(size):
    rng = np.random.default_rng(size)
    words = [rng.geometric(0.05, 20_000) * 999_983, rng.integers(1, 300, 20_000), rng.geometric(0.3, 20_000)]
    own = phrases._bucket(words, 7) == 4
    words, times = [w[own] for w in words], rng.integers(1, 4, int(own.sum()))
    expected = Counter()
    for *phrase, n in zip(*(w.tolist() for w in words), times.tolist()):
        expected[tuple(phrase)] += n
    got = [row for found in phrases._counted_part(words, times, 5, 7, size) for row in zip(*(c.tolist() for c in found))]
    assert sorted(got) == sorted((*phrase, n) for phrase, n in expected.items() if n >= 5) and got
    columns, sums = phrases._summed(words, times)
    assert dict(zip(zip(*(c.tolist() for c in columns)), sums.tolist())) == expected


def test_leading_rows_of_a_language_keep_those_that_tie(spark):
    table = spark.createDataFrame([("en", s, a, i % 2) for i, (s, a) in enumerate([(9, 1), (9, 2), (8, 5), (8, 5), (8, 5), (8, 4)])]
                                  + [("de", 1, 1, 0)], "lang string, score long, a long, half int")
    some = phrases._leading(table, 2, table.half)
    assert {(r.lang, r.score, r.a) for r in some.collect()} >= {(r.lang, r.score, r.a) for r in phrases._leading(table, 3).collect()}
    assert sorted((r.lang, r.score, r.a) for r in phrases._leading(table, 3).collect()) == [
        ("de", 1, 1), ("en", 8, 5), ("en", 8, 5), ("en", 8, 5), ("en", 9, 1), ("en", 9, 2)]
