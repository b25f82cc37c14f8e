import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyguard.llm import lexical_search
from tests.llm.data import awkward, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(rows, items, k):
    docs = [(i, Counter(words(t)), len(words(t))) for i, t in rows]
    n, total = sum(c > 0 for *_, c in docs), sum(c for *_, c in docs)
    held = {}
    for i, t in items:
        if i is not None:
            held.setdefault(i, set()).update(words(t))
    df = {w: sum(w in c for _, c, _ in docs) for w in set().union(*held.values(), set())}
    out = []
    for item, asked in held.items():
        scores = []
        for i, c, size in docs:
            m = 10 + 90 * size * n // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10 ** 9 * c[w] // (1000 * c[w] + 8 * m))
                    for w in asked if w in c)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=repr_key)[:k], 1)]
    return sorted(out)


def repr_key(r):
    return r[0], r[1], r[2] or 0


ITEMS = [(1, "an er th"), (2, None), (3, ""), (4, "a b A"), (5, "漢字 É é zz"), (6, "an er th"), (6, "x1 kamo"), (None, "an"),
         (7, "nowhere_at_all"), (8, " ".join(f"w{i}" for i in range(40))), (9, "ERTHAN, on; re st"), (1, "an er th")]


@pytest.fixture(scope="module")
def tables(spark):
    rows = awkward(more=150) + [(700 + i, " ".join(f"w{j}" for j in range(i % 41))) for i in range(60)]
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id long, text string, doc_id string, score int")
    return rows, frame(spark, rows), items


@pytest.mark.parametrize("k,postings,at_once", [(10, 1 << 20, 1 << 21), (3, 9, 50), (1000, 1, 1)])
def test_ranks_match_a_plain_scorer(tables, k, postings, at_once):
    rows, docs, items = tables
    got = lexical_search.rank_documents(docs, items, k=k, postings=postings, at_once=at_once).collect()
    expected = plain(rows, ITEMS, k)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert len({(r.item_id, r["rank"]) for r in got}) == len(got) > 15


def test_terms_are_cut_where_the_pattern_cuts():
    every = "".join(chr(c) for c in range(0x250)) + "K漢 x y"
    assert [t.decode() for t in lexical_search.terms(every)] == words(every)


def test_many_tasks_share_the_merge(spark, tables):
    rows, docs, items = tables
    got = lexical_search.rank_documents(docs.repartition(70), items).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(plain(rows, ITEMS, 10), key=key)


def test_nothing_to_rank(spark, tables):
    _, docs, items = tables
    none = items.limit(0)
    assert lexical_search.rank_documents(docs, none).collect() == []
    assert lexical_search.rank_documents(docs.limit(0), items).collect() == []
    assert lexical_search.rank_documents(docs.where(F.col("text") == " "), items).collect() == []
    assert lexical_search.rank_documents(docs, items).columns == ["item_id", "rank", "doc_id", "score"]
