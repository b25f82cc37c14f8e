import random
from collections import defaultdict

import numpy as np
import pytest

from tallyguard.llm import minhash
from tests.llm.data import awkward, frame, sentence
from tests.llm.test_dedup import classes


def plain_set(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain(rows, width, similarity):
    sets = [plain_set(t, width) for _, t in rows]
    linked = lambda i, j: sets[i] and 100 * len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])
    root, least = classes(len(rows), linked), {}
    for r, (i, _) in zip(root, rows):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [(i, len(s), least.get(r) if s else i, i == (least.get(r) if s else i)) for r, s, (i, _) in zip(root, sets, rows)]


def copies(rng, text, n, changes):
    for _ in range(n):
        words = text.split()
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = "w%d" % rng.randrange(10 ** 6)
        yield " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    rows = awkward(seed=6, more=60)
    texts = []
    for base, n, changes in ((sentence(rng, 60), 60, 2), (sentence(rng, 150), 25, 6), (sentence(rng, 9), 20, 1), (sentence(rng, 1000), 12, 60)):
        texts += copies(rng, base, n, changes)
    chain = sentence(rng, 70).split()
    for i in range(12):  # neighbours are near, the ends are not
        texts.append(" ".join(chain))
        chain[5 * i] = f"c{i}"
    shared = sentence(rng, 40)
    texts += [f"{shared} {sentence(rng, 25)}" for _ in range(25)]  # half in common, not near
    rows += [(1000 + i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, sentence(rng, 30)), (3, texts[3])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,similarity,sizes", [(4, 80, {}), (3, 60, {"group": 5})])
def test_classes_match_a_look_at_all_pairs(spark, rows, width, similarity, sizes):
    got = minhash.near_documents(frame(spark, rows), width, similarity, **sizes)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows, width, similarity), key=key)


def test_a_bucket_whose_first_set_is_near_to_none(spark, rows, monkeypatch):
    """With one bucket for all, the first comparison links little and the rounds have to find the rest, in blocks."""
    some = [r for r in rows if 2 < len((r[1] or "").split()) < 200]
    monkeypatch.setattr(minhash.F, "xxhash64", lambda *c, real=minhash.F.xxhash64: real(minhash.F.lit(1)) if len(c) > 2 else real(*c))
    got = minhash.near_documents(frame(spark, some), group=16).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(plain(some, 4, 80), key=key)


def test_no_documents(spark, rows):
    docs = frame(spark, rows)
    assert minhash.near_documents(docs.limit(0)).collect() == []
    only = minhash.near_documents(docs.where("text is null or text = ' '")).collect()
    assert only and all(r.n_shingles == 0 and r.component_id == r.doc_id for r in only)


def test_minima_agree_as_often_as_sets_do():
    rng = np.random.default_rng(2)
    share = []
    for _ in range(60):
        all_ = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
        a, b = minhash.minima(all_[:900]), minhash.minima(all_[100:])
        share.append((a == b).mean())
    assert abs(np.mean(share) - 0.8) < 0.02 and min(share) * minhash.MINIMA > minhash.least_agreement(80)


def test_shingles_are_sets_of_word_runs():
    assert len(minhash.shingles("a b c d a b c d a", 4)) == 4
    assert (minhash.shingles("A  b\x0bC\td", 4) == minhash.shingles("a b c d", 4)).all()
    assert len(minhash.shingles("a b", 4)) == 1 and len(minhash.shingles(" \n", 4)) == 0
    seen = defaultdict(set)
    for t in ("a b", "b a", "a b c", "c b a", "a", "a a", "a b c d", "d c b a"):
        seen[minhash.shingles(t, 4).tobytes()].add(t)
    assert len(seen) == 8
