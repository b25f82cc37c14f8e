import math
import random

import pytest

from tallyguard.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, no string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "a", "b", "c", "d") for i, v in rows], SCHEMA).repartition(3).cache()


def plain(rows, k, every):
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ints if i % every == 0}):
        own = max((v for i, v in ints if i == q), key=lambda v: (sum(x * x for x in v), v))
        best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in ints if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def vectors(seed, n, width):
    rng = random.Random(seed)
    import numpy as np
    f = lambda x: float(np.float32(x))
    rows = [(i, [f(rng.gauss(0, 1) / (1 + j)) * (1 + i % 7) for j in range(width)]) for i in range(n)]
    rows = [(i, [f(x) for x in v]) for i, v in rows]
    same = [f(x) for x in rows[3][1]]
    rows += [(n + i, same) for i in range(n // 2)]  # a common vector, all ties
    rows += [(5000, None), (5050, [float("nan")] * width), (5100, [float("inf")] * width), (5150, [None] * width), (None, same),
             (5200, []), (5250, [1.0]), (5300, [0.0] * width), (5350, [-2.0] * (width + 2)), (50, rows[50][1])]
    return rows


@pytest.mark.parametrize("group,block,lead", [(32768, 32768, 0.9), (40, 3, 0.5), (64, 100, 1.0)])
def test_equals_all_inner_products(spark, group, block, lead):
    rows = vectors(1, 220, 12)
    got = topk.top_inner_products(table(spark, rows), 5, 50, group=group, block=block, lead_share=lead).collect()
    assert sorted(map(tuple, got)) == plain(rows, 5, 50)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 0.5]), (50, [-1.0, 1.0])]
    got = topk.top_inner_products(table(spark, rows), 5, 50).collect()
    assert sorted(map(tuple, got)) == plain(rows, 5, 50)


def test_empty_table(spark):
    assert topk.top_inner_products(table(spark, [])).collect() == []
    assert topk.top_inner_products(table(spark, [(0, [1.0]), (50, None)])).collect() == []
