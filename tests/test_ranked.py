import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import latency, quality, ranked, registry

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, math.nextafter(1, 2), math.nextafter(1, 0),
         2.0, 4.0, math.nextafter(4, 0), 3.0, 1e308, 1.7976931348623157e308, float("inf"), float("-inf"), -1.0, -3.5, 0.1, 100.0, 100.33]


def test_bits_order_as_the_doubles(spark):
    rng = random.Random(1)
    values = EDGES + [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(400)]
    values += [2.0 ** e for e in range(-1074, 1024, 7)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ranked.double_bits(F.col("v")).alias("b")).collect()
    by_value = sorted(rows, key=lambda r: r.v)
    for a, b in zip(by_value, by_value[1:]):
        assert (a.b < b.b) == (a.v < b.v) and (a.b == b.b) == (a.v == b.v), (a, b)
    odd = spark.createDataFrame([(float("nan"),), (None,), (float("inf"),)], "v double").select(ranked.double_bits(F.col("v")).alias("b"))
    nan, null, inf = [r.b for r in odd.collect()]
    assert null is None and nan > inf


def test_totals_below_with_null_keys_and_dense_values(spark):
    rng = random.Random(2)
    rows = [(k, v, rng.randint(1, 5)) for k in ("a", None) for v in {100 + 0.33 * rng.random() for _ in range(500)} | set(EDGES[6:])]
    rows = list({(k, v): (k, v, n) for k, v, n in rows}.values())
    df = spark.createDataFrame(rows, "k string, v double, n long")
    got = ranked.with_totals_below(df, ["k"], "v", ["n"], ranked.double_bits(F.col("v"))).collect()
    assert len(got) == len(rows)
    for r in got:
        own = [(v, n) for k, v, n in rows if k == r.k]
        assert r.n_total == sum(n for _, n in own) and r.n_below == sum(n for v, n in own if v < r.v)


def test_no_window_is_large_for_dense_values(spark):
    """A million different values within 0.3 percent: a window holds a small share of them."""
    bits = spark.range(1_000_000).select(ranked.double_bits(F.lit(100.0) + F.col("id") * F.lit(3e-7)).alias("b"))
    sizes = bits.groupBy(F.shiftright("b", ranked.SHIFTS[1])).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 2 ** 21 and sizes[1] > 100


def test_the_distribution_is_read_once(spark, tmp_path):
    spark.range(5000).select((F.col("id") % 977 / 7).alias("ms"), F.concat(F.lit("p"), F.col("id") % 3).alias("path")).write.parquet(str(tmp_path / "t"))
    df = latency.latency_percentiles(spark.read.parquet(str(tmp_path / "t")), keys=("path",))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert len(re.findall(r"Scan parquet", final)) - len(re.findall("ReusedExchange|ReusedSubquery", final)) <= 1, final


def test_percentiles_with_null_keys_and_odd_values(spark):
    rows = [(None, float(i)) for i in range(100)] + [("a", 1.0), ("a", float("inf")), ("a", None), ("a", float("nan")), ("b", None)]
    got = {r.k: (r.p95, r.p99) for r in latency.latency_percentiles(spark.createDataFrame(rows, "k string, ms double"), keys=("k",)).collect()}
    assert got == {None: (95.0, 99.0), "a": (float("inf"), float("inf"))}


def auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_evaluation_per_model(spark):
    rng = random.Random(3)
    rows = [(m, rng.random() < 0.4, round(rng.random(), 2)) for m in ("x", "y", None) for _ in range(200)]
    odd = [("x", True, None), ("x", None, 0.7), ("y", False, float("nan"))]
    df = spark.createDataFrame(rows + odd, "model string, label boolean, score double")
    got = {r.model: r for r in quality.evaluate_model(df, keys=("model",)).collect()}
    for m in ("x", "y", None):
        own = [(y, s) for k, y, s in rows if k == m]
        assert got[m].accuracy == pytest.approx(sum(y == (s > 0.5) for y, s in own) / len(own))
        assert got[m].auc_roc == pytest.approx(auc(own))
    assert {m: got[m].unscored for m in got} == {"x": 2, "y": 1, None: 0}
    areas = {r.model: r.auc_roc for r in quality.auc_roc(df, keys=("model",)).collect()}
    assert areas == {m: got[m].auc_roc for m in got}
    alone = quality.evaluate_model(df.filter("model = 'x'")).first()
    assert alone.auc_roc == got["x"].auc_roc and alone.unscored == 2


def test_drift_per_run(spark):
    base = spark.createDataFrame([("a", float(i)) for i in range(10)] + [("b", float(i)) for i in range(10)], "run string, v double")
    now = spark.createDataFrame([("a", float(i)) for i in range(10)] + [("b", 100.0)] * 10, "run string, v double")
    got = {r.run: r.drifted for r in quality.drift_score(base, now, "v", [5.0, 20.0], keys=("run",)).collect()}
    assert got == {"a": False, "b": True}


def test_candidates_without_a_time_and_with_equal_names(spark):
    known = spark.createDataFrame([], "model_name string, version string, alias string, stage string, run_id string, creation_timestamp timestamp, "
                                      "last_updated_timestamp timestamp, description string, tags map<string,string>")
    new = spark.createDataFrame([("m", "r1", {"depth": "3"}, {"depth": "0.5"}, "p", None), ("m", "r2", None, {"f1": "1"}, "p", None)],
                                "model_name string, run_id string, params map<string,string>, metrics map<string,string>, source_path string, ts timestamp")
    got = {r.run_id: (r.version, r.tags) for r in registry.register_version(known, new).collect()}
    assert got == {"r1": ("1", {"param.depth": "3", "metric.depth": "0.5"}), "r2": ("2", {"metric.f1": "1"})}
