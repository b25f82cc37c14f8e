import math
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyguard.operators import latency, quality, ranked, reports, skew


@pytest.fixture(scope="module")
def history(spark):
    """The 100 historical rows whose statistics are known."""
    return spark.range(100).select(
        F.concat(F.lit("user_"), (F.col("id") % 20).cast("string")).alias("user_id"),
        (F.lit(10.0) + F.col("id") * 0.5).alias("amount"), F.when(F.col("id") % 17 == 0, 1).otherwise(0).alias("is_fraud"))


def test_history_statistics(spark, history):
    assert quality.fraud_rate(history).first().asDict() == {"total": 100, "fraud": 6, "fraud_rate_pct": 6.0}
    stats = {r.user_id: r for r in quality.user_stats(history).collect()}
    assert len(stats) == 20 and {r.transaction_count for r in stats.values()} == {5}
    assert stats["user_0"].total_amount == Decimal("150.00") and stats["user_0"].fraud_count == 1
    about = quality.describe_amount(history).first()
    assert (about["count"], about["mean"], about["min"], about["max"]) == (100, 34.75, 10.0, 59.5)
    top = [r.user_id for r in quality.top_users(quality.user_stats(history)).collect()]
    assert top == sorted(stats)[:5]


def test_empty_inputs_answer_zero(spark, history):
    none = history.limit(0)
    assert quality.fraud_rate(none).first().asDict() == {"total": 0, "fraud": 0, "fraud_rate_pct": 0.0}
    ms = spark.createDataFrame([], "ms double, status string, seconds double, test_run_id string, timestamp timestamp")
    assert tuple(latency.latency_percentiles(ms).first()) == (0.0, 0.0, 0.0)
    assert tuple(latency.success_rate(ms, 0).first()) == (0, 0, 0, 0.0, 0.0)
    assert tuple(latency.model_serving_metrics(ms).first()) == (0, 0.0)
    assert tuple(reports.test_run_summary(ms, ()).first()) == (0, 0, 0, 0, 0.0, 0.0)


@pytest.mark.parametrize("n", [1, 2, 10, 20, 100, 101])
def test_percentile_index(spark, n):
    rows = spark.range(n).select(F.col("id").cast("double").alias("ms"))
    got = latency.latency_percentiles(rows).first()
    assert (got.p95, got.p99) == (float(int(n * 0.95)), float(int(n * 0.99)))


def test_percentiles_with_ties_signs_and_a_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot", rng.choice([-3.5, -0.001, 0.0, 1e-9, 7.0, rng.uniform(-5, 500)])) for _ in range(3000)]
    rows += [(f"k{i % 40}", rng.uniform(-1, 1)) for i in range(400)]
    got = {r.k: (r.p95, r.p99) for r in latency.latency_percentiles(
        spark.createDataFrame(rows, "k string, ms double"), keys=("k",)).collect()}
    for key in {k for k, _ in rows}:
        values = sorted(v for k, v in rows if k == key)
        assert got[key] == (values[int(len(values) * 0.95)], values[int(len(values) * 0.99)])


def _auc(rows):
    pos = [s for label, s in rows if label]
    neg = [s for label, s in rows if not label]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.sampled_from([0.0, 0.1, 0.2, 0.5, 0.8, 0.8001, 1.0])), min_size=1, max_size=60))
def test_auc_against_all_pairs(spark, rows):
    got = quality.auc_roc(spark.createDataFrame(rows, "label boolean, score double")).first().auc_roc
    if len({label for label, _ in rows}) == 2:
        assert got == pytest.approx(_auc(rows), abs=1e-12)
    else:
        assert got is None


def test_evaluation_agrees_with_its_parts(spark):
    rng = random.Random(5)
    rows = spark.createDataFrame([(rng.random() < 0.3, round(rng.random(), 2)) for _ in range(500)],
                                 "label boolean, score double")
    whole = quality.evaluate_model(rows).first()
    parts = quality.classification_metrics(rows.withColumn("prediction", F.col("score") > 0.5)).first()
    for name in ("accuracy", "precision", "recall", "f1_score"):
        assert whole[name] == parts[name]
    assert whole.auc_roc == quality.auc_roc(rows).first().auc_roc


def test_drift(spark):
    same = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert quality.drift_score(same, same, "x", [250.0, 500.0]).first().asDict() == {
        "feature": "x", "psi": 0.0, "drifted": False}
    assert quality.drift_score(same, same.filter("x > 600"), "x", [250.0, 500.0]).first().drifted


def test_freshness_needs_rows_and_time(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, d),) for d in range(1, 11)], "ts timestamp")
    def asked(min_records, as_of):
        return quality.freshness_check(rows, datetime(2024, 1, 4), as_of, min_records=min_records).first()
    assert asked(6, datetime(2024, 1, 11)).should_retrain and asked(6, datetime(2024, 1, 11)).new_records_available == 6
    assert not asked(7, datetime(2024, 1, 11)).should_retrain
    assert not asked(6, datetime(2024, 1, 10)).should_retrain


def test_model_health(spark):
    rows = spark.createDataFrame([("a", 0.1, 0.85), ("b", 0.11, 0.9), ("c", 0.0, 0.84), ("d", None, None)],
                                 "run_id string, model_drift_score double, accuracy double")
    assert [r.needs_retraining for r in quality.model_health(rows).orderBy("run_id").collect()] == [False, True, True, False]


def test_group_totals_spread_a_hot_key(spark):
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("t"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 200).cast("string"))).alias("g"))
    out = skew.with_group_totals(rows, "g", "t", {"n": F.count("*"), "top": F.max("t")}, hot_share=10, spread=16)
    assert out.count() == 5000
    wrong = out.groupBy("g").agg(F.count("*").alias("c"), F.max("t").alias("m"), F.min("n").alias("a"),
                                 F.max("n").alias("b"), F.min("top").alias("x")).filter("a <> c or b <> c or x <> m")
    assert wrong.count() == 0


def test_stream_performance(spark):
    start = datetime(2024, 1, 1)
    rows = spark.createDataFrame([(start + timedelta(seconds=i), float(i), i == 3, "bad" if i == 0 else None)
                                  for i in range(11)], "ts timestamp, latency_ms double, is_fraud boolean, error string")
    got = quality.stream_performance(rows, 2.0).first()
    assert (got.total_transactions_processed, got.total_predictions_made, got.fraud_detected_count) == (11, 10, 1)
    assert (got.actual_avg_tps, got.throughput_efficiency, got.max_processing_latency_ms) == (1.1, 55.00000000000001, 10.0)


def test_progress_crosses_days(spark):
    start = datetime(2024, 1, 1, 23, 59)
    rows = spark.createDataFrame([(start + timedelta(seconds=20 * i), "success" if i % 2 else "failed") for i in range(9)],
                                 "ts timestamp, status string")
    got = latency.progress_snapshots(rows, timedelta(seconds=30)).orderBy("bucket").collect()
    assert [r.total for r in got] == [2, 3, 5, 6, 8, 9] and got[-1].successful == 4


def test_histogram_quantile_golden(spark):
    inf = float("inf")
    rows = spark.createDataFrame([("a", 0.1, 100), ("a", 0.5, 200), ("a", 1.0, 250), ("a", inf, 260),
                                  ("b", 0.1, 0), ("b", inf, 0), ("c", 0.1, 1), ("c", inf, 100)],
                                 "series string, le double, cumulative long")
    got = {r.series: r.value for r in latency.histogram_quantile(rows, 0.95).collect()}
    assert got == {"a": 0.97, "c": 0.1}


def test_histogram_top_bucket_is_the_count(spark):
    rows = spark.createDataFrame([(x / 10,) for x in range(200)], "seconds double")
    got = latency.latency_histogram(rows).orderBy("le").collect()
    assert got[-1].cumulative == got[-1]["count"] == 200 and [r.cumulative for r in got] == sorted(r.cumulative for r in got)


def test_learnt_bins_and_their_ties(spark):
    """Edges are elements of the sorted baseline; those that tie are one, and a value on an edge lies above it."""
    rows = [("m", 1.0 * i, 5.0 if i < 8 else float(i)) for i in range(20)] + [(None, 1.0, None), ("m", None, float("nan"))]
    base = spark.createDataFrame(rows, "model string, a double, b double").repartition(3)
    bins = {(r.model, r.feature): r.edges for r in quality.learn_bins(base, ("a", "b"), 4, ("model",)).collect()}
    assert bins == {("m", "a"): [5.0, 10.0, 15.0], ("m", "b"): [5.0, 10.0, 15.0], (None, "a"): [1.0]}
    kept = quality.learn_bins(base, ("a", "b"), 4, ("model",))
    same = quality.drift_on_bins(kept, base, base, ("a", "b"), keys=("model",)).collect()
    assert len(same) == 3 and all(r.psi == 0 and not r.drifted for r in same)
    moved = spark.createDataFrame([("m", 5.0, 9.0), ("m", 5.0, 9.0), ("new", 1.0, 1.0)], "model string, a double, b double")
    got = {(r.model, r.feature): r.psi for r in quality.drift_on_bins(kept, base, moved, ("a", "b"), keys=("model",)).collect()}
    eps = quality.PSI_EPSILON
    one = lambda p, q: (max(q, eps) - max(p, eps)) * math.log(max(q, eps) / max(p, eps))
    assert got["m", "a"] == pytest.approx(one(.25, 1) + 3 * one(.25, 0))  # all in the bin from the edge 5 on
    assert got["m", "b"] == pytest.approx(one(.5, 1) + 2 * one(.25, 0)) and ("new", "a") not in got
