from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyguard.functions import features as fx
from tallyguard.operators import scoring


def test_fill_defaults(spark):
    rows = spark.createDataFrame([(None, None), (20, float("nan")), (0, 0.0)], "user_age int, location_risk_score double")
    assert [tuple(r) for r in scoring.fill_defaults(rows).collect()] == [(35, 0.5), (20, 0.5), (0, 0.0)]
    assert scoring.fill_defaults(rows.select("user_age")).columns == ["user_age"]


def test_encode_category(spark):
    rows = spark.createDataFrame([(c,) for c in [*fx.CATEGORY_CODES, "unknown_category", "Grocery", None]],
                                 "merchant_category string")
    assert [r[0] for r in scoring.encode_category(rows).collect()] == [0, 1, 2, 3, 4, 5, 6, 7, 7, 7, 7]


def test_feature_projection_order_and_optional_columns(spark):
    rows = spark.createDataFrame([("t", 14, 2, 150.75, "restaurant", 35)],
                                 "transaction_id string, hour_of_day int, day_of_week int, amount double, "
                                 "merchant_category string, user_age int")
    out = scoring.prepare_features(rows)
    assert out.columns == ["transaction_id", "amount", "merchant_category", "hour_of_day", "day_of_week", "user_age"]
    assert tuple(out.first()) == ("t", 150.75, 2.0, 14.0, 2.0, 35.0)


def test_rule_and_threshold_boundaries(spark):
    rows = spark.createDataFrame([(500.0,), (500.01,), (None,), (float("nan"),), (0.0,)], "amount double")
    scored = scoring.decide_threshold(scoring.rule_score(rows)).collect()
    assert [r.fraud_probability for r in scored] == [0.2, 0.8, 0.2, 0.2, 0.2]
    assert [r.is_fraud_predicted for r in scored] == [False, True, False, False, False]
    half = spark.createDataFrame([(0.5,)], "fraud_probability double")
    assert scoring.decide_threshold(half).first().is_fraud_predicted is False


@pytest.mark.parametrize("mode,wanted", [
    ("single", ["medium", "high", "high", "high", "very_high", "very_high", "medium"]),
    ("batch", ["medium", "high", "high", "high", "high", "high", "medium"])])
def test_confidence(spark, mode, wanted):
    rows = spark.createDataFrame([(p,) for p in (0.2, 0.8, 0.9, 0.1, 0.0, 1.0, 0.5)], "fraud_probability double")
    assert [r.confidence for r in scoring.confidence_band(rows, mode).collect()] == wanted


def test_proba_fallback(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,)], "label int")
    def got(mode):
        return [(r.fraud_probability, r.is_fraud) for r in scoring.proba_fallback(rows, mode).collect()]
    assert got("single") == [(0.0, False), (1.0, True), (0.5, True)]
    assert got("batch") == [(0.0, False), (1.0, True), (2.0, True)]


def test_time_features_monday_is_zero(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 13),), (datetime(2024, 1, 7),)], "ts timestamp_ntz")
    assert [(r.hour_of_day, r.day_of_week) for r in scoring.time_features(rows).collect()] == [(13, 0), (0, 6)]


def test_uplift_and_amortized(spark):
    rows = spark.createDataFrame([("tx_001", 100.5, "r", 10.0), ("tx_002", 250.75, "r", 10.0)],
                                 "transaction_id string, amount double, request_id string, total_ms double")
    assert [r.processed for r in scoring.amount_uplift(rows).collect()] == [100.5 * 1.1, 250.75 * 1.1]
    assert {r.processing_time_ms for r in scoring.amortized_latency(rows).collect()} == {5.0}


class Labels:
    def predict(self, x):
        return (x["amount"] > 100).astype(int).to_numpy()


class Probabilities(Labels):
    def predict_proba(self, x):
        return np.column_stack([np.full(len(x), 0.25), np.full(len(x), 0.75)])


@pytest.mark.parametrize("model,wanted", [(Labels, [(False, 0.0), (True, 1.0)]),
                                          (Probabilities, [(False, 0.75), (True, 0.75)])])
def test_python_model(spark, model, wanted):
    rows = spark.createDataFrame([("a", 50.0), ("b", 150.0)], "transaction_id string, amount double")
    scored = scoring.PythonModelScorer(lambda: model()).score(rows).orderBy("amount").collect()
    assert [(r.is_fraud, r.fraud_probability) for r in scored] == wanted


def test_prediction_response_needs_one_champion(spark):
    champions = spark.createDataFrame([("m", "7"), ("n", "9")], "model_name string, version string")
    rows = spark.createDataFrame([("a",), ("b",)], "transaction_id string")
    out = scoring.prediction_response(rows, champions, "m")
    assert [r.model_version for r in out.collect()] == ["7", "7"]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    for bad, name in ((champions, "gone"), (champions.unionByName(champions), "m")):
        with pytest.raises(Exception, match="(?i)no usable version|more than one row"):
            scoring.prediction_response(rows, bad, name).collect()
    assert scoring.prediction_response(rows.limit(0), champions, "m").collect() == []


def test_preview(spark):
    rows = spark.range(30).select(F.format_string("t%02d", "id").alias("transaction_id"), F.lit(1.0).alias("amount"),
                                  F.lit(0.2).alias("fraud_probability"), F.lit(False).alias("is_fraud_predicted"))
    assert [r[0] for r in scoring.preview_predictions(rows).collect()] == [f"t{i:02d}" for i in range(10)]
