from datetime import datetime

import pytest

from tallyguard import schemas
from tallyguard.operators import registry, reports

TS = datetime(2024, 1, 1)
LATER = datetime(2024, 2, 1)


def table(spark, *rows):
    full = [(m, v, alias, stage, f"run_{m}_{v}", TS, TS, "", {"owner": "x"}) for m, v, alias, stage in rows]
    return spark.createDataFrame(full, schemas.REGISTRY)


@pytest.fixture
def versions(spark):
    return table(spark, ("a", "2", "champion", "Archived"), ("a", "10", None, "Production"),
                 ("b", "2", None, "Production"), ("b", "10", None, "Production"), ("b", "11", None, "None"),
                 ("c", "2", None, "None"), ("c", "10", None, "Staging"))


def test_resolution_order(versions):
    got = {r.model_name: (r.version, r.reason) for r in registry.resolve_champion(versions).collect()}
    assert got == {"a": ("2", "alias"), "b": ("10", "stage"), "c": ("10", "latest")}
    assert registry.resolve_champion(versions.limit(0)).count() == 0


def test_latest_per_stage(versions):
    got = {(r.model_name, r.stage): r.version for r in registry.registry_latest(versions).collect()}
    assert got["b", "Production"] == "10" and got["c", "None"] == "2" and len(got) == 6


def test_one_hot_model_is_cut_before_the_shuffle(versions):
    plan = registry.resolve_champion(versions)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_promotion(spark, versions):
    moves = spark.createDataFrame([("a", "10", LATER), ("b", "11", LATER)], "model_name string, version string, ts timestamp")
    after = {(r.model_name, r.version): r for r in registry.promote_champion(versions, moves).collect()}
    assert len(after) == versions.count()
    assert {k: (r.alias, r.stage) for k, r in after.items()} == {
        ("a", "2"): (None, "Archived"), ("a", "10"): ("champion", "Production"),
        ("b", "2"): (None, "Archived"), ("b", "10"): (None, "Archived"), ("b", "11"): ("champion", "Production"),
        ("c", "2"): (None, "None"), ("c", "10"): (None, "Staging")}
    assert after["b", "11"].tags == {"owner": "x", "champion": "true"} and after["b", "2"].last_updated_timestamp == LATER
    assert after["c", "2"].last_updated_timestamp == TS


def test_registration(spark, versions):
    new = spark.createDataFrame([("b", "r1", {"p": "1"}, {"auc": "0.9"}, "s", LATER), ("b", "r2", {}, {}, "s", LATER),
                                 ("new", "r3", {}, {}, "s", LATER)],
                                "model_name string, run_id string, params map<string,string>, "
                                "metrics map<string,string>, source_path string, ts timestamp")
    after = registry.register_version(versions, new)
    added = {(r.model_name, r.version): r.run_id for r in after.filter("run_id like 'r_'").collect()}
    assert added == {("b", "12"): "r1", ("b", "13"): "r2", ("new", "1"): "r3"} and after.count() == 10


def test_promotion_is_strict(spark):
    pairs = spark.createDataFrame([("mock", 0.89, 0.91), ("better", 0.89, 0.92), ("gone", 0.89, None), ("first", None, 0.9)],
                                  "model_name string, champion_f1_score double, new_f1_score double")
    got = {r.model_name: r.should_promote for r in registry.should_promote(pairs).collect()}
    assert got == {"mock": False, "better": True, "gone": False, "first": False}


def test_challenger_pair(spark, versions):
    metrics = spark.createDataFrame([("a", "2", .89, .87, .91, .89, .94), ("a", "10", .91, .89, .93, .91, .96)],
                                    "model_name string, version string, accuracy double, precision double, "
                                    "recall double, f1_score double, auc_roc double")
    pair = registry.champion_challenger(metrics, versions).filter("model_name = 'a'").first()
    assert (pair.champion_version, pair.new_version, pair.champion_auc_roc, pair.new_recall) == ("2", "10", .94, .93)


def test_metrics_wide(spark):
    rows = spark.createDataFrame([("m", "auc", 0.9), ("m", "f1", 0.8), ("n", "auc", 0.7)], "model_name string, metric string, value double")
    got = {r.model_name: r.metrics for r in registry.metrics_long_to_wide(rows, ("auc", "f1")).collect()}
    assert got == {"m": {"auc": 0.9, "f1": 0.8}, "n": {"auc": 0.7}}


def test_snapshot_is_never_overwritten(versions, tmp_path):
    registry.write_snapshot(versions, str(tmp_path), "one")
    with pytest.raises(Exception, match="already exists"):
        registry.write_snapshot(versions, str(tmp_path), "one")


def test_run_report_parts(spark):
    runs = spark.createDataFrame([(i,) for i in range(1, 5)], "run_id int")
    perf = spark.createDataFrame([(1, 89.9, 301.0, None), (2, 90.0, 300.0, None), (3, None, None, "failed")],
                                 "run_id int, throughput_efficiency double, avg_processing_latency_ms double, error string")
    quality = spark.createDataFrame([(1, 0.84, None), (2, 0.85, None)], "run_id int, accuracy double, error string")
    cluster = spark.createDataFrame([(1, "c")], "run_id int, cluster_id string")
    got = {r.run_id: r for r in reports.run_report(runs, perf, quality, cluster).collect()}
    assert [len(got[i].recommendations) for i in range(1, 5)] == [3, 0, 1, 0]
    assert [(got[i].streaming_completed, got[i].model_evaluation_completed) for i in range(1, 5)] == [
        (True, True), (True, True), (False, False), (False, False)]


def test_training_report(spark):
    runs = spark.createDataFrame([(1, datetime(2024, 1, 31).date())], "run_id int, execution_date date")
    evaluation = spark.createDataFrame([(1, 0.03)], "run_id int, improvement_score double")
    row = reports.training_report(runs, evaluation, evaluation.select("run_id")).first()
    assert row.model_promoted and str(row.next_training_scheduled) == "2024-02-01"
    assert not reports.training_report(runs, evaluation, evaluation.limit(0)).first().model_promoted


def test_test_runs(spark):
    rows = spark.createDataFrame([("r", s, datetime(2024, 1, 1, 0, 0, i)) for i, s in enumerate(
        ["✅ PASS", "✅ COMPLETED", "❌ FAIL", "❌ FAILED", "❌ ERROR"])], "test_run_id string, status string, timestamp timestamp")
    got = reports.test_run_summary(rows).first()
    assert (got.total, got.passed, got.failed, got.error, got.success_rate, got.duration_seconds) == (5, 2, 1, 1, 40.0, 4.0)
    named = rows.withColumn("test_name", rows.status)
    assert reports.tests_by_category(named).first().asDict() == {
        "category": "Other", "n": 5, "n_pass": 2, "n_fail": 2, "n_error": 1}


def test_release_gate(spark):
    def one(**values):
        return spark.createDataFrame([tuple(values.values())], list(values))
    def passed(success=90.0, avg=1000.0, ok=95.0, safe=7):
        return reports.release_gate(one(success_rate=success), one(avg_response_time=avg, success_rate=ok),
                                    one(safe=safe, total=7)).first().passed
    assert passed() and not passed(success=89.9) and not passed(avg=1000.1) and not passed(ok=94.9) and not passed(safe=6)
