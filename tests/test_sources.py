import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyguard.functions import hashing
from tallyguard.operators import training
from tallyguard.session import scratch_dir
from tallyguard.sources import files, generators, kafka, logs, sinks


def test_bad_lines_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "transaction_id,amount,merchant_category,hour_of_day,day_of_week,user_age,location_risk_score\n"
        "t1,10.5,retail,3,1,,\nt2,much,retail,3,1,20,0.5\nt3,1.0\n")
    got = {r.transaction_id: r for r in files.scan_transactions(spark, str(tmp_path)).collect()}
    assert got["t1"]._corrupt is None and got["t1"].user_age is None
    assert got["t2"]._corrupt.startswith("t2,much") and got["t3"]._corrupt == "t3,1.0"


def test_daily_files(spark, tmp_path):
    header = "transaction_id,amount,merchant_category,hour_of_day,day_of_week,user_age,location_risk_score\n"
    for day in ("2019-11-20", "2019-08-22", "2019-10-21", "2019-09-21"):
        (tmp_path / f"{day}.txt").write_text(f"{header}{day},1,x,1,1,,\n")
    (tmp_path / "notes.txt").write_text("none\n")
    everything = files.select_daily_files(None, str(tmp_path))
    rows = files.read_daily_files(spark, everything).collect()
    assert sorted(str(r.file_date) for r in rows) == ["2019-08-22", "2019-09-21", "2019-10-21", "2019-11-20"]
    assert all(r.transaction_id == str(r.file_date) for r in rows)
    some = files.read_daily_files(spark, everything, date(2019, 9, 1), date(2019, 10, 21))
    assert sorted(str(r.file_date) for r in some.collect()) == ["2019-09-21", "2019-10-21"]
    assert files.select_daily_files("2019-11-20.txt, x.txt", "root/") == ["root/2019-11-20.txt", "root/x.txt"]


def test_metric_defaults(spark, tmp_path):
    defaults = {"auc": 0.85, "accuracy": 0.82, "f1": 0.75}
    def read(path):
        return {r.metric: r.value for r in files.scan_metric_json(spark, str(path)).collect()}
    assert read(tmp_path / "missing") == defaults
    (tmp_path / "empty.json").write_text("\n")
    assert read(tmp_path / "empty.json") == defaults
    (tmp_path / "ok.json").write_text('{"metric":"auc","value":0.9}\n')
    assert read(tmp_path / "ok.json") == {"auc": 0.9}
    (tmp_path / "bad.json").write_text('{"metric":"auc","value":0.9}\n{cut\n{"metric":"f1"}\n')
    rows = files.scan_metric_json(spark, str(tmp_path / "bad.json")).collect()
    assert sorted((r.metric or "", r.value or 0, r._corrupt or "") for r in rows) == [("", 0, "{cut"), ("auc", 0.9, ""), ("f1", 0, "")]


def test_saved_test_run(spark, tmp_path):
    run = {"test_run_id": "r", "detailed_results": [
        {"test_name": "Health Check", "status": "✅ PASS", "response_time_ms": 1.5, "timestamp": "2024-01-01T00:00:00",
         "details": {"k": "v"}}, {"test_name": "x", "status": "❌ FAIL"}]}
    (tmp_path / "run.json").write_text(json.dumps(run, indent=2, ensure_ascii=False), encoding="utf-8")
    rows = files.scan_test_results(spark, str(tmp_path)).collect()
    assert [(r.test_name, r.status) for r in rows] == [("Health Check", "✅ PASS"), ("x", "❌ FAIL")]
    assert rows[0].details == {"k": "v"} and rows[1].timestamp is None


def test_exposition(spark):
    text = ['# HELP ml_predictions_total Total', 'ml_predictions_total 1234', '', 'up{} 1',
            'd_bucket{le="0.1"} 100', 'd_bucket{le="+Inf", pod="a b,c"} 260 1700000000000', 'd_sum 45.5', 'bad line',
            r'e{path="C:\\dir\n",said="a \"b\", c=\"d\""} -Inf', 'twice{a="1",a="2"} 1', 'cut{a="1 3']
    lines = spark.createDataFrame([(t, datetime(2024, 1, 1)) for t in text], "value string, at timestamp")
    rows = logs.parse_exposition(lines, "at").collect()
    assert [(r.name, r.labels, r.value) for r in rows if r._corrupt is None] == [
        ("ml_predictions_total", {}, 1234.0), ("up", {}, 1.0), ("d_bucket", {"le": "0.1"}, 100.0),
        ("d_bucket", {"le": "+Inf", "pod": "a b,c"}, 260.0), ("d_sum", {}, 45.5),
        ("e", {"path": "C:\\dir\n", "said": 'a "b", c="d"'}, float("-inf"))]
    assert [r._corrupt for r in rows if r._corrupt] == ["bad line", 'twice{a="1",a="2"} 1', 'cut{a="1 3']
    assert {r.ts.year for r in rows if r._corrupt is None} == {2023, 2024}


def test_logs(spark):
    lines = spark.createDataFrame([('{"method":"GET","path":"/","status_code":200,"duration_ms":1.5}',), ("{cut",)], "value string")
    good, bad = logs.scan_access_log(lines).collect()
    assert (good.path, good.status_code, good._corrupt) == ("/", 200, None) and bad._corrupt == "{cut"
    errors = spark.createDataFrame([('{"error_type":"E","error_message":"m","timestamp":"2024-01-01T00:00:00","batch_size":3}',), ("no",)], "value string")
    good, bad = logs.scan_error_log(errors).collect()
    assert (good.error_type, good.context, good._corrupt) == ("E", {"batch_size": "3"}, None) and bad._corrupt == "no"


def test_kafka_options():
    read = kafka.kafka_read_options("host:1", "raw", 1000, **{"kafka.security.protocol": "SASL_SSL"})
    assert read["maxOffsetsPerTrigger"] == "1000" and read["subscribe"] == "raw" and read["kafka.security.protocol"] == "SASL_SSL"
    assert kafka.kafka_write_options("host:1", "out") == {"kafka.bootstrap.servers": "host:1", "topic": "out"}
    with pytest.raises(ValueError):
        kafka.kafka_read_options("", "raw", 1000)
    with pytest.raises(ValueError):
        kafka.stream_source(None, {}, "other")


def test_prediction_log_retry(spark, tmp_path):
    rows = spark.range(10).select(F.col("id"), F.timestamp_seconds(F.col("id") * 86400).alias("timestamp"))
    for batch in (1, 1, 2):
        sinks.prediction_log_sink(rows, str(tmp_path / "batches"), batch)
    assert spark.read.parquet(str(tmp_path / "batches")).count() == 20
    for _ in range(2):
        sinks.prediction_log_sink(rows, str(tmp_path / "appended"))
    assert spark.read.parquet(str(tmp_path / "appended")).count() == 20


def test_generated_messages(spark):
    rows = generators.gen_transactions(spark, 20, 300)
    about = rows.agg(F.count("*").alias("n"), F.min("amount").alias("lo"), F.max("amount").alias("hi"),
                     F.avg("is_fraud").alias("fraud"), F.countDistinct("transaction_id").alias("ids"),
                     F.countDistinct("timestamp").alias("seconds"), F.avg("amount").alias("mean"),
                     F.corr("amount", F.substring("user_id", 3, 9).cast("int")).alias("corr")).first()
    assert (about.n, about.ids, about.seconds) == (6000, 6000, 300)
    assert 10 <= about.lo < 30 and 980 < about.hi <= 1000 and 490 < about.mean < 520
    assert 0.03 < about.fraud < 0.07 and abs(about["corr"]) < 0.05
    assert rows.exceptAll(generators.gen_transactions(spark, 20, 300).repartition(7)).count() == 0
    assert generators.gen_transactions(spark, 20, 300, seed=1).join(rows, ["transaction_id", "amount"]).count() < 50


def test_generated_mix(spark):
    rows = generators.gen_stress_mix(spark, 5000)
    assert 0.08 < rows.agg(F.avg(F.col("is_risky").cast("int"))).first()[0] < 0.12
    risky_ok = "amount between 500 and 5000 and hour_of_day in (0,1,2,3,4,23) and location_risk_score between 0.7 and 1"
    normal_ok = "amount between 5 and 500 and hour_of_day between 8 and 22 and location_risk_score between 0 and 0.3"
    assert rows.filter(f"not (case when is_risky then {risky_ok} else {normal_ok} end) or user_age not between 18 and 80").count() == 0
    pool = generators.gen_stress_mix(spark, 2000, "uniform")
    assert pool.filter("amount not between 1 and 2000").count() == 0
    assert pool.select("merchant_category").distinct().count() == 10


def test_split_is_stable_and_whole(spark):
    rows = spark.range(20000).select(F.concat(F.lit("t"), "id").alias("transaction_id"))
    split = training.train_val_test_split(rows)
    shares = {r.split: r["count"] / 20000 for r in split.groupBy("split").count().collect()}
    assert shares == pytest.approx({"train": 0.7, "validation": 0.2, "test": 0.1}, abs=0.02) and sum(shares.values()) == 1
    assert split.exceptAll(training.train_val_test_split(rows.repartition(13))).count() == 0


def test_draws_do_not_repeat_beyond_the_prime(spark):
    ids = spark.range(2).select((F.col("id") * hashing.PRIME + 5).alias("id"))
    assert ids.select(hashing.draw(F.col("id"), 1).alias("d")).distinct().count() == 2


def test_scratch_follows_the_cluster_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path.startswith(shared.rstrip("/") if shared else "/") and path != scratch_dir(spark, "x")
