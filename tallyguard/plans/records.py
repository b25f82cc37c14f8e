"""Plans over files, logs and saved test runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyguard.functions import texts
from tallyguard.operators import latency, reports, validation
from tallyguard.plans.domain import Domain, with_views
from tallyguard.plans.registry import plan
from tallyguard.plans.transactions import _HOSTILE, _SAFE, RESPONSE, _hostile, responses
from tallyguard.session import scratch_dir
from tallyguard.sources import files, logs, sinks

_RAW_COLUMNS = ["transaction_id", "amount", "merchant_category", "hour_of_day", "day_of_week", "user_age",
                "location_risk_score"]


# --- files ----------------------------------------------------------------

@plan("scan_transactions", with_views("""
    SELECT transaction_id, TRY_CAST(amount AS DOUBLE) AS amount, merchant_category, hour_of_day::INTEGER AS hour_of_day,
        TRY_CAST(amount AS DOUBLE) IS NULL AS corrupt FROM raw""", "raw"))
def scan_transactions(d: Domain):
    """The transactions as delimited files, read back with the fixed schema."""
    path = scratch_dir(d.spark, "csv")
    d.raw().select(*_RAW_COLUMNS).write.option("header", "true").csv(path)
    rows = files.scan_transactions(d.spark, path)
    return rows.select("transaction_id", "amount", "merchant_category", "hour_of_day",
                       F.col("_corrupt").isNotNull().alias("corrupt"))


@plan("select_daily_files", with_views("""
    SELECT transaction_id, ts::DATE AS file_date FROM tx""", "tx"))
def select_daily_files(d: Domain):
    """Dated files of all transactions; without a list all of them are taken."""
    path = scratch_dir(d.spark, "daily")
    (d.transactions().select(*_RAW_COLUMNS, F.to_date("ts").alias("day")).hint("rebalance", "day")
     .write.partitionBy("day").option("header", "true").csv(path))
    return files.read_daily_files(d.spark, files.select_daily_files(None, path)).select("transaction_id", "file_date")


@plan("scan_metric_json", """
    SELECT CASE WHEN p_partkey % 97 <> 0 THEN 'f1_' || p_partkey END AS metric,
        CASE WHEN p_partkey % 97 <> 0 THEN p_retailprice / 1000::DOUBLE END AS value, p_partkey % 97 = 0 AS corrupt FROM part""")
def scan_metric_json(d: Domain):
    path = scratch_dir(d.spark, "metrics")
    body = F.to_json(F.struct(F.expr("concat('f1_', p_partkey)").alias("metric"), F.expr("p_retailprice / 1000D").alias("value")))
    d.table("part").select(F.when(F.col("p_partkey") % 97 == 0, "{cut").otherwise(body).alias("value")).write.text(path)
    return files.scan_metric_json(d.spark, path).select("metric", "value", F.col("_corrupt").isNotNull().alias("corrupt"))


_LOGGED = ["transaction_id", "fraud_probability", "is_fraud_predicted", "model_version", "processing_time_ms", "confidence"]


@plan("prediction_log_sink", with_views(f"""
    SELECT {", ".join(_LOGGED)}, ts AS timestamp, ts::DATE AS log_date FROM answers JOIN tx USING (transaction_id)""",
                                        "req", "champions", "tx", more={"answers": RESPONSE}))
def prediction_log_sink(d: Domain):
    """All seven fields, written twice under one batch id, as after a failure: the rows are there once."""
    path = scratch_dir(d.spark, "prediction-log")
    times = d.transactions().select("transaction_id", F.col("ts").alias("timestamp"))
    rows = responses(d).select(*_LOGGED).join(times, "transaction_id")
    for _ in range(2):
        sinks.prediction_log_sink(rows, path, batch_id=7)
    return d.spark.read.parquet(path).select(*_LOGGED, "timestamp", "log_date")


# --- logs -----------------------------------------------------------------

@plan("parse_exposition", with_views("""
    SELECT 'request_seconds_bucket' AS name, '0.5' AS le, 'pod_' || (user_id % 6) AS pod, value, ts, NULL AS corrupt FROM ev
    UNION ALL SELECT 'requests_total', NULL, 'a "quoted", \\ pod', event_id::DOUBLE, TIMESTAMP '2023-11-14 22:13:20', NULL FROM ev
    UNION ALL SELECT 'limit_seconds', '+Inf', NULL, 'inf'::DOUBLE, ts, NULL FROM ev WHERE k > 90
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, unnest(['broken{le="1" 12', 'requests_total none', 'twice{le="1",le="2"} 3'])
    FROM ev""", "ev"))
def parse_exposition(d: Domain):
    """Scrape text of every event, with comments and broken lines between."""
    lines = d.events().selectExpr("""explode(array('# HELP requests_total All requests',
        concat('request_seconds_bucket{le="0.5",pod="pod_', user_id % 6, '"} ', value),
        concat('requests_total{pod="a \\\\"quoted\\\\", \\\\\\\\ pod"} ', event_id, ' 1700000000000'),
        'broken{le="1" 12', 'requests_total none', 'twice{le="1",le="2"} 3', '',
        case when k > 90 then 'limit_seconds{le="+Inf"} +Inf' else '# end' end)) as value""", "ts")
    return logs.parse_exposition(lines, "ts").select(
        "name", F.expr("labels['le']").alias("le"), F.expr("labels['pod']").alias("pod"), "value",
        F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("_corrupt").alias("corrupt"))


def _access_lines(d: Domain):
    """One request line per event; some lines are cut off."""
    rows = d.request_log().selectExpr(
        "event_id", "'POST' as method", "path", "'' as query_string", "concat('10.0.0.', k) as client_ip",
        "'client' as user_agent", "status_code", "ms as duration_ms")
    body = F.to_json(F.struct(*[c for c in rows.columns if c != "event_id"]))
    cut = F.when(F.col("event_id") % 97 == 0, F.substring("_line", 1, 20)).otherwise(F.col("_line"))
    return rows.withColumn("_line", body).select(cut.alias("value"))


@plan("scan_access_log", with_views("""
    SELECT CASE WHEN event_id % 97 <> 0 THEN path END AS path, CASE WHEN event_id % 97 <> 0 THEN status_code END
        AS status_code, CASE WHEN event_id % 97 <> 0 THEN ms END AS duration_ms,
        CASE WHEN event_id % 97 <> 0 THEN '10.0.0.' || k END AS client_ip, event_id % 97 = 0 AS corrupt
    FROM log""", "log"))
def scan_access_log(d: Domain):
    return logs.scan_access_log(_access_lines(d)).select(
        "path", "status_code", "duration_ms", "client_ip", F.col("_corrupt").isNotNull().alias("corrupt"))


@plan("access_log_stats", with_views("""
    SELECT path, status_code, count(*) AS n, round(avg(ms), 6) AS avg_ms, max(ms) AS max_ms,
        avg(CASE WHEN status_code >= 400 THEN 1::DOUBLE ELSE 0::DOUBLE END) AS error_share
    FROM (SELECT CASE WHEN event_id % 97 <> 0 THEN path END AS path, CASE WHEN event_id % 97 <> 0 THEN status_code END
          AS status_code, CASE WHEN event_id % 97 <> 0 THEN ms END AS ms FROM log) GROUP BY ALL""", "log"))
def access_log_stats(d: Domain):
    """Statistics of the readable lines; the unreadable ones are counted in a row without a path."""
    rows = logs.scan_access_log(_access_lines(d))
    return reports.access_log_stats(rows).withColumn("avg_ms", F.round("avg_ms", 6))


@plan("scan_error_log", with_views("""
    SELECT CASE WHEN event_id % 97 <> 0 THEN 'PredictionError' END AS error_type,
        CASE WHEN event_id % 97 <> 0 THEN 'failed on ' || event_type END AS error_message,
        CASE WHEN event_id % 97 <> 0 THEN ts END AS timestamp,
        CASE WHEN event_id % 97 <> 0 THEN user_id::VARCHAR END AS user_id,
        CASE WHEN event_id % 97 <> 0 THEN 2 ELSE 0 END AS context_size, event_id % 97 = 0 AS corrupt FROM ev""", "ev"))
def scan_error_log(d: Domain):
    """Error lines with open context."""
    rows = d.events().select("event_id", F.to_json(F.struct(
        F.lit("PredictionError").alias("error_type"), F.concat(F.lit("failed on "), "event_type").alias("error_message"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit("ValueError").alias("exception_type"), F.col("user_id"), F.col("k"))).alias("_j"))
    lines = rows.select(F.when(F.col("event_id") % 97 == 0, "not json").otherwise(F.col("_j")).alias("value"))
    return logs.scan_error_log(lines).select(
        "error_type", "error_message", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.expr("context['user_id']").alias("user_id"),
        F.coalesce(F.size("context"), F.lit(0)).alias("context_size"), F.col("_corrupt").isNotNull().alias("corrupt"))


# --- test runs ------------------------------------------------------------

@plan("scan_test_results", with_views("SELECT test_run_id, test_name, status, response_time_ms, timestamp FROM results",
                                      "results"))
def scan_test_results(d: Domain):
    """Saved runs with nested results, flattened."""
    path = scratch_dir(d.spark, "test-runs")
    result = F.struct("test_name", "status", "response_time_ms",
                      F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))
    d.test_results().select("test_run_id", F.array(result).alias("detailed_results")).write.json(path)
    rows = files.scan_test_results(d.spark, path, multi_line=False)
    return rows.drop("details").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


_CATEGORY = """CASE WHEN contains(test_name, 'Health Check') THEN 'Health Checks'
    WHEN contains(test_name, 'Prediction') THEN 'ML Predictions' WHEN contains(test_name, 'Validation')
    THEN 'Input Validation' WHEN contains(test_name, 'Performance') THEN 'Performance'
    WHEN contains(test_name, 'Documentation') THEN 'Documentation'
    WHEN contains(test_name, 'API Availability') THEN 'Availability' ELSE 'Other' END AS category"""
_CLASS = """CASE WHEN contains(status, 'FAIL') THEN 'fail' WHEN contains(status, 'ERROR') THEN 'error'
    ELSE 'pass' END AS status_class"""


@plan("test_category", with_views(f"SELECT test_run_id, timestamp, {_CATEGORY} FROM results", "results"))
def test_category(d: Domain):
    return d.test_results().select("test_run_id", "timestamp",
                                   texts.test_category(F.col("test_name")).alias("category"))


@plan("test_status_class", with_views(f"SELECT test_run_id, timestamp, {_CLASS} FROM results", "results"))
def test_status_class(d: Domain):
    return d.test_results().select("test_run_id", "timestamp",
                                   texts.status_class(F.col("status")).alias("status_class"))


@plan("latency_band", with_views("""
    SELECT event_id, CASE WHEN ms < 200 THEN 'excellent' WHEN ms < 500 THEN 'good' WHEN ms <= 1000 THEN 'acceptable'
        ELSE 'poor' END AS band FROM (SELECT event_id, ms * 3 AS ms FROM log)""", "log"))
def latency_band(d: Domain):
    return d.request_log().select("event_id", texts.latency_band(F.col("ms") * 3).alias("band"))


_SUMMARY = """count(*) AS total, count(*) FILTER (WHERE status IN ('✅ PASS', '✅ COMPLETED')) AS passed,
    count(*) FILTER (WHERE status = '❌ FAIL') AS failed, count(*) FILTER (WHERE status = '❌ ERROR') AS error,
    100::DOUBLE * count(*) FILTER (WHERE status IN ('✅ PASS', '✅ COMPLETED')) / count(*) AS success_rate"""


@plan("test_run_summary", with_views(f"""
    SELECT test_run_id, {_SUMMARY}, (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1000000::DOUBLE
        AS duration_seconds FROM results GROUP BY test_run_id""", "results"))
def test_run_summary(d: Domain):
    return reports.test_run_summary(d.test_results())


@plan("tests_by_category", with_views("""
    SELECT category, count(*) AS n, count(*) FILTER (WHERE status_class = 'pass') AS n_pass,
        count(*) FILTER (WHERE status_class = 'fail') AS n_fail,
        count(*) FILTER (WHERE status_class = 'error') AS n_error FROM classed GROUP BY category""", "results",
    more={"classed": f"SELECT {_CATEGORY}, {_CLASS} FROM results"}))
def tests_by_category(d: Domain):
    return reports.tests_by_category(d.test_results())


@plan("release_gate", with_views(f"""
    SELECT t.success_rate >= 90 AS functional_ok, t.success_rate >= 70 AS tests_ok, l.a <= 1000 AS latency_ok,
        l.r >= 95 AS success_ok, s.ok AS security_ok,
        t.success_rate >= 90 AND l.a <= 1000 AND l.r >= 95 AND s.ok AS passed
    FROM (SELECT {_SUMMARY} FROM results) t, (SELECT avg(ms) AS a, 100::DOUBLE
        * count(*) FILTER (WHERE status_code = 200) / count(*) AS r FROM log) l,
        (SELECT bool_and(safe) AS ok FROM judged) s""", "results", "log", more={"hostile": _HOSTILE, "judged": _SAFE}))
def release_gate(d: Domain):
    return reports.release_gate(
        reports.test_run_summary(d.test_results(), ()), latency.latency_summary(d.request_log()),
        reports.security_score(validation.safe_response(_hostile(d))))
