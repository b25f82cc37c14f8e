"""Plans that run a stream over the events to its end and return what its sink holds."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyguard import schemas
from tallyguard.operators import alerts, scoring
from tallyguard.operators.notices import LIMITS
from tallyguard.plans.domain import EVENTS, HOLD, Domain, with_views
from tallyguard.plans.monitoring import _GROUP, _SENT_VIEWS, NOTICE_VIEWS, NOTICES, _held_sql, stretched
from tallyguard.plans.registry import plan
from tallyguard.plans.transactions import _USERS
from tallyguard.session import scratch_dir
from tallyguard.sources import kafka
from tallyguard.streaming import aggregates, alert_state, bounded, progress, scoring as stream

HOUR = timedelta(hours=1)

def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def _to_files(d: Domain, df: DataFrame) -> DataFrame:
    """Run to the end into the file sink, and read what it committed."""
    path, checkpoint = scratch_dir(d.spark, "sink"), scratch_dir(d.spark, "checkpoint")
    _finish(df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
    return _unzoned(d.spark.read.schema(df.schema).parquet(path))


def _to_table(d: Domain, df: DataFrame, keys: list[str]) -> DataFrame:
    """Run to the end in update mode, and read the newest row of each key: open windows are there too."""
    path = scratch_dir(d.spark, "table")
    _finish(aggregates.keyed_table(df, keys, path, scratch_dir(d.spark, "checkpoint")))
    return _unzoned(aggregates.latest_rows(d.spark, path, keys, df.schema))


def _unzoned(df: DataFrame) -> DataFrame:
    """Times as the tables hold them, without a zone."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"})


def _stateful(d: Domain, df: DataFrame) -> DataFrame:
    """As ``_to_files``, with the state store that keyed processors need, and that keeps big state on disk."""
    before = d.spark.conf.get(alert_state.STATE_STORE_CONF)
    d.spark.conf.set(alert_state.STATE_STORE_CONF, alert_state.ROCKSDB)
    try:
        return _to_files(d, df)
    finally:
        d.spark.conf.set(alert_state.STATE_STORE_CONF, before)


def _to_the_end(d: Domain, build) -> DataFrame:
    """Run ``build(events)`` with its state on disk until nothing is open, and read what it committed."""
    path, checkpoint, marks = (scratch_dir(d.spark, x) for x in ("sink", "checkpoint", "marks"))
    events = bounded.with_end_mark(d.event_stream(), marks)
    df = build(events)
    start = (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start)
    before = d.spark.conf.get(alert_state.STATE_STORE_CONF)
    d.spark.conf.set(alert_state.STATE_STORE_CONF, alert_state.ROCKSDB)
    try:
        bounded.run_to_end(start, events, "ts", marks)
    finally:
        d.spark.conf.set(alert_state.STATE_STORE_CONF, before)
    return _unzoned(d.spark.read.schema(df.schema).parquet(path))


def _messages(d: Domain) -> DataFrame:
    """The events as JSON messages; some are unreadable."""
    body = F.to_json(F.struct(
        F.concat(F.lit("txn_"), "event_id").alias("transaction_id"), F.col("value").alias("feature1"),
        F.col("k").cast("double").alias("feature2"), F.lit(1.0).alias("feature3"),
        (F.col("value") * 5).alias("amount"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")))
    broken = F.col("event_id") % 97 == 0
    return d.event_stream().select(F.when(broken, F.lit("{cut")).otherwise(body).alias("value"))


def _scored_stream(d: Domain) -> DataFrame:
    """All messages; one that can't be read has no answer, and comes whole in ``_corrupt``."""
    return stream.stream_score(stream.stream_parse(_messages(d)), scoring.RuleScorer(), "model_3", "7")


def _predicted(d: Domain) -> DataFrame:
    return scoring.decide_threshold(scoring.rule_score(d.transactions(d.event_stream())))


@plan("stream_source", with_views("SELECT event_id, ts, event_type, value, k FROM ev", "ev"))
def stream_source(d: Domain):
    """The file source, at most one file per trigger."""
    rows = kafka.stream_source(d.spark, {"path": d.events_glob}, "files", EVENTS, max_per_trigger=1)
    return _to_files(d, d.event_stream(rows).select("event_id", "ts", "event_type", "value", "k"))


@plan("stream_parse", with_views("""
    SELECT CASE WHEN event_id % 97 <> 0 THEN 'txn_' || event_id END AS transaction_id,
        CASE WHEN event_id % 97 <> 0 THEN value * 5 END AS amount, CASE WHEN event_id % 97 <> 0 THEN ts END AS ts,
        CASE WHEN event_id % 97 <> 0 THEN k::DOUBLE END AS feature2, event_id % 97 = 0 AS corrupt FROM ev""", "ev"))
def stream_parse(d: Domain):
    parsed = stream.stream_parse(_messages(d))
    return _to_files(d, parsed.select(
        "transaction_id", "amount", F.col("timestamp").cast("timestamp_ntz").alias("ts"), "feature2",
        F.col(schemas.CORRUPT).isNotNull().alias("corrupt")))


def _readable(column: str) -> str:
    return f"CASE WHEN event_id % 97 <> 0 THEN {column} END"


_SCORED = f"""SELECT {_readable("'txn_' || event_id")} AS transaction_id, {_readable("value * 5")} AS amount,
    {_readable("CASE WHEN value * 5 > 500 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END")} AS fraud_probability,
    {_readable("value * 5 > 500")} AS is_fraud_predicted, 'model_3' AS model_name, '7' AS model_version,
    event_id % 97 = 0 AS unreadable FROM ev"""
_ANSWER = ["transaction_id", "amount", "fraud_probability", "is_fraud_predicted"]
_SCORED_COLUMNS = [*_ANSWER, "model_name", "model_version"]


def _answered(df: DataFrame) -> DataFrame:
    marked = df.withColumn("unreadable", F.col(schemas.CORRUPT).isNotNull())
    return marked.withColumns({c: F.when(~F.col("unreadable"), F.col(c)) for c in _ANSWER}).select(
        *_SCORED_COLUMNS, "unreadable")


@plan("stream_score", with_views(_SCORED, "ev"))
def stream_score(d: Domain):
    """Every message is answered or marked as unreadable."""
    return _to_files(d, _answered(_scored_stream(d)))


@plan("stream_sink_predictions", with_views(
    """SELECT 'topic' AS route, transaction_id AS key, amount, fraud_probability FROM scored WHERE NOT unreadable
    UNION ALL SELECT 'dead', NULL, NULL, NULL FROM scored WHERE unreadable""", "ev", more={"scored": _SCORED}))
def stream_sink_predictions(d: Domain):
    """The messages that the output topic would get, in files, and those that went to the dead letters."""
    path, good, bad = (scratch_dir(d.spark, x) for x in ("topic", "good", "dead"))
    parsed = stream.stream_parse(_messages(d))
    _finish(stream.stream_dead_letter(parsed, good, bad, scratch_dir(d.spark, "checkpoint")))
    schema = StructType([f for f in parsed.schema.fields if f.name != schemas.CORRUPT])
    readable = d.spark.readStream.schema(schema).parquet(good)
    scored = stream.stream_score(readable, scoring.RuleScorer(), "model_3", "7")
    _finish(kafka.stream_sink_predictions(scored.select(*_SCORED_COLUMNS), {"path": path},
                                          scratch_dir(d.spark, "checkpoint"), "files", available_now=True))
    body = F.from_json("value", "amount double, fraud_probability double")
    sent = d.spark.read.schema("key string, value string").parquet(path).select(
        F.lit("topic").alias("route"), "key", body.alias("v")).select("route", "key", "v.*")
    dead = d.spark.read.schema(f"{schemas.CORRUPT} string").parquet(bad).select(
        F.lit("dead").alias("route"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("double").alias("amount"),
        F.lit(None).cast("double").alias("fraud_probability"))
    return sent.unionByName(dead)


_HOURLY = """SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
    time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, count(*) AS rows,
    count(*) / 3600::DOUBLE AS rate FROM ev GROUP BY 1, 2"""


@plan("stream_sink_metrics", with_views("SELECT rows, rate FROM hourly", "ev", more={"hourly": _HOURLY}))
def stream_sink_metrics(d: Domain):
    """Window metrics as messages of their own topic, in files."""
    path = scratch_dir(d.spark, "metrics-topic")
    _finish(kafka.stream_sink_metrics(aggregates.stream_throughput(d.event_stream(), HOUR), {"path": path},
                                      scratch_dir(d.spark, "checkpoint"), kind="files", available_now=True))
    body = F.from_json("value", "rows bigint, rate double")
    sent = d.spark.read.schema("key string, value string, batch_id bigint").parquet(path)
    newest = sent.groupBy("key").agg(F.max_by("value", "batch_id").alias("value"))
    return newest.select(body.alias("v")).select("v.*")


@plan("stream_throughput", with_views("SELECT * FROM hourly", "ev", more={"hourly": _HOURLY}))
def stream_throughput(d: Domain):
    return _to_table(d, aggregates.stream_throughput(d.event_stream(), HOUR), ["window_start", "window_end"])


def _arrivals(d: Domain):
    """The events, some of them unreadable, and then a part of them once more: (events, write the second part)."""
    more = scratch_dir(d.spark, "again")
    rows = bounded.with_end_mark(d.event_stream(), more)
    again = d.events().withColumn("ts", F.col("ts").cast("timestamp")).filter("event_id % 50 = 0").select(*rows.columns)
    return rows, lambda: again.write.mode("append").parquet(more)


_AGAIN = """SELECT event_id, ts, event_id % 97 = 0 AS dead, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour'
    <= (SELECT max(ts) - INTERVAL '10 minutes' FROM ev) AS late FROM ev WHERE event_id % 50 = 0"""


def _split(d: Domain, table: progress.ProgressTable) -> DataFrame:
    rows, again = _arrivals(d)
    path, checkpoint = scratch_dir(d.spark, "arrivals"), scratch_dir(d.spark, "checkpoint")
    for arrived in (lambda: None, again):
        arrived()
        table.finish(progress.split_arrivals(rows, HOUR, path, checkpoint, dead=F.col("event_id") % 97 == 0))
    return progress.arrivals(d.spark, path, "event_id bigint, ts timestamp")


@plan("stream_late_rows", with_views("SELECT event_id, ts FROM again WHERE late AND NOT dead", "ev", more={"again": _AGAIN}))
def stream_late_rows(d: Domain):
    """The rows themselves that came when their hour had closed."""
    with progress.ProgressTable(d.spark, scratch_dir(d.spark, "progress")) as table:
        return _unzoned(_split(d, table).filter(F.col("route") == progress.LATE).select("event_id", "ts"))


@plan("stream_progress", with_views("""
    SELECT (SELECT count(*) FROM ev) + (SELECT count(*) FROM again) AS rows_in,
        (SELECT count(*) FILTER (WHERE event_id % 97 <> 0) FROM ev) + count(*) FILTER (WHERE NOT dead AND NOT late) AS answered,
        (SELECT count(*) FILTER (WHERE event_id % 97 = 0) FROM ev) + count(*) FILTER (WHERE dead) AS dead,
        count(*) FILTER (WHERE late AND NOT dead) AS late, true AS balanced FROM again""", "ev", more={"again": _AGAIN}))
def stream_progress(d: Domain):
    """The batches' own counts beside what became of their rows: none is lost."""
    with progress.ProgressTable(d.spark, scratch_dir(d.spark, "progress")) as table:
        rows = _split(d, table)
        came = table.rows().agg(F.sum("rows").alias("rows_in"))
    routes = rows.agg(*[F.count_if(F.col("route") == r).alias(r) for r in (progress.ANSWERED, progress.DEAD, progress.LATE)])
    both = came.select("rows_in", *[routes.select(c).scalar().alias(c) for c in routes.columns])
    return both.withColumn("balanced", F.col("rows_in") == F.col("answered") + F.col("dead") + F.col("late"))


@plan("stream_rate_5m", with_views("""
    SELECT time_bucket(INTERVAL '1 minute', ts) - i * INTERVAL '1 minute' AS window_start,
        time_bucket(INTERVAL '1 minute', ts) - i * INTERVAL '1 minute' + INTERVAL '5 minutes' AS window_end,
        count(*) / 300::DOUBLE AS rate FROM ev, (VALUES (0), (1), (2), (3), (4)) w(i) GROUP BY 1, 2""", "ev"))
def stream_rate_5m(d: Domain):
    """The stream keeps panes of a minute; windows slide over the table of panes."""
    minute = timedelta(minutes=1)
    panes = _to_table(d, aggregates.stream_panes(d.event_stream(), minute), ["window_start", "window_end"])
    return aggregates.rate_of_panes(panes, minute)


@plan("stream_fraud_rate", with_views("""
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
        time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
        100::DOUBLE * count(*) FILTER (WHERE is_fraud_predicted) / count(*) AS fraud_pct FROM pred GROUP BY 1, 2""", "pred"))
def stream_fraud_rate(d: Domain):
    return _to_table(d, aggregates.stream_fraud_rate(_predicted(d), HOUR), ["window_start", "window_end"])


@plan("stream_user_stats", with_views(_USERS, "tx"))
def stream_user_stats(d: Domain):
    """The newest running statistics of every user."""
    path, rows = scratch_dir(d.spark, "user-stats"), d.transactions(d.event_stream())
    _finish(aggregates.stream_user_stats_table(rows, path, scratch_dir(d.spark, "checkpoint")))
    return aggregates.latest_user_stats(d.spark, path, aggregates.stream_user_stats(rows).schema)


@plan("stream_dead_letter", with_views("""
    SELECT CASE WHEN event_id % 97 = 0 THEN 'dead' ELSE 'good' END AS route, count(*) AS n FROM ev GROUP BY 1""", "ev"))
def stream_dead_letter(d: Domain):
    good, bad = scratch_dir(d.spark, "good"), scratch_dir(d.spark, "bad")
    _finish(stream.stream_dead_letter(stream.stream_parse(_messages(d)), good, bad,
                                      scratch_dir(d.spark, "checkpoint")))
    routes = [d.spark.read.parquet(path).select(F.lit(name).alias("route"))
              for name, path in (("good", good), ("dead", bad))]
    return routes[0].unionByName(routes[1]).groupBy("route").agg(F.count("*").alias("n"))


@plan("stream_predictions_log", with_views(
    "SELECT transaction_id, fraud_probability, is_fraud_predicted, ts::DATE AS log_date FROM pred", "pred"))
def stream_predictions_log(d: Domain):
    path = scratch_dir(d.spark, "stream-log")
    rows = _predicted(d).withColumnRenamed("ts", "timestamp").select(
        "transaction_id", "fraud_probability", "is_fraud_predicted", "timestamp")
    _finish(stream.stream_predictions_log(rows, path, scratch_dir(d.spark, "checkpoint")))
    return d.spark.read.parquet(path).select("transaction_id", "fraud_probability", "is_fraud_predicted", "log_date")


@plan("stream_label_join", with_views("""
    SELECT transaction_id, is_fraud_predicted, label FROM pred WHERE event_id % 4 <= 2""", "pred"))
def stream_label_join(d: Domain):
    """Labels come zero to three hours after their transaction; two hours are waited for."""
    labels = d.transactions(d.event_stream()).selectExpr(
        "transaction_id", "label", "ts + make_dt_interval(0, cast(event_id % 4 as int)) as label_ts")
    predictions = _predicted(d).select("transaction_id", "ts", "is_fraud_predicted")
    joined = stream.stream_label_join(predictions, labels, timedelta(hours=2))
    return _stateful(d, joined.select("transaction_id", "is_fraud_predicted", "label"))


@plan("stream_unlabelled", with_views("""
    SELECT transaction_id, is_fraud_predicted, CASE WHEN event_id % 4 <= 2 THEN label END AS label, event_id % 4 > 2 AS unlabelled
    FROM pred""", "pred"))
def stream_unlabelled(d: Domain):
    """As ``stream_label_join``, run to the end: predictions whose label came too late are answered without it."""
    def joined(events):
        labels = d.transactions(events).selectExpr(
            "coalesce(transaction_id, 'end') as transaction_id", "label",
            "ts + make_dt_interval(0, cast(coalesce(event_id % 4, 0) as int)) as label_ts")
        scored = scoring.decide_threshold(scoring.rule_score(d.transactions(events)))
        both = stream.stream_label_join(scored.select("transaction_id", "ts", "is_fraud_predicted"), labels, timedelta(hours=2),
                                        unmatched=True)
        return both.select("transaction_id", "is_fraud_predicted", "label", F.col("label_ts").isNull().alias("unlabelled"))
    return _to_the_end(d, joined)


_STATES = """SELECT series, 'pending' AS state, start AS changed_at FROM runs
    UNION ALL SELECT series, 'firing', fires FROM runs WHERE fires IS NOT NULL
    UNION ALL SELECT series, CASE WHEN fires IS NULL THEN 'inactive' ELSE 'resolved' END, ends FROM runs"""
_STATE_VIEWS = {
    "flags": """SELECT 'pod_' || (user_id % 6) AS series, time_bucket(INTERVAL '1 hour', ev.ts) + INTERVAL '1 hour' AS ts,
        max((ev.ts, k > 30))[2] AS active FROM ev GROUP BY 1, 2""",
    "held": _held_sql("flags"),
    "runs": """SELECT series, pending_since AS start, min(ts) FILTER (WHERE ts >= pending_since + INTERVAL '2 hours') AS fires,
        max(ts) + INTERVAL '1 hour' AS ends FROM held WHERE active GROUP BY series, pending_since""",
}


@plan("stream_alert_state", with_views(_STATES, "ev", more=_STATE_VIEWS))
def stream_alert_state(d: Domain):
    """The newest sample of every pod and hour, held for two; hours without a sample, and the end, break the hold."""
    def states(events):
        flags = events.selectExpr("concat('pod_', user_id % 6) as series", "ts", "k > 30 as active")
        return alert_state.stream_alert_state(flags, HOLD, HOUR)
    return _to_the_end(d, states)


@plan("stream_alert_throttle", with_views(
    "SELECT concat_ws('/', alertname, cluster, service, receiver) AS group_key, ts FROM sent",
    "alerts", more=_SENT_VIEWS, recursive=True))
def stream_alert_throttle(d: Domain):
    """As the batch plan: a route is a group of its own."""
    def sent(events):
        rows = events.selectExpr(
            "event_type", "user_id", "ts",
            "case when event_type = 'error' or k >= 80 then 'critical' else 'warning' end as severity",
            "case event_type when 'click' then 'performance' when 'view' then 'infrastructure' "
            "else 'business' end as alert_type")
        group = F.expr("concat_ws('/', event_type, concat('c_', user_id % 3), 'scoring', receiver)").alias("group_key")
        return alert_state.stream_alert_throttle(alerts.alert_routing(rows).select(group, "ts", "repeat_interval"))
    return _to_the_end(d, sent)


@plan("stream_notifications", with_views(
    f"""SELECT concat_ws('/', {_GROUP}) AS group_key, ts, kind, n, opened_at FROM ({NOTICES})""",
    "ev", more=NOTICE_VIEWS, recursive=True))
def stream_notifications(d: Domain):
    """The notices of the batch plan, from a stream of its alerts."""
    def told(events):
        routed = stretched(alerts.alert_routing(d.firing_members(events)))
        group = F.concat_ws("/", *alerts.SENT_KEYS).alias("group_key")
        return alert_state.stream_notifications(routed.select(group, "ts", "fresh", *LIMITS), HOUR)
    return _to_the_end(d, told)
