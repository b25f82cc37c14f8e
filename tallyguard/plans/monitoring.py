"""Plans over request logs and metric samples: latency, windows and alerts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Window, functions as F

from tallyguard.operators import alerts, cube, latency, notices, timeseries
from tallyguard.plans.domain import BOUND_TEXTS, BOUNDS, BUCKETS, HOLD, STEP, WINDOW, Domain, with_views
from tallyguard.plans.registry import plan
from tallyguard.sources import logs

# An evaluation at ``step`` covers the three panes of one hour before it.
COVER = "(VALUES (1), (2), (3)) w(i)"
AT = "time_bucket(INTERVAL '1 hour', ts) + i * INTERVAL '1 hour'"


def _rounded(df, *cols: str, digits: int = 6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- requests -------------------------------------------------------------

@plan("latency_summary", with_views("""
    SELECT round(avg(ms), 6) AS avg_response_time, min(ms) AS min_response_time, max(ms) AS max_response_time,
        100::DOUBLE * count(*) FILTER (WHERE status_code = 200) / count(*) AS success_rate,
        count(*) AS total_requests, count(*) FILTER (WHERE status_code = 200) AS successful_requests
    FROM log""", "log"))
def latency_summary(d: Domain):
    return _rounded(latency.latency_summary(d.request_log()), "avg_response_time")


@plan("latency_percentiles", with_views("""
    SELECT path, round(avg(ms), 6) AS avg, max(ms) FILTER (WHERE i = floor(n * 0.95::DOUBLE)) AS p95,
        max(ms) FILTER (WHERE i = floor(n * 0.99::DOUBLE)) AS p99
    FROM (SELECT path, ms, row_number() OVER (PARTITION BY path ORDER BY ms) - 1 AS i,
          count(*) OVER (PARTITION BY path) AS n FROM log) GROUP BY path""", "log"))
def latency_percentiles(d: Domain):
    return _rounded(latency.latency_percentiles(d.request_log(), keys=("path",)), "avg")


@plan("latency_percentiles_global", with_views("""
    SELECT round(avg(ms), 6) AS avg, max(ms) FILTER (WHERE i = floor(n * 0.95::DOUBLE)) AS p95,
        max(ms) FILTER (WHERE i = floor(n * 0.99::DOUBLE)) AS p99
    FROM (SELECT ms, row_number() OVER (ORDER BY ms) - 1 AS i, count(*) OVER () AS n FROM log)""", "log"))
def latency_percentiles_global(d: Domain):
    return _rounded(latency.latency_percentiles(d.request_log()), "avg")


@plan("success_rate", with_views("""
    SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS successful,
        count(*) FILTER (WHERE status <> 'success') AS failed,
        100::DOUBLE * count(*) FILTER (WHERE status = 'success') / count(*) AS success_rate,
        count(*) / 2592000::DOUBLE AS avg_rps FROM log""", "log"))
def success_rate(d: Domain):
    return latency.success_rate(d.request_log(), timedelta(days=30).total_seconds())


@plan("outcome_counts", with_views("SELECT status, count(*) AS n FROM log GROUP BY status", "log"))
def outcome_counts(d: Domain):
    return latency.outcome_counts(d.request_log())


@plan("model_serving_metrics", with_views("""SELECT count(seconds) AS predictions_total,
    round(avg(seconds) * 1000, 6) AS avg_prediction_time_ms FROM log""", "log"))
def model_serving_metrics(d: Domain):
    return _rounded(latency.model_serving_metrics(d.request_log()), "avg_prediction_time_ms")


_BOUND_ROWS = "(VALUES " + ", ".join(
    f"('{'inf' if b == float('inf') else b}'::DOUBLE)" for b in latency.DEFAULT_BOUNDS) + ") b(le)"
_HISTOGRAM = f"""SELECT series, le, round(s, 6) AS sum, n AS count, count(*) FILTER (WHERE seconds <= le) AS cumulative
    FROM log JOIN (SELECT series, sum(seconds) AS s, count(*) AS n FROM log GROUP BY series) USING (series), {_BOUND_ROWS}
    GROUP BY ALL"""


def _quantile_sql(source: str, keys: str, q: float) -> str:
    """Linear interpolation inside the bucket of the rank."""
    return f"""SELECT {keys}, CASE WHEN le = 'inf'::DOUBLE THEN low ELSE low + (le - low)
            * ((rank - before) / (cumulative - before)) END AS value
        FROM (SELECT *, {q}::DOUBLE * max(cumulative) OVER (PARTITION BY {keys}) AS rank,
              COALESCE(lag(le) OVER (PARTITION BY {keys} ORDER BY le), 0) AS low,
              COALESCE(lag(cumulative) OVER (PARTITION BY {keys} ORDER BY le), 0) AS before FROM {source})
        WHERE cumulative >= rank AND rank > 0
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY le) = 1"""


@plan("latency_histogram", with_views("SELECT * FROM histogram", "log", more={"histogram": _HISTOGRAM}))
def latency_histogram(d: Domain):
    return _rounded(latency.latency_histogram(d.request_log(), keys=("series",)), "sum")


@plan("histogram_quantile", with_views(_quantile_sql("histogram", "series", 0.95), "log",
                                       more={"histogram": _HISTOGRAM}))
def histogram_quantile(d: Domain):
    return latency.histogram_quantile(latency.latency_histogram(d.request_log(), keys=("series",)), 0.95)


@plan("progress_snapshots", with_views("""
    SELECT bucket, total, successful, total - successful AS failed, 100::DOUBLE * successful / total AS success_rate
    FROM (SELECT bucket, sum(n) OVER (ORDER BY bucket)::BIGINT AS total,
          sum(ok) OVER (ORDER BY bucket)::BIGINT AS successful
    FROM (SELECT time_bucket(INTERVAL '30 seconds', ts) AS bucket, count(*) AS n,
          count(*) FILTER (WHERE status = 'success') AS ok FROM log GROUP BY 1))""", "log"))
def progress_snapshots(d: Domain):
    return latency.progress_snapshots(d.request_log(), timedelta(seconds=30))


# --- windows --------------------------------------------------------------

@plan("request_rate_5m", with_views("""
    SELECT time_bucket(INTERVAL '1 minute', ts) + i * INTERVAL '1 minute' AS step, count(*) / 300::DOUBLE AS rate
    FROM log, (VALUES (1), (2), (3), (4), (5)) w(i) GROUP BY 1""", "log"))
def request_rate_5m(d: Domain):
    return timeseries.request_rate(d.request_log(), timedelta(minutes=1))


@plan("error_rate", with_views(f"""
    SELECT {AT} AS step, 100::DOUBLE * count(*) FILTER (WHERE is_error) / count(*) AS error_rate_pct
    FROM log, {COVER} GROUP BY 1""", "log"))
def error_rate(d: Domain):
    return timeseries.error_rate(d.request_log(), STEP, WINDOW)


@plan("fraud_rate_over_time", with_views(f"""
    SELECT {AT} AS step, 100::DOUBLE * count(*) FILTER (WHERE is_fraud_predicted) / count(*) AS fraud_pct
    FROM pred, {COVER} GROUP BY 1""", "pred"))
def fraud_rate_over_time(d: Domain):
    return timeseries.fraud_rate_over_time(d.predictions(), STEP, WINDOW)


def _counter_sql(scale: str) -> str:
    return f"""SELECT series, step, sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value
            ELSE value - before END)::BIGINT / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000::DOUBLE) {scale}
        FROM (SELECT *, lag(value) OVER (PARTITION BY series, step ORDER BY ts) AS before
              FROM (SELECT series, ts, value, {AT} AS step FROM cpu, {COVER}))
        GROUP BY series, step HAVING max(ts) > min(ts)"""


@plan("counter_rate", with_views(_counter_sql("AS rate"), "cpu"))
def counter_rate(d: Domain):
    return timeseries.counter_rate(d.cpu_counter(), STEP, WINDOW)


def _latest_sql(source: str) -> str:
    return f"SELECT series, {AT} AS step, arg_max(value, ts) AS value FROM {source}, {COVER} GROUP BY ALL"


@plan("latest_sample", with_views(_latest_sql("replicas"), "replicas"))
def latest_sample(d: Domain):
    return timeseries.latest_sample(d.replicas(), STEP, WINDOW)


# The counter counts milliseconds, so its rate / 1000 is a share of one core.
_CPU = _counter_sql("/ 1000::DOUBLE * 100::DOUBLE AS value")
_MEMORY = f"""SELECT series, step, 100::DOUBLE * (value * 1048576::DOUBLE / 104857600::DOUBLE) AS value
    FROM ({_latest_sql('memory')})"""
_UP = f"""SELECT step, count(*) FILTER (WHERE value = 1) AS up_count, count(*) FILTER (WHERE value <> 1) AS down_count
    FROM ({_latest_sql('up')}) GROUP BY step"""
_LOAD = """SELECT series, step, value AS cpu, up_count AS instances, value > 80 AND up_count >= 6 AS active
    FROM cpu_pct JOIN up_counts USING (step)"""
_LOAD_VIEWS = {"cpu_pct": _CPU, "up_counts": _UP, "load": _LOAD}


def _cpu(d: Domain):
    rates = timeseries.counter_rate(d.cpu_counter(), STEP, WINDOW)
    return rates.select("series", "step", (F.col("rate") / F.lit(1000.0) * F.lit(100.0)).alias("value"))


def _up_counts(d: Domain):
    return timeseries.instances_up(timeseries.latest_sample(d.up(), STEP, WINDOW))


@plan("pod_cpu_percent", with_views(
    f"SELECT series, step, round(value, 6) AS value FROM ({_CPU})", "cpu"))
def pod_cpu_percent(d: Domain):
    return _rounded(timeseries.pod_cpu_percent(d.cpu_percent_source(), STEP, WINDOW), "value")


@plan("pod_memory_percent", with_views(_MEMORY, "memory"))
def pod_memory_percent(d: Domain):
    return timeseries.pod_memory_percent(d.memory_used(), d.memory_limit(), STEP, WINDOW)


@plan("vector_ratio", with_views(f"""
    SELECT series, step, 100::DOUBLE * (count(*) FILTER (WHERE is_error)::DOUBLE / count(*)) AS value
    FROM (SELECT series, is_error, {AT} AS step FROM log, {COVER}) GROUP BY series, step
    HAVING count(*) FILTER (WHERE is_error) > 0""", "log"))
def vector_ratio(d: Domain):
    """Errors over all requests, by label: only label sets on both sides give a value."""
    def count(rows):
        return (timeseries.trailing(rows, {"value": F.count("*")}, WINDOW, STEP, ("series",)))
    log = d.request_log()
    return timeseries.vector_ratio(count(log.filter("is_error")), count(log), ("series", "step"))


@plan("instances_up", with_views(_UP, "up"))
def instances_up(d: Domain):
    return _up_counts(d)


@plan("instances_down", with_views(f"SELECT step, series FROM ({_latest_sql('up')}) WHERE value <> 1", "up"))
def instances_down(d: Domain):
    return timeseries.instances_down(timeseries.latest_sample(d.up(), STEP, WINDOW))


@plan("highload_join", with_views(_LOAD, "cpu", "up", more={"cpu_pct": _CPU, "up_counts": _UP}))
def highload_join(d: Domain):
    return timeseries.highload_join(_cpu(d), _up_counts(d))


@plan("stress_goals", with_views("""
    SELECT (SELECT max(value) FROM replicas) AS max_replicas, (SELECT max(value) >= 6 FROM replicas)
        AS max_replicas_reached, (SELECT bool_or(value > 80) FROM cpu_pct) AS high_cpu_detected,
        (SELECT max(value) >= 6 FROM replicas) AND (SELECT bool_or(value > 80) FROM cpu_pct) AS goal_met""",
                                 "replicas", "cpu", more={"cpu_pct": _CPU}))
def stress_goals(d: Domain):
    return timeseries.stress_goals(d.replicas(), _cpu(d))


_P95 = _quantile_sql("buckets", "series, step", 0.95)
_BUCKETS = f"""SELECT series, {AT} AS step, le, count(*) FILTER (WHERE seconds <= le) AS cumulative
    FROM log, {COVER}, {_BOUND_ROWS} GROUP BY ALL"""


# Fixed limits, but for requests: the test tables hold a few of them an hour.
_SCALE = {**timeseries.SCALE_LIMITS, "rps_per_pod": 0.0008}


@plan("scaling_signals", with_views(f"""
    SELECT step, bool_or(s = 'cpu' AND value > 70) AS cpu_high, bool_or(s = 'mem' AND value > 80) AS memory_high,
        bool_or(s = 'rps' AND value > {_SCALE['rps_per_pod']}::DOUBLE) AS rps_per_pod_high,
        bool_or(s = 'p95' AND value > 500) AS p95_ms_high,
        cpu_high OR memory_high OR rps_per_pod_high OR p95_ms_high AS scale_up
    FROM (SELECT 'cpu' AS s, step, avg(value) AS value FROM cpu_pct GROUP BY step
          UNION ALL SELECT 'mem', step, avg(value) FROM memory_pct GROUP BY step
          UNION ALL SELECT 'rps', step, rate / up_count FROM requests JOIN up_counts USING (step) WHERE up_count > 0
          UNION ALL SELECT 'p95', step, avg(value) * 1000 FROM p95 GROUP BY step) GROUP BY step""",
    "cpu", "memory", "log", "up", more={
        "cpu_pct": _CPU, "memory_pct": _MEMORY, "buckets": _BUCKETS, "p95": _P95, "up_counts": _UP,
        "requests": f"SELECT {AT} AS step, count(*) / 10800::DOUBLE AS rate FROM log, {COVER} GROUP BY 1"}))
def scaling_signals(d: Domain):
    """Hourly means over the pods; the request rate is that of all pods over the pods that are up."""
    buckets = [f"le{i}" for i in range(len(latency.DEFAULT_BOUNDS))]
    metrics = cube.Metrics(gauges=("up", "used", "limit"), counters=(("cpu",),), sums={"requests": F.lit(1)} | {
        c: (F.col("seconds") <= F.lit(b)).cast("long") for c, b in zip(buckets, latency.DEFAULT_BOUNDS)})
    pods = cube.windowed(d.pod_scrapes(), STEP, WINDOW, metrics)
    p95 = cube.bucket_quantile(buckets, latency.DEFAULT_BOUNDS, 0.95)
    up = F.count_if(F.col("up") == 1)
    rate = F.sum("requests") / F.lit(WINDOW.total_seconds())
    return timeseries.scaling_flags(pods.groupBy("step").agg(
        F.avg(_cpu_share()).alias("cpu"), F.avg(cube.share("used", "limit")).alias("memory"),
        F.when(up > 0, rate / up).alias("rps_per_pod"), (F.avg(p95) * 1000.0).alias("p95_ms")), _SCALE)


@plan("readiness_rollup", with_views("""
    SELECT 'host_' || (user_id % 20) AS host, CASE max(CASE WHEN value / 5 > 95 THEN 2
        WHEN value / 5 > 90 OR k > 95 THEN 1 ELSE 0 END) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning'
        ELSE 'ready' END AS status FROM ev GROUP BY 1""", "ev"))
def readiness_rollup(d: Domain):
    samples = d.events().selectExpr("concat('host_', user_id % 20) as host", "k as cpu", "value / 5 as memory")
    return timeseries.readiness_rollup(samples)


# --- alerts ---------------------------------------------------------------

def _held_sql(flags: str) -> str:
    """Gaps and islands: an island breaks at an inactive evaluation or after a missing one."""
    return f"""SELECT *, CASE WHEN active THEN min(ts) OVER (PARTITION BY series, island, active) END AS pending_since
        FROM (SELECT *, sum(brk) OVER (PARTITION BY series ORDER BY ts) AS island
        FROM (SELECT *, CASE WHEN active AND lag(active) OVER s AND ts <= lag(ts) OVER s + INTERVAL '1 hour'
              THEN 0 ELSE 1 END AS brk FROM {flags} WINDOW s AS (PARTITION BY series ORDER BY ts)))"""


_FLAGS = "SELECT series, step AS ts, value > 40 AS active, value FROM memory_pct"
_MEMORY_FLAGS = {"memory_pct": _MEMORY, "flags": _FLAGS}


def _memory_flags(d: Domain):
    vector = timeseries.pod_memory_percent(d.memory_used(), d.memory_limit(), STEP, WINDOW)
    return alerts.threshold_flags(vector, alerts.HIGH_MEMORY.tuned(threshold=40.0))


@plan("alert_for_duration", with_views(f"""
    SELECT series, ts, active, pending_since,
        COALESCE(ts >= pending_since + INTERVAL '2 hours', false) AS firing FROM ({_held_sql('flags')})""",
                                       "memory", more=_MEMORY_FLAGS))
def alert_for_duration(d: Domain):
    held = alerts.alert_for_duration(_memory_flags(d), HOLD, STEP)
    return held.select("series", "ts", "active", "pending_since", "firing")


@plan("alert_lifecycle", with_views(f"""
    SELECT series, min(ts) FILTER (WHERE ts >= pending_since + INTERVAL '2 hours') AS starts_at,
        CASE WHEN max(ts) < (SELECT max(ts) FROM flags) THEN max(ts) + INTERVAL '1 hour' END AS ends_at,
        max(ts) < (SELECT max(ts) FROM flags) AS resolved
    FROM ({_held_sql('flags')}) WHERE active GROUP BY series, pending_since
    HAVING max(ts) >= pending_since + INTERVAL '2 hours'""", "memory", more=_MEMORY_FLAGS))
def alert_lifecycle(d: Domain):
    return alerts.alert_lifecycle(_memory_flags(d), HOLD, STEP)


def _rule_sql(rule: alerts.Rule, flags: str = "flags") -> str:
    return f"""SELECT '{rule.alertname}' AS alertname, '{rule.severity}' AS severity, '{rule.alert_type}' AS alert_type,
            series, min(ts) AS starts_at, round(arg_min(value, ts)::DOUBLE, 6) AS value
        FROM ({_held_sql(flags)}) WHERE active AND ts >= pending_since + INTERVAL '2 hours'
        GROUP BY series, pending_since"""


def _firing_sql(rule: alerts.Rule, flags: str) -> str:
    return f"""SELECT '{rule.alertname}' AS alertname, '{rule.severity}' AS severity, '{rule.alert_type}' AS alert_type,
            series, ts, ts < pending_since + INTERVAL '3 hours' AS fresh
        FROM ({_held_sql(flags)}) WHERE active AND ts >= pending_since + INTERVAL '2 hours'"""


RULES = {}  # by plan: the rule, its flags in SQL, the views they read, and their builder
_GAUGES = {}  # by the gauge's name: the rule on its newest value


def _rule(name: str, rule: alerts.Rule, flags_sql: str, views: tuple[str, ...], more: dict[str, str] | None = None,
          gauge: str | None = None):
    """Register one rule with the hold of the sparse test series."""
    tuned = rule.tuned(hold=HOLD)
    sql = with_views(_rule_sql(tuned), *views, more={**(more or {}), "flags": flags_sql})

    def register(build):
        def run(d: Domain):
            return _rounded(alerts.evaluate_rules(build(d, tuned), STEP), "value")
        run.__doc__ = f"{rule.alertname} on the test series, held for two hours."
        RULES[name] = (tuned, flags_sql, views, more or {}, build)
        if gauge:
            _GAUGES[gauge] = tuned
        return plan(name, sql)(run)
    return register


def _vector_flags(sql: str, predicate: str) -> str:
    return f"SELECT series, step AS ts, {predicate} AS active, value FROM ({sql})"


def _on_gauge(name: str, rule: alerts.Rule, view: str, predicate: str, samples):
    build = _rule(name, rule, _vector_flags(_latest_sql(view), predicate), (view,), gauge=view)
    return build(lambda d, tuned: alerts.flags_on_latest(samples(d), STEP, tuned, WINDOW))


@_rule("alert_highload", alerts.HIGH_LOAD.tuned(threshold=40.0),
       "SELECT series, step AS ts, cpu > 40 AND instances >= 6 AS active, cpu AS value FROM load", ("cpu", "up"),
       _LOAD_VIEWS)
def alert_highload(d: Domain, rule):
    return alerts.flags_highload(_cpu(d), _up_counts(d), rule)


alert_max_replicas = _on_gauge("alert_max_replicas", alerts.MAX_REPLICAS, "replicas", "value >= 6", Domain.replicas)
alert_service_down = _on_gauge("alert_service_down", alerts.SERVICE_DOWN, "up", "value = 0", Domain.up)
alert_node_not_ready = _on_gauge("alert_node_not_ready", alerts.NODE_NOT_READY, "ready", "value = 0", Domain.node_ready)
alert_crash_loop = _on_gauge("alert_crash_loop", alerts.CRASH_LOOP, "restarts", "value > 5", Domain.restarts)


@_rule("alert_high_memory", alerts.HIGH_MEMORY.tuned(threshold=50.0), _vector_flags(_MEMORY, "value > 50"), ("memory",))
def alert_high_memory(d: Domain, rule):
    return alerts.flags_high_memory(d.memory_used(), d.memory_limit(), STEP, WINDOW, rule)


_COUNTERS = ["total", "errors", *BUCKETS]
_DROPPED = " OR ".join(f"{c} < p_{c}" for c in BUCKETS)
_RISES = f"""SELECT series, step, {", ".join(
    f"sum(CASE WHEN p_{c} IS NULL THEN 0 WHEN {_DROPPED if c in BUCKETS else f'{c} < p_{c}'} THEN {c} ELSE {c} - p_{c} END) AS {c}"
    for c in _COUNTERS)}, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000::DOUBLE AS seconds
    FROM (SELECT *, {", ".join(f"lag({c}) OVER w AS p_{c}" for c in _COUNTERS)} FROM (SELECT *, {AT} AS step FROM scrapes, {COVER})
          WINDOW w AS (PARTITION BY series, step ORDER BY ts)) GROUP BY series, step HAVING max(ts) > min(ts)"""
_SCRAPED_BUCKETS = " UNION ALL ".join(
    f"SELECT series, step, '{'inf' if b == float('inf') else b}'::DOUBLE AS le, {c} AS cumulative FROM rises" for c, b in zip(BUCKETS, BOUNDS))
_SCRAPED = {"rises": _RISES}
_SAMPLE = {"total": ("ml_predictions_total", {"job": "api"}), "errors": ("ml_prediction_errors_total", {"job": "api"}),
           **{c: ("ml_prediction_duration_seconds_bucket", {"job": "api", "le": b}) for c, b in zip(BUCKETS, BOUND_TEXTS)}}


def _scraped(d: Domain):
    """The pods' counters, read from scrape text."""
    samples = logs.parse_exposition(d.exposition(), "ts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    rows = cube.scrapes(cube.matching_labels(samples, {"job": "api"}), _SAMPLE)
    return rows.withColumn("series", F.get_json_object("series", "$.pod"))


def _on_scrapes(d: Domain, rule):
    rules = tuple(rule if rule.alertname == r.alertname else r for r in (alerts.HIGH_LATENCY, alerts.HIGH_ERROR_RATE, alerts.LOW_PREDICTION_RATE))
    flags = alerts.flags_on_scrapes(_scraped(d), STEP, BUCKETS, BOUNDS, WINDOW, rules=rules)
    return flags.filter(F.col("alertname") == rule.alertname)


@_rule("alert_high_latency", alerts.HIGH_LATENCY, _vector_flags("SELECT * FROM scraped_p95", "value > 0.5"), ("scrapes",),
       _SCRAPED | {"scraped_buckets": _SCRAPED_BUCKETS, "scraped_p95": _quantile_sql("scraped_buckets", "series, step", 0.95)})
def alert_high_latency(d: Domain, rule):
    return _on_scrapes(d, rule)


@_rule("alert_high_error_rate", alerts.HIGH_ERROR_RATE, _vector_flags(
    "SELECT series, step, 100::DOUBLE * (errors / total) AS value FROM rises WHERE total > 0", "value > 5"), ("scrapes",), _SCRAPED)
def alert_high_error_rate(d: Domain, rule):
    return _on_scrapes(d, rule)


@_rule("alert_low_prediction_rate", alerts.LOW_PREDICTION_RATE.tuned(threshold=0.05), _vector_flags(
    "SELECT series, step, total / seconds AS value FROM rises", "value < 0.05::DOUBLE"), ("scrapes",), _SCRAPED)
def alert_low_prediction_rate(d: Domain, rule):
    return _on_scrapes(d, rule)


_ALL_FLAGS = {f"{n}_flags": sql for n, (_, sql, _, _, _) in RULES.items()}
_ALL_VIEWS = list(dict.fromkeys(v for _, _, views, _, _ in RULES.values() for v in views))
_ALL_MORE = {k: v for _, _, _, more, _ in RULES.values() for k, v in more.items()} | _ALL_FLAGS


_METRICS = cube.Metrics(gauges=("up", "replicas", "ready", "restarts", "used", "limit"),
                        counters=(("cpu",), ("total",), ("errors",), tuple(BUCKETS)))


def _cpu_share():
    """The counter counts milliseconds."""
    return cube.rate("cpu") / F.lit(1000.0) * F.lit(100.0)


def _all_flags(d: Domain):
    """The flags of all nine rules, from one cube of all scrapes: the events are read once."""
    windows = cube.windowed(d.scrapes(), STEP, WINDOW, _METRICS).withColumn(
        "up_count", F.count_if(F.col("up") == 1).over(Window.partitionBy("step")))  # a row for each target
    rule = {name: r for name, (r, *_) in RULES.items()}
    judged = [(rule["alert_highload"], _cpu_share(), F.col("up_count") >= 6),
              (rule["alert_high_memory"], cube.share("used", "limit"), None)]
    judged += [(tuned, F.col(gauge), None) for gauge, tuned in _GAUGES.items()]
    judged += alerts.scraped_rules(BUCKETS, BOUNDS, rules=(
        rule["alert_high_latency"], rule["alert_high_error_rate"], rule["alert_low_prediction_rate"]))
    return alerts.flags_on_windows(windows, judged)


@plan("union_rules", with_views(" UNION ALL ".join(
    f"SELECT * FROM ({_rule_sql(rule, f'{n}_flags')})" for n, (rule, *_) in RULES.items()), *_ALL_VIEWS, more=_ALL_MORE))
def union_rules(d: Domain):
    """All nine rules, held in one pass."""
    return _rounded(alerts.evaluate_rules(_all_flags(d), STEP), "value")


_RECEIVER = """CASE WHEN severity = 'critical' THEN 'critical' WHEN alert_type = 'performance' THEN 'performance'
    WHEN alert_type = 'infrastructure' THEN 'infrastructure' ELSE 'default' END"""
_REPEAT = """CASE WHEN severity = 'critical' THEN 300 WHEN alert_type = 'performance' THEN 900
    WHEN alert_type = 'infrastructure' THEN 1800 ELSE 3600 END"""
_WAIT = "CASE WHEN severity = 'critical' THEN 0 ELSE 10 END"


@plan("alert_routing", with_views(f"""
    SELECT alertname, cluster, ts, {_RECEIVER} AS receiver, {_WAIT} AS group_wait, {_REPEAT} AS repeat_interval
    FROM alerts""", "alerts"))
def alert_routing(d: Domain):
    return alerts.alert_routing(d.alert_rows()).select(
        "alertname", "cluster", "ts", "receiver", "group_wait", "repeat_interval")


@plan("alert_grouping", with_views("""
    SELECT alertname, cluster, service, count(*) AS n, min(starts_at) AS starts_at, max(starts_at) AS latest_start
    FROM alerts GROUP BY ALL""", "alerts"))
def alert_grouping(d: Domain):
    return alerts.alert_grouping(d.alert_rows())


_SENT_VIEWS = {
    "routed": f"""SELECT *, min(ts) OVER (PARTITION BY alertname, cluster, service, receiver
        ORDER BY ts RANGE BETWEEN INTERVAL 1 SECOND * gap FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
        FROM (SELECT DISTINCT alertname, cluster, service, {_RECEIVER} AS receiver, ts, {_REPEAT} AS gap FROM alerts)""",
    "sent": """SELECT alertname, cluster, service, receiver, min(ts) AS ts FROM routed GROUP BY ALL
        UNION ALL SELECT r.alertname, r.cluster, r.service, r.receiver, r.nxt FROM sent s JOIN routed r
        ON r.alertname = s.alertname AND r.cluster = s.cluster AND r.service = s.service AND r.receiver = s.receiver
        AND r.ts = s.ts WHERE r.nxt IS NOT NULL""",
}


@plan("alert_repeat_throttle", with_views("SELECT * FROM sent", "alerts", more=_SENT_VIEWS, recursive=True))
def alert_repeat_throttle(d: Domain):
    """Groups hold alerts of several severities, and so of several routes."""
    return alerts.alert_repeat_throttle(alerts.alert_routing(d.alert_rows()))


_GROUP = "alertname, cluster, service, receiver"


def _notices_sql(until: str | None, scale: int = 1) -> tuple[str, dict[str, str]]:
    """(body, views) of the notices of ``alerts``, by steps of an hour; ``scale`` stretches the limits."""
    same = " AND ".join(f"{{0}}.{c} = {{1}}.{c}" for c in [*_GROUP.split(", "), "island"])
    over = f"PARTITION BY {_GROUP}"
    views = {
        "steps": f"""SELECT alertname, cluster, service, {_RECEIVER} AS receiver, ts, {scale} * ({_WAIT}) AS wait,
            {scale} * 10 AS news, {scale} * ({_REPEAT}) AS gap, count(*) AS n, bool_or(fresh) AS fresh FROM alerts GROUP BY ALL""",
        "islands": f"""SELECT *, sum(brk) OVER ({over} ORDER BY ts) AS island FROM (SELECT *, CASE
            WHEN ts <= lag(ts) OVER ({over} ORDER BY ts) + INTERVAL '1 hour' THEN 0 ELSE 1 END AS brk FROM steps)""",
        "episodes": f"""SELECT *, min(ts) OVER ({over}, island) AS opened_at, max(ts) OVER ({over}, island) AS ended,
            min(CASE WHEN fresh THEN ts END) OVER ({over}, island ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
            AS told FROM islands""",
        "hops": f"""SELECT {", ".join("e." + c for c in _GROUP.split(", "))}, e.island, e.ts, min(x.ts) AS nxt FROM episodes e
            JOIN episodes x ON {same.format("x", "e")} AND x.ts > e.ts AND (x.ts >= e.ts + INTERVAL 1 SECOND * e.gap
            OR x.ts >= e.told AND x.ts >= e.ts + INTERVAL 1 SECOND * e.news) GROUP BY ALL""",
        "sent": f"""SELECT {_GROUP}, island, min(ts) AS ts FROM episodes WHERE ts >= opened_at + INTERVAL 1 SECOND * wait GROUP BY ALL
            UNION ALL SELECT {", ".join("h." + c for c in _GROUP.split(", "))}, h.island, h.nxt FROM sent s
            JOIN hops h ON {same.format("h", "s")} AND h.ts = s.ts""",
    }
    over_by = f" AND ended + INTERVAL '1 hour' <= {until}" if until else ""
    return f"""SELECT {_GROUP}, ts, 'firing' AS kind, n, opened_at FROM sent JOIN episodes USING ({_GROUP}, island, ts)
        UNION ALL SELECT {_GROUP}, ended + INTERVAL '1 hour', 'resolved', n, opened_at FROM episodes e
        WHERE ts = ended{over_by} AND EXISTS (FROM sent s WHERE {same.format("s", "e")})""", views


# Limits are stretched by an hour for ten seconds: the test tables hold a few alerts an hour.
STRETCH = 360
NOTICES, _NOTICE_VIEWS = _notices_sql(None, STRETCH)
MEMBERS = """SELECT event_type AS alertname, 'c_' || (user_id % 3) AS cluster, 'scoring' AS service,
    CASE WHEN event_type = 'error' THEN 'critical' ELSE 'warning' END AS severity,
    CASE event_type WHEN 'click' THEN 'performance' WHEN 'view' THEN 'infrastructure' ELSE 'business' END AS alert_type,
    date_trunc('hour', ts) AS ts, k < 40 AS fresh FROM ev"""
NOTICE_VIEWS = {"alerts": MEMBERS, **_NOTICE_VIEWS}


def stretched(routed):
    return routed.withColumns({c: F.col(c) * STRETCH for c in ("group_wait", "group_interval", "repeat_interval")})


@plan("alert_notifications", with_views(NOTICES, "ev", more=NOTICE_VIEWS, recursive=True))
def alert_notifications(d: Domain):
    """What is sent of the groups of the test alerts, with waits, news, repeats and resolutions."""
    return notices.group_notices(stretched(alerts.alert_routing(d.firing_members())), alerts.SENT_KEYS, STEP)


_FIRING = " UNION ALL ".join(f"SELECT * FROM ({_firing_sql(rule, f'{n}_flags')})" for n, (rule, *_) in RULES.items())
_LAST = "(SELECT max(ts) FROM (" + " UNION ALL ".join(f"SELECT max(ts) AS ts FROM {n}" for n in _ALL_FLAGS) + "))"
_PIPELINE, _PIPELINE_VIEWS = _notices_sql(_LAST)


@plan("alert_pipeline", with_views(_PIPELINE, *_ALL_VIEWS, recursive=True, more=_ALL_MORE | {
    "alerts": f"SELECT *, 'c_' || right(series, 1) AS cluster, 'scoring' AS service FROM ({_FIRING})"} | _PIPELINE_VIEWS))
def alert_pipeline(d: Domain):
    """From the samples of all series to what is sent: nine rules, held, routed, grouped, told and resolved."""
    labels = {"cluster": F.concat(F.lit("c_"), F.right("series", F.lit(1))), "service": F.lit("scoring")}
    return alerts.notifications(_all_flags(d), STEP, labels)
