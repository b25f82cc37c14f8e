"""Domain tables derived from the given test tables, for Spark and as SQL views.

Each table exists twice: as a DataFrame here and as a common table expression in
``VIEWS``, with the same rows, so that results can be compared.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyguard.operators import scoring
from tallyguard.sources.generators import POOL_CATEGORIES

STEP = timedelta(hours=1)
WINDOW = timedelta(hours=3)
HOLD = timedelta(hours=2)

BUCKETS, BOUNDS, BOUND_TEXTS = ["b0", "b1", "b2", "b3"], (0.1, 0.5, 1.0, float("inf")), ("0.1", "0.5", "1.0", "+Inf")

# Schemas of the given tables that are read: known, so that no job has to look into files for them.
EVENTS = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
          "value double, props string")
TABLES = {
    "events": EVENTS,
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "pages": "page_id bigint, url string, html string",
}

TEST_NAMES = ["Health Check /health", "Single Prediction", "Batch Prediction", "Input Validation",
              "Performance Test", "Documentation /docs", "API Availability", "Smoke"]


class Domain:
    """The tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def events(self, rows: DataFrame | None = None) -> DataFrame:
        rows = self.table("events") if rows is None else rows
        return rows.selectExpr("event_id", "ts", "user_id", "event_type", "value",
                               "cast(regexp_extract(props, '([0-9]+)', 1) as int) as k")

    @property
    def events_glob(self) -> str:
        """The events for a file stream: as a glob, since a single file is no base path."""
        return f"{self.sf_dir}/events.parque[t]"

    def event_stream(self, rows: DataFrame | None = None) -> DataFrame:
        """The events as a stream of files; a watermark needs the zoned timestamp type.

        No cap per trigger: files need not be in the order of time, and a capped
        trigger could let the watermark pass rows that are still to be read.
        """
        rows = self.spark.readStream.schema(EVENTS).parquet(self.events_glob) if rows is None else rows
        return self.events(rows).withColumn("ts", F.col("ts").cast("timestamp"))

    def transactions(self, rows: DataFrame | None = None) -> DataFrame:
        categories = ", ".join(f"'{c}'" for c in POOL_CATEGORIES)
        return (self.events() if rows is None else rows).selectExpr(
            "event_id", "concat('tx_', lpad(cast(event_id as string), 10, '0')) as transaction_id", "ts",
            "concat('u_', user_id) as user_id", "concat('m_', 100 + event_id * 31 % 900) as merchant_id",
            "value * 5 as amount",
            f"element_at(array({categories}), cast(event_id % 10 + 1 as int)) as merchant_category",
            "hour(ts) as hour_of_day", "weekday(ts) as day_of_week",
            "case when user_id % 5 = 0 then null else cast(18 + (user_id * 7) % 63 as int) end as user_age",
            "case when event_id % 7 = 0 then null else k / 100D end as location_risk_score",
            "(value * 5 > 500D) <> (event_id % 17 = 0) as label",
            "cast((value * 5 > 500D) <> (event_id % 17 = 0) as int) as is_fraud",
            "value / 500D as score")

    def raw(self) -> DataFrame:
        """Transactions as text, some of them broken."""
        return self.transactions().selectExpr(
            "event_id", "transaction_id", "label",
            "case when event_id % 80 = 0 then 'invalid_amount' when event_id % 50 = 0 then concat('-', amount) "
            "else cast(amount as string) end as amount",
            "case when event_id % 70 = 0 then null else merchant_category end as merchant_category",
            "case when event_id % 60 = 0 then '25' else cast(hour_of_day as string) end as hour_of_day",
            "case when event_id % 130 = 1 then '7' else cast(day_of_week as string) end as day_of_week",
            "case when event_id % 90 = 1 then '121' else cast(user_age as string) end as user_age",
            "case when event_id % 110 = 1 then '1.01' else cast(location_risk_score as string) end "
            "as location_risk_score")

    def predictions(self) -> DataFrame:
        return scoring.decide_threshold(scoring.rule_score(self.transactions()))

    def requests(self) -> DataFrame:
        """Batch requests of very different sizes."""
        return self.events().selectExpr(
            "event_id", "concat('tx_', lpad(cast(event_id as string), 10, '0')) as transaction_id",
            "case when user_id % 3 = 0 then user_id % 30 else user_id end as request_id", "value * 5 as amount",
            "(case when user_id % 3 = 0 then user_id % 30 else user_id end) % 50 * 10D + 5D as total_ms")

    def request_log(self) -> DataFrame:
        return self.events().selectExpr(
            "event_id", "ts", "concat('/', event_type) as path", "case when event_type = 'error' then 500 else 200 end "
            "as status_code", "value as ms", "value / 400D as seconds",
            "case when event_type <> 'error' then 'success' when k % 4 = 0 then 'failed' "
            "when k % 4 = 1 then 'timeout' when k % 4 = 2 then 'error' else 'exception' end as status",
            "event_type = 'error' as is_error", "concat('pod_', user_id % 6) as series", "k")

    def cpu_counter(self) -> DataFrame:
        """A counter of cpu milliseconds per pod that starts over every day."""
        second = "cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) as bigint)"
        return self.events().selectExpr("concat('pod_', user_id % 6) as series", "ts",
                                        f"{second} * {second} * (user_id % 6 + 1) div 260 as value")

    def cpu_percent_source(self) -> DataFrame:
        """The same counter in seconds."""
        return self.cpu_counter().withColumn("value", F.expr("value / 1000D"))

    def gauge(self, value: str, series: str = "concat('pod_', user_id % 6)") -> DataFrame:
        return self.events().selectExpr(f"{series} as series", "ts", f"{value} as value")

    def up(self) -> DataFrame:
        return self.gauge("case when k < 5 then 0 else 1 end")

    def replicas(self) -> DataFrame:
        return self.gauge("4 + k % 4", "concat('deployment_', user_id % 2)")

    def memory_used(self) -> DataFrame:
        return self.gauge("k * 1048576L")

    def memory_limit(self) -> DataFrame:
        return self.gauge("104857600L")

    def node_ready(self) -> DataFrame:
        return self.gauge("case when k < 30 then 0 else 1 end", "concat('node_', user_id % 3)")

    def restarts(self) -> DataFrame:
        return self.gauge("k % 8")

    def gauges(self) -> DataFrame:
        """All gauges as one table of samples, named as their views."""
        return self.events().selectExpr("ts", """inline(array(
            named_struct('name', 'replicas', 'series', concat('deployment_', user_id % 2), 'value', 4 + k % 4),
            named_struct('name', 'up', 'series', concat('pod_', user_id % 6), 'value', case when k < 5 then 0 else 1 end),
            named_struct('name', 'ready', 'series', concat('node_', user_id % 3), 'value', case when k < 30 then 0 else 1 end),
            named_struct('name', 'restarts', 'series', concat('pod_', user_id % 6), 'value', k % 8)))""")

    def pod_scrapes(self) -> DataFrame:
        """Every event as a scrape of its pod: gauges, counters that start over every day, a histogram, and a request.

        The bucket up to 0.1 s starts over at noon too, alone.
        """
        second, pod = "cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) as bigint)", "(user_id % 6 + 1)"
        total = f"{second} * {pod} div 60"
        return self.events().selectExpr(
            "concat('pod_', user_id % 6) as series", "ts", "user_id", "k", "value / 400D as seconds",
            "case when k < 5 then 0 else 1 end as up", "k % 8 as restarts", "k * 1048576L as used", "104857600L as limit",
            f"{second} * {second} * {pod} div 260 as cpu", f"{total} as total", f"{second} * {second} * {pod} div 40000000 as errors",
            f"{second} % 43200 * {pod} div 100 as b0",
            f"case when user_id % 2 = 0 then ({total}) * 9 div 10 else ({total}) * 97 div 100 end as b1",
            f"({total}) * 99 div 100 as b2", f"{total} as b3")

    def scrapes(self) -> DataFrame:
        """The scrapes of pods, deployments and nodes: a row for each, null where a target lacks a metric."""
        kinds = {"pod": ("series", {c: c for c in ("up", "restarts", "used", "limit", "cpu", "total", "errors", *BUCKETS)}),
                 "deployment": ("concat('deployment_', user_id % 2)", {"replicas": "4 + k % 4"}),
                 "node": ("concat('node_', user_id % 3)", {"ready": "case when k < 30 then 0 else 1 end"})}
        names = [c for _, own in kinds.values() for c in own]
        rows = [f"struct({series} as series, " + ", ".join(f"cast({own.get(c, 'null')} as bigint) as {c}" for c in names) + ")"
                for series, own in kinds.values()]
        return self.pod_scrapes().selectExpr("ts", f"inline(array({', '.join(rows)}))")

    def exposition(self) -> DataFrame:
        """The counters of the pods as scrape text."""
        at = "concat('job=\"api\",pod=\"', series, '\"')"
        lines = [f"concat('ml_predictions_total{{', {at}, '}} ', total)", f"concat('ml_prediction_errors_total{{', {at}, '}} ', errors)",
                 f"concat('ml_predictions_total{{job=\"other\",pod=\"', series, '\"}} 7')"]
        lines += [f"concat('ml_prediction_duration_seconds_bucket{{', {at}, ',le=\"{b}\"}} ', {c})" for c, b in zip(BUCKETS, BOUND_TEXTS)]
        return self.pod_scrapes().selectExpr("ts", f"explode(array({', '.join(lines)})) as value")

    def alert_rows(self) -> DataFrame:
        """Alerts as rules give them: one evaluation a minute."""
        return self.events().selectExpr(
            "event_type as alertname", "concat('c_', user_id % 3) as cluster", "'scoring' as service",
            "case when event_type = 'error' or k >= 80 then 'critical' else 'warning' end as severity",
            "case event_type when 'click' then 'performance' when 'view' then 'infrastructure' "
            "else 'business' end as alert_type", "date_trunc('minute', ts) as ts", "ts as starts_at")

    def firing_members(self, rows: DataFrame | None = None) -> DataFrame:
        """Members of alert groups that fire in an hour; some have begun to in this one."""
        return (self.events() if rows is None else rows).selectExpr(
            "event_type as alertname", "concat('c_', user_id % 3) as cluster", "'scoring' as service",
            "case when event_type = 'error' then 'critical' else 'warning' end as severity",
            "case event_type when 'click' then 'performance' when 'view' then 'infrastructure' "
            "else 'business' end as alert_type", "date_trunc('hour', ts) as ts", "k < 40 as fresh")

    def registry(self) -> DataFrame:
        return self.table("part").selectExpr(
            "concat('model_', p_partkey div 12) as model_name", "cast(p_partkey % 12 + 1 as string) as version",
            "case when p_partkey div 12 % 3 = 0 and p_partkey % 12 = p_partkey div 12 % 12 then 'champion' end as alias",
            "case when p_partkey div 12 % 3 <> 2 and p_partkey % 4 = 1 then 'Production' "
            "when p_partkey % 3 = 0 then 'Staging' when p_partkey % 3 = 1 then 'Archived' else 'None' end as stage",
            "concat('run_', p_partkey) as run_id", "timestamp_ntz'2024-01-01 00:00:00' as creation_timestamp",
            "timestamp_ntz'2024-01-01 00:00:00' as last_updated_timestamp", "p_type as description",
            "map('brand', p_brand) as tags")

    def model_metrics(self) -> DataFrame:
        return self.table("part").selectExpr(
            "concat('model_', p_partkey div 12) as model_name", "cast(p_partkey % 12 + 1 as string) as version",
            "0.80D + p_partkey * 7 % 20 / 100D as accuracy", "0.75D + p_partkey * 3 % 25 / 100D as precision",
            "0.70D + p_partkey * 11 % 30 / 100D as recall", "0.80D + p_partkey * 13 % 20 / 100D as f1_score",
            "0.90D + p_partkey % 10 / 100D as auc_roc")

    def runs(self) -> DataFrame:
        return self.table("orders").selectExpr("o_orderkey as run_id", "to_date(o_orderdate) as execution_date")

    def run_performance(self) -> DataFrame:
        return self.table("orders").filter("o_orderkey % 10 <> 3").selectExpr(
            "o_orderkey as run_id", "80D + o_orderkey % 25 as throughput_efficiency",
            "o_totalprice / 1000D as avg_processing_latency_ms",
            "case when o_orderkey % 10 = 5 then 'timeout' end as error")

    def run_quality(self) -> DataFrame:
        return self.table("orders").filter("o_orderkey % 10 <> 7").selectExpr(
            "o_orderkey as run_id", "0.75D + o_orderkey * 3 % 25 / 100D as accuracy",
            "o_orderkey * 7 % 20 / 100D as model_drift_score",
            "case when o_orderkey % 11 = 4 then 'no model' end as error")

    def clusters(self) -> DataFrame:
        return self.table("orders").filter("o_orderstatus <> 'P'").selectExpr(
            "o_orderkey as run_id", "concat('cluster_', o_custkey) as cluster_id")

    def test_results(self) -> DataFrame:
        names = ", ".join(f"'{n}'" for n in TEST_NAMES)
        return self.events().selectExpr(
            "concat('run_', user_id) as test_run_id",
            f"element_at(array({names}), cast(event_id % 8 + 1 as int)) as test_name",
            "case k % 10 when 0 then '❌ FAIL' when 1 then '❌ FAILED' when 2 then '❌ ERROR' "
            "when 3 then '✅ COMPLETED' else '✅ PASS' end as status", "value as response_time_ms", "ts as timestamp")


_CATEGORIES = ", ".join(f"'{c}'" for c in POOL_CATEGORIES)
_NAMES = ", ".join(f"'{n}'" for n in TEST_NAMES)
_GAUGE = "SELECT {series} AS series, ts, {value} AS value FROM ev"
_SECOND = "(hour(ts) * 3600 + minute(ts) * 60 + second(ts))::BIGINT"

VIEWS = {
    "ev": "SELECT event_id, ts, user_id, event_type, value, "
          "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events",
    "tx": f"""SELECT event_id, 'tx_' || lpad(event_id::VARCHAR, 10, '0') AS transaction_id, ts,
        'u_' || user_id AS user_id, 'm_' || (100 + event_id * 31 % 900) AS merchant_id, value * 5 AS amount,
        ([{_CATEGORIES}])[event_id % 10 + 1] AS merchant_category,
        hour(ts)::INTEGER AS hour_of_day, (isodow(ts) - 1)::INTEGER AS day_of_week,
        CASE WHEN user_id % 5 = 0 THEN NULL ELSE (18 + (user_id * 7) % 63)::INTEGER END AS user_age,
        CASE WHEN event_id % 7 = 0 THEN NULL ELSE k / 100::DOUBLE END AS location_risk_score,
        (value * 5 > 500) <> (event_id % 17 = 0) AS label,
        ((value * 5 > 500) <> (event_id % 17 = 0))::INTEGER AS is_fraud, value / 500::DOUBLE AS score FROM ev""",
    "raw": """SELECT event_id, transaction_id, label,
        CASE WHEN event_id % 80 = 0 THEN 'invalid_amount' WHEN event_id % 50 = 0 THEN '-' || amount::VARCHAR
             ELSE amount::VARCHAR END AS amount,
        CASE WHEN event_id % 70 = 0 THEN NULL ELSE merchant_category END AS merchant_category,
        CASE WHEN event_id % 60 = 0 THEN '25' ELSE hour_of_day::VARCHAR END AS hour_of_day,
        CASE WHEN event_id % 130 = 1 THEN '7' ELSE day_of_week::VARCHAR END AS day_of_week,
        CASE WHEN event_id % 90 = 1 THEN '121' ELSE user_age::VARCHAR END AS user_age,
        CASE WHEN event_id % 110 = 1 THEN '1.01' ELSE location_risk_score::VARCHAR END AS location_risk_score
        FROM tx""",
    "checked": """SELECT *, concat_ws(',',
        CASE WHEN TRY_CAST(amount AS DOUBLE) IS NULL THEN 'amount:type' END,
        CASE WHEN TRY_CAST(amount AS DOUBLE) < 0 THEN 'amount:range' END,
        CASE WHEN merchant_category IS NULL THEN 'merchant_category:missing' END,
        CASE WHEN TRY_CAST(hour_of_day AS INTEGER) NOT BETWEEN 0 AND 23 THEN 'hour_of_day:range' END,
        CASE WHEN TRY_CAST(day_of_week AS INTEGER) NOT BETWEEN 0 AND 6 THEN 'day_of_week:range' END,
        CASE WHEN TRY_CAST(user_age AS INTEGER) NOT BETWEEN 0 AND 120 THEN 'user_age:range' END,
        CASE WHEN TRY_CAST(location_risk_score AS DOUBLE) NOT BETWEEN 0 AND 1
             THEN 'location_risk_score:range' END) AS errors FROM raw""",
    "feat": """SELECT transaction_id, amount,
        CASE merchant_category WHEN 'grocery' THEN 0 WHEN 'gas_station' THEN 1 WHEN 'restaurant' THEN 2
             WHEN 'retail' THEN 3 WHEN 'online' THEN 4 WHEN 'electronics' THEN 5 WHEN 'pharmacy' THEN 6
             ELSE 7 END::DOUBLE AS merchant_category,
        hour_of_day::DOUBLE AS hour_of_day, day_of_week::DOUBLE AS day_of_week,
        COALESCE(user_age, 35)::DOUBLE AS user_age,
        COALESCE(location_risk_score, 0.5::DOUBLE) AS location_risk_score, label FROM tx""",
    "pred": """SELECT *, CASE WHEN amount > 500 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END AS fraud_probability,
        amount > 500 AS is_fraud_predicted FROM tx""",
    "req": """SELECT event_id, 'tx_' || lpad(event_id::VARCHAR, 10, '0') AS transaction_id,
        CASE WHEN user_id % 3 = 0 THEN user_id % 30 ELSE user_id END AS request_id, value * 5 AS amount,
        (CASE WHEN user_id % 3 = 0 THEN user_id % 30 ELSE user_id END) % 50 * 10::DOUBLE + 5 AS total_ms FROM ev""",
    "log": """SELECT event_id, ts, '/' || event_type AS path,
        CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code, value AS ms,
        value / 400::DOUBLE AS seconds,
        CASE WHEN event_type <> 'error' THEN 'success' WHEN k % 4 = 0 THEN 'failed' WHEN k % 4 = 1 THEN 'timeout'
             WHEN k % 4 = 2 THEN 'error' ELSE 'exception' END AS status,
        event_type = 'error' AS is_error, 'pod_' || (user_id % 6) AS series, k FROM ev""",
    "cpu": f"""SELECT 'pod_' || (user_id % 6) AS series, ts,
        {_SECOND} * {_SECOND} * (user_id % 6 + 1) // 260 AS value FROM ev""",
    "up": _GAUGE.format(series="'pod_' || (user_id % 6)", value="CASE WHEN k < 5 THEN 0 ELSE 1 END"),
    "scrapes": f"""SELECT series, ts, total::DOUBLE AS total, (s * s * p // 40000000)::DOUBLE AS errors,
        (s % 43200 * p // 100)::DOUBLE AS b0, (CASE WHEN user_id % 2 = 0 THEN total * 9 // 10 ELSE total * 97 // 100 END)::DOUBLE AS b1,
        (total * 99 // 100)::DOUBLE AS b2, total::DOUBLE AS b3
        FROM (SELECT 'pod_' || (user_id % 6) AS series, ts, user_id, {_SECOND} AS s, user_id % 6 + 1 AS p,
              {_SECOND} * (user_id % 6 + 1) // 60 AS total FROM ev)""",
    "replicas": _GAUGE.format(series="'deployment_' || (user_id % 2)", value="4 + k % 4"),
    "memory": _GAUGE.format(series="'pod_' || (user_id % 6)", value="k"),
    "ready": _GAUGE.format(series="'node_' || (user_id % 3)", value="CASE WHEN k < 30 THEN 0 ELSE 1 END"),
    "restarts": _GAUGE.format(series="'pod_' || (user_id % 6)", value="k % 8"),
    "alerts": """SELECT event_type AS alertname, 'c_' || (user_id % 3) AS cluster, 'scoring' AS service,
        CASE WHEN event_type = 'error' OR k >= 80 THEN 'critical' ELSE 'warning' END AS severity,
        CASE event_type WHEN 'click' THEN 'performance' WHEN 'view' THEN 'infrastructure'
             ELSE 'business' END AS alert_type, date_trunc('minute', ts) AS ts, ts AS starts_at FROM ev""",
    "registry": """SELECT 'model_' || (p_partkey // 12) AS model_name, (p_partkey % 12 + 1)::VARCHAR AS version,
        CASE WHEN p_partkey // 12 % 3 = 0 AND p_partkey % 12 = p_partkey // 12 % 12 THEN 'champion' END AS alias,
        CASE WHEN p_partkey // 12 % 3 <> 2 AND p_partkey % 4 = 1 THEN 'Production'
             WHEN p_partkey % 3 = 0 THEN 'Staging' WHEN p_partkey % 3 = 1 THEN 'Archived' ELSE 'None' END AS stage,
        'run_' || p_partkey AS run_id, TIMESTAMP '2024-01-01 00:00:00' AS last_updated_timestamp, p_partkey,
        p_brand FROM part""",
    "metrics": """SELECT 'model_' || (p_partkey // 12) AS model_name, (p_partkey % 12 + 1)::VARCHAR AS version,
        0.80::DOUBLE + p_partkey * 7 % 20 / 100::DOUBLE AS accuracy,
        0.75::DOUBLE + p_partkey * 3 % 25 / 100::DOUBLE AS precision,
        0.70::DOUBLE + p_partkey * 11 % 30 / 100::DOUBLE AS recall,
        0.80::DOUBLE + p_partkey * 13 % 20 / 100::DOUBLE AS f1_score,
        0.90::DOUBLE + p_partkey % 10 / 100::DOUBLE AS auc_roc FROM part""",
    "champions": """SELECT model_name, version,
        CASE prio WHEN 0 THEN 'alias' WHEN 1 THEN 'stage' ELSE 'latest' END AS reason FROM (
        SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY prio, version::BIGINT DESC) AS rn FROM (
        SELECT *, CASE WHEN alias = 'champion' THEN 0 WHEN stage = 'Production' THEN 1 ELSE 2 END AS prio
        FROM registry)) WHERE rn = 1""",
    "perf": """SELECT o_orderkey AS run_id, 80::DOUBLE + o_orderkey % 25 AS throughput_efficiency,
        o_totalprice / 1000::DOUBLE AS avg_processing_latency_ms,
        CASE WHEN o_orderkey % 10 = 5 THEN 'timeout' END AS error FROM orders WHERE o_orderkey % 10 <> 3""",
    "quality": """SELECT o_orderkey AS run_id, 0.75::DOUBLE + o_orderkey * 3 % 25 / 100::DOUBLE AS accuracy,
        o_orderkey * 7 % 20 / 100::DOUBLE AS model_drift_score,
        CASE WHEN o_orderkey % 11 = 4 THEN 'no model' END AS error FROM orders WHERE o_orderkey % 10 <> 7""",
    "clusters": """SELECT o_orderkey AS run_id, 'cluster_' || o_custkey AS cluster_id
        FROM orders WHERE o_orderstatus <> 'P'""",
    "results": f"""SELECT 'run_' || user_id AS test_run_id, ([{_NAMES}])[event_id % 8 + 1] AS test_name,
        CASE k % 10 WHEN 0 THEN '❌ FAIL' WHEN 1 THEN '❌ FAILED' WHEN 2 THEN '❌ ERROR'
             WHEN 3 THEN '✅ COMPLETED' ELSE '✅ PASS' END AS status, value AS response_time_ms, ts AS timestamp
        FROM ev""",
}

_NEEDS = {
    "tx": ["ev"], "raw": ["ev", "tx"], "checked": ["ev", "tx", "raw"], "feat": ["ev", "tx"],
    "pred": ["ev", "tx"], "champions": ["registry"],
    **{v: ["ev"] for v in ("req", "log", "cpu", "up", "replicas", "memory", "ready", "restarts",
                           "alerts", "results", "scrapes")},
}


def with_views(body: str, *views: str, more: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``body`` after the views it reads, and those these read; ``more`` adds views of its own."""
    chain: dict[str, str] = {}
    for view in views:
        for name in [*_NEEDS.get(view, []), view]:
            chain[name] = VIEWS[name]
    chain.update(more or {})
    listed = ",\n".join(f"{name} AS ({text})" for name, text in chain.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{listed}\n{body}" if chain else body
