"""Plans over the model registry, training data and model runs."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallyguard.operators import quality, registry, registry_store, reports, scoring, training
from tallyguard.plans.domain import Domain, with_views
from tallyguard.plans.registry import plan
from tallyguard.plans.transactions import _SPLIT
from tallyguard.session import scratch_dir
from tallyguard.sources import sinks

FOREST = {"numTrees": 20, "maxDepth": 5}


# --- registry -------------------------------------------------------------

@plan("registry_latest", with_views("""
    SELECT model_name, stage, version, run_id FROM registry
    QUALIFY row_number() OVER (PARTITION BY model_name, stage ORDER BY version::BIGINT DESC) = 1""", "registry"))
def registry_latest(d: Domain):
    return registry.registry_latest(d.registry()).select("model_name", "stage", "version", "run_id")


@plan("resolve_champion", with_views("SELECT * FROM champions", "champions"))
def resolve_champion(d: Domain):
    return registry.resolve_champion(d.registry())


@plan("register_version", with_views("""
    SELECT model_name, version, stage, run_id FROM registry
    UNION ALL SELECT 'model_' || s_suppkey, (COALESCE((SELECT max(version::BIGINT) FROM registry
        WHERE model_name = 'model_' || s_suppkey), 0) + 1)::VARCHAR, 'None', 'candidate_' || s_suppkey
    FROM supplier""", "registry"))
def register_version(d: Domain):
    """One candidate per supplier joins the registry."""
    candidates = d.table("supplier").selectExpr(
        "concat('model_', s_suppkey) as model_name", "concat('candidate_', s_suppkey) as run_id",
        "map('model_type', 'random_forest') as params", "map('auc', cast(s_acctbal as string)) as metrics",
        "concat('models/', s_suppkey) as source_path", "timestamp_ntz'2024-02-01 00:00:00' as ts")
    return registry.register_version(d.registry(), candidates).select("model_name", "version", "stage", "run_id")


_REGISTERED = """SELECT 'model_' || s_suppkey AS model_name, (COALESCE((SELECT max(version::BIGINT) FROM registry
    WHERE model_name = 'model_' || s_suppkey), 0) + 1)::VARCHAR AS version, NULL AS alias, 'None' AS stage FROM supplier"""
_COMMITTED = f"""SELECT r.model_name, version, CASE WHEN version = new_version THEN 'champion'
        WHEN new_version IS NOT NULL AND alias = 'champion' THEN NULL ELSE alias END AS alias,
    CASE WHEN version = new_version THEN 'Production'
        WHEN new_version IS NOT NULL AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage, 3::BIGINT AS number
    FROM (SELECT model_name, version, alias, stage FROM registry UNION ALL SELECT model_name, version, alias, stage FROM registered) r
    LEFT JOIN (SELECT model_name, new_version FROM judged WHERE should_promote) USING (model_name)"""


_MEASURES = ["accuracy", "precision", "recall", "f1_score", "auc_roc"]
_PAIR = "SELECT c.model_name, c.version AS champion_version, n.version AS new_version, " + ", ".join(
    f"o.{m} AS champion_{m}, w.{m} AS new_{m}" for m in _MEASURES) + """
    FROM champions c JOIN (SELECT model_name, max(version::BIGINT)::VARCHAR AS version FROM registry GROUP BY 1) n
    USING (model_name) LEFT JOIN metrics o ON o.model_name = c.model_name AND o.version = c.version
    LEFT JOIN metrics w ON w.model_name = c.model_name AND w.version = n.version"""


def _pair(d: Domain):
    return registry.champion_challenger(d.model_metrics(), d.registry())


@plan("champion_challenger", with_views(_PAIR, "champions", "metrics"))
def champion_challenger(d: Domain):
    return _pair(d)


_JUDGED = """SELECT model_name, new_version, new_f1_score - champion_f1_score AS improvement_score,
    COALESCE(new_f1_score > champion_f1_score + 0.02::DOUBLE, false) AS should_promote FROM pair"""


@plan("should_promote", with_views(_JUDGED, "champions", "metrics", more={"pair": _PAIR}))
def should_promote(d: Domain):
    return registry.should_promote(_pair(d)).select(
        "model_name", "new_version", "improvement_score", "should_promote")


@plan("promote_champion", with_views("""
    SELECT r.model_name, version, CASE WHEN version = new_version THEN 'champion'
            WHEN new_version IS NOT NULL AND alias = 'champion' THEN NULL ELSE alias END AS alias,
        CASE WHEN version = new_version THEN 'Production'
            WHEN new_version IS NOT NULL AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage,
        CASE WHEN version = new_version OR (new_version IS NOT NULL AND stage = 'Production')
            THEN TIMESTAMP '2024-02-01 00:00:00' ELSE last_updated_timestamp END AS last_updated_timestamp,
        CASE WHEN version = new_version THEN 'true' END AS tagged, p_brand AS brand
    FROM registry r LEFT JOIN (SELECT model_name, new_version FROM judged WHERE should_promote) USING (model_name)""",
    "champions", "metrics", more={"pair": _PAIR, "judged": _JUDGED}))
def promote_champion(d: Domain):
    """Every model whose newest version won."""
    winners = registry.should_promote(_pair(d)).filter("should_promote").selectExpr(
        "model_name", "new_version as version", "timestamp_ntz'2024-02-01 00:00:00' as ts")
    return registry.promote_champion(d.registry(), winners).selectExpr(
        "model_name", "version", "alias", "stage", "last_updated_timestamp", "tags['champion'] as tagged",
        "tags['brand'] as brand")


@plan("registry_commits", with_views(_COMMITTED, "champions", "metrics", more={
    "pair": _PAIR, "judged": _JUDGED, "registered": _REGISTERED}))
def registry_commits(d: Domain):
    """A promotion that another writer's registration overtakes: it is derived again, and both are in the last snapshot."""
    store = registry_store.RegistryStore(d.spark, scratch_dir(d.spark, "registry"))
    store.commit(lambda _: d.registry())
    winners = registry.should_promote(_pair(d)).filter("should_promote").selectExpr(
        "model_name", "new_version as version", "timestamp_ntz'2024-02-01 00:00:00' as ts")
    candidates = d.table("supplier").selectExpr(
        "concat('model_', s_suppkey) as model_name", "concat('candidate_', s_suppkey) as run_id",
        "map('model_type', 'random_forest') as params", "map('auc', cast(s_acctbal as string)) as metrics",
        "concat('models/', s_suppkey) as source_path", "timestamp_ntz'2024-02-01 00:00:00' as ts")

    def promote(rows):
        if store.latest() == 1:  # the other writer is quicker
            store.commit(lambda now: registry.register_version(now, candidates))
        return registry.promote_champion(rows, winners)

    number = store.commit(promote)
    return store.read().select("model_name", "version", "alias", "stage", F.lit(number).cast("long").alias("number"))


@plan("metrics_long_to_wide", with_views("""
    SELECT model_name || '/' || version AS model_name, accuracy, f1_score, auc_roc, 3 AS n FROM metrics""", "metrics"))
def metrics_long_to_wide(d: Domain):
    long = d.model_metrics().select(
        F.concat_ws("/", "model_name", "version").alias("model_name"),
        F.stack(F.lit(3), F.lit("accuracy"), "accuracy", F.lit("f1_score"), "f1_score",
                F.lit("auc_roc"), "auc_roc").alias("metric", "value"))
    wide = registry.metrics_long_to_wide(long, ("accuracy", "f1_score", "auc_roc"))
    return wide.withColumn("n", F.size("metrics")).drop("metrics")


# --- runs -----------------------------------------------------------------

_RUN_PARTS = ("perf", "quality", "clusters")
_JOINED = """SELECT o_orderkey AS run_id, p.run_id IS NOT NULL AS has_perf, q.run_id IS NOT NULL AS has_quality,
        throughput_efficiency, avg_processing_latency_ms, accuracy, model_drift_score, cluster_id,
        p.run_id IS NOT NULL AND p.error IS NULL AS streaming_completed,
        q.run_id IS NOT NULL AND q.error IS NULL AS model_evaluation_completed
    FROM orders o LEFT JOIN perf p ON p.run_id = o_orderkey LEFT JOIN quality q ON q.run_id = o_orderkey
    LEFT JOIN clusters c ON c.run_id = o_orderkey"""
_ADVICE = """concat_ws('|', CASE WHEN has_perf AND throughput_efficiency < 90
        THEN 'throughput_efficiency < 90' END,
    CASE WHEN has_quality AND accuracy < 0.85::DOUBLE THEN 'accuracy < 0.85' END,
    CASE WHEN has_perf AND avg_processing_latency_ms > 300 THEN 'avg_processing_latency_ms > 300' END)
    AS recommendations"""


def _parts(d: Domain):
    return d.runs().select("run_id"), d.run_performance(), d.run_quality(), d.clusters()


@plan("run_report_join", with_views("""SELECT run_id, throughput_efficiency, accuracy, cluster_id, streaming_completed,
    model_evaluation_completed FROM joined""", *_RUN_PARTS, more={"joined": _JOINED}))
def run_report_join(d: Domain):
    return reports.run_report_join(*_parts(d)).select(
        "run_id", "performance_metrics.throughput_efficiency", "model_quality_metrics.accuracy", "cluster_id",
        "streaming_completed", "model_evaluation_completed")


@plan("run_recommendations", with_views(f"SELECT run_id, {_ADVICE} FROM joined", *_RUN_PARTS,
                                        more={"joined": _JOINED}))
def run_recommendations(d: Domain):
    advice = reports.run_recommendations(reports.run_report_join(*_parts(d)))
    return advice.withColumn("recommendations", F.array_join("recommendations", "|"))


@plan("run_report", with_views(f"""SELECT run_id, 'completed' AS pipeline_status, avg_processing_latency_ms,
    model_drift_score, cluster_id, streaming_completed, model_evaluation_completed, {_ADVICE}, 2 AS steps
    FROM joined""", *_RUN_PARTS, more={"joined": _JOINED}))
def run_report(d: Domain):
    return reports.run_report(*_parts(d), next_steps=("watch the limits", "evaluate again")).select(
        "run_id", "pipeline_status", "performance_metrics.avg_processing_latency_ms",
        "model_quality_metrics.model_drift_score", "cluster_id", "streaming_completed",
        "model_evaluation_completed", F.array_join("recommendations", "|").alias("recommendations"),
        F.size("next_steps").alias("steps"))


@plan("training_report", """
    SELECT o_orderkey AS run_id, o_orderdate::DATE AS execution_date, 'completed' AS training_status,
        (o_orderkey * 13 % 20 - 10) / 100::DOUBLE > 0.02::DOUBLE AS model_promoted,
        (o_orderkey * 13 % 20 - 10) / 100::DOUBLE AS improvement_score,
        (o_orderdate::DATE + 1) AS next_training_scheduled FROM orders""")
def training_report(d: Domain):
    evaluated = d.table("orders").selectExpr(
        "o_orderkey as run_id", "(o_orderkey * 13 % 20 - 10) / 100D as improvement_score")
    promoted = evaluated.filter("improvement_score > 0.02D").select("run_id")
    return reports.training_report(d.runs(), evaluated, promoted)


@plan("model_health", with_views("""
    SELECT run_id, CASE WHEN bad THEN 'degraded' ELSE 'healthy' END AS model_status,
        CASE WHEN bad THEN 'retrain' ELSE 'continue_using' END AS recommendation, bad AS needs_retraining
    FROM (SELECT run_id, model_drift_score > 0.1::DOUBLE OR accuracy < 0.85::DOUBLE AS bad FROM quality)""", "quality"))
def model_health(d: Domain):
    return quality.model_health(d.run_quality())


# --- training -------------------------------------------------------------

_PREPARED = f"""SELECT transaction_id, label, TRY_CAST(amount AS DOUBLE) AS amount,
    CASE merchant_category WHEN 'grocery' THEN 0 WHEN 'gas_station' THEN 1 WHEN 'restaurant' THEN 2
        WHEN 'retail' THEN 3 WHEN 'online' THEN 4 WHEN 'electronics' THEN 5 WHEN 'pharmacy' THEN 6
        ELSE 7 END::DOUBLE AS merchant_category, hour_of_day::DOUBLE AS hour_of_day,
    day_of_week::DOUBLE AS day_of_week, COALESCE(user_age::DOUBLE, 35) AS user_age,
    COALESCE(location_risk_score::DOUBLE, 0.5::DOUBLE) AS location_risk_score, {_SPLIT} FROM checked WHERE errors = ''"""


@plan("prepare_training_data", with_views(_PREPARED, "checked"))
def prepare_training_data(d: Domain):
    return training.prepare_training_data(d.raw())


@plan("write_split_dataset", with_views(
    "SELECT split, count(*) AS n, sum(amount::DECIMAL(18,2))::DECIMAL(38,2) AS total FROM prepared GROUP BY split",
    "checked", more={"prepared": _PREPARED}))
def write_split_dataset(d: Domain):
    """Written, and read back by split."""
    path = scratch_dir(d.spark, "splits")
    sinks.write_split_dataset(training.prepare_training_data(d.raw()), path)
    return d.spark.read.parquet(path).groupBy("split").agg(
        F.count("*").alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))


def _split_sets(d: Domain):
    """The prepared rows as a written table: training reads it many times."""
    path = scratch_dir(d.spark, "training")
    sinks.write_split_dataset(training.prepare_training_data(d.raw()), path)
    rows = d.spark.read.parquet(path)
    return rows.filter("split = 'train'").drop("split"), rows.filter("split = 'test'").drop("split")


# SQL can't fit a forest. It says which rows are scored and what must hold of every answer; the labels
# follow the amount but for one row in 17, so a sound forest is far above the floors.
_FLOORS = {"accuracy": 0.85, "auc_roc": 0.8}


@plan("train_fraud_model", with_views("""SELECT count(*) AS n_test, true AS accuracy_ok, true AS auc_roc_ok, 0::BIGINT AS unscored
    FROM prepared WHERE split = 'test'""", "checked", more={"prepared": _PREPARED}))
def train_fraud_model(d: Domain):
    """A forest trained on the train split, evaluated on the test split against floors."""
    train, test = _split_sets(d)
    scored = scoring.score_batch_model(test, training.train_fraud_model(train, FOREST))
    n_test = scored.agg(F.count("*")).scalar()
    return quality.evaluate_model(scored, score="fraud_probability").select(
        n_test.alias("n_test"), *[(F.col(m) >= floor).alias(f"{m}_ok") for m, floor in _FLOORS.items()], "unscored")


_ANSWERS = """SELECT transaction_id, true AS probability_ok, true AS decision_ok FROM prepared WHERE split = 'test'"""


def _answers(scored):
    p = F.col("fraud_probability")
    return scored.select("transaction_id", p.between(0, 1).alias("probability_ok"),
                         (F.col("is_fraud") == (p > 0.5)).alias("decision_ok"))


@plan("score_batch_model", with_views(_ANSWERS, "checked", more={"prepared": _PREPARED}))
def score_batch_model(d: Domain):
    """Rows scored by a saved and loaded model."""
    train, test = _split_sets(d)
    path = scratch_dir(d.spark, "model")
    training.train_fraud_model(train, FOREST).write().save(path)
    return _answers(scoring.score_batch_model(test, path))


TRIALS = 50


def _auc_floor(rarer: int) -> float:
    """The floor of AUC on a split with so many rows of the rarer label: two standard errors below that of a large one."""
    floor = _FLOORS["auc_roc"]
    return floor - 2 * (floor * (1 - floor) / max(rarer, 1)) ** 0.5


def _is_best(model, trials) -> bool:
    """Whether the forest of ``model`` has the parameters of a trial with the best mean AUC."""
    forest = model.stages[-1]
    rows = trials.collect()  # a row per trial
    best = max(r["auc_roc"] for r in rows)
    own = [r["auc_roc"] for r in rows
           if all(forest.getOrDefault(name) == int(value) for name, value in (p.split("=") for p in r["params"].split(", ")))]
    return own == [best]


@plan("tune_model", f"SELECT i::INTEGER AS trial, true AS auc_roc_ok, true AS best_is_best FROM range({TRIALS}) t(i)")
def tune_model(d: Domain):
    """Cross-validated trials of a seeded random search; the best of them is saved and scores the test split."""
    train, test = _split_sets(d)
    best, trials = training.tune_model(train, folds=5, max_evals=TRIALS, parallelism=8)
    path = scratch_dir(d.spark, "best-model")
    best.write().save(path)
    saved = PipelineModel.load(path)
    held_out = quality.evaluate_model(scoring.score_batch_model(test, path), score="fraud_probability").select("auc_roc").scalar()
    rarer = min((r["count"] for r in test.groupBy("label").count().collect()), default=0)  # a row per label
    return trials.select("trial", F.col("auc_roc").between(0.5, 1).alias("auc_roc_ok"),
                         (F.lit(_is_best(saved, trials)) & (held_out >= _auc_floor(rarer))).alias("best_is_best"))
