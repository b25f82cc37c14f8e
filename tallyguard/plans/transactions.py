"""Plans over transactions: contract, features, scoring, statistics, generators."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from tallyguard.functions import hashing
from tallyguard.operators import quality, registry, scoring, training, validation
from tallyguard.plans.domain import Domain, with_views
from tallyguard.plans.registry import plan
from tallyguard.sources import generators

REQUIRED = ["transaction_id", "is_fraud", "fraud_probability"]
START = datetime(2024, 1, 1)


@plan("score_by_category", with_views("""
    SELECT f.merchant_category::INTEGER AS category, count(*) AS n,
           count(*) FILTER (WHERE f.amount > 500) AS frauds,
           100::DOUBLE * count(*) FILTER (WHERE f.amount > 500) / count(*) AS fraud_pct,
           count(*) FILTER (WHERE abs(CASE WHEN f.amount > 500 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END - 0.5::DOUBLE)
                                  > 0.3::DOUBLE) AS high_confidence,
           sum(f.amount::DECIMAL(18,2))::DECIMAL(38,2) AS total_amount
    FROM (SELECT TRY_CAST(amount AS DOUBLE) AS amount,
          CASE merchant_category WHEN 'grocery' THEN 0 WHEN 'gas_station' THEN 1 WHEN 'restaurant' THEN 2
             WHEN 'retail' THEN 3 WHEN 'online' THEN 4 WHEN 'electronics' THEN 5 WHEN 'pharmacy' THEN 6
             ELSE 7 END AS merchant_category FROM checked WHERE errors = '') f GROUP BY 1""", "checked"))
def score_by_category(d: Domain):
    """Flagship: validate, prepare, score, decide, band, and total by category."""
    valid, _ = validation.quarantine_split(d.raw())
    scored = scoring.confidence_band(scoring.decide_threshold(
        scoring.rule_score(scoring.prepare_features(valid))))
    frauds = F.count_if("is_fraud_predicted")
    return scored.groupBy(F.col("merchant_category").cast("int").alias("category")).agg(
        F.count("*").alias("n"), frauds.alias("frauds"), quality.percent(frauds, F.count("*")).alias("fraud_pct"),
        F.count_if(F.col("confidence") == "high").alias("high_confidence"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_amount"))


# --- contract -------------------------------------------------------------

@plan("validate_transactions", with_views(
    "SELECT event_id, errors = '' AS is_valid, errors FROM checked", "checked"))
def validate_transactions(d: Domain):
    judged = validation.validate_transactions(d.raw())
    return judged.select("event_id", "is_valid", F.array_join("errors", ",").alias("errors"))


@plan("quarantine_split", with_views("""
    SELECT event_id, 'valid' AS route, TRY_CAST(amount AS DOUBLE) AS amount FROM checked WHERE errors = ''
    UNION ALL SELECT event_id, 'quarantine', NULL FROM checked WHERE errors <> ''""", "checked"))
def quarantine_split(d: Domain):
    valid, invalid = validation.quarantine_split(d.raw())
    return valid.select("event_id", F.lit("valid").alias("route"), "amount").unionByName(
        invalid.select("event_id", F.lit("quarantine").alias("route"), F.lit(None).cast("double").alias("amount")))


@plan("data_quality_score", with_views("""
    SELECT count(*) FILTER (WHERE errors = '')::DOUBLE / count(*) AS score,
           count(*) FILTER (WHERE errors = '')::DOUBLE / count(*) >= 0.9::DOUBLE AS passed FROM checked""", "checked"))
def data_quality_score(d: Domain):
    return validation.data_quality_score(validation.validate_transactions(d.raw()))


@plan("batch_guard", with_views("""
    SELECT event_id, request_id, count(*) OVER (PARTITION BY request_id) AS batch_size,
           count(*) OVER (PARTITION BY request_id) <= 100 AS accepted FROM req""", "req"))
def batch_guard(d: Domain):
    return validation.batch_guard(d.requests()).select("event_id", "request_id", "batch_size", "accepted")


@plan("batch_response", with_views("""
    SELECT request_id, count(*) AS batch_size, max(total_ms) AS total_processing_time_ms,
           string_agg(transaction_id, ',' ORDER BY transaction_id) AS ids,
           count(*) FILTER (WHERE amount > 500) AS frauds
    FROM req GROUP BY request_id HAVING count(*) <= 100""", "req"))
def batch_response(d: Domain):
    scored = scoring.confidence_band(scoring.decide_threshold(scoring.rule_score(d.requests())), "batch")
    answers = scoring.batch_response(validation.batch_guard(scored))
    return answers.select(
        "request_id", "batch_size", "total_processing_time_ms",
        F.array_join("predictions.transaction_id", ",").alias("ids"),
        F.size(F.filter("predictions.is_fraud_predicted", lambda x: x)).cast("long").alias("frauds"))


@plan("amortized_latency", with_views("""
    SELECT event_id, request_id, round(total_ms / count(*) OVER (PARTITION BY request_id), 2) AS processing_time_ms
    FROM req""", "req"))
def amortized_latency(d: Domain):
    return scoring.amortized_latency(d.requests()).select("event_id", "request_id", "processing_time_ms")


@plan("payload_screen", """
    SELECT page_id, concat_ws(',',
        CASE WHEN regexp_matches(html, '(?i)[''"][^''"]*;?\\s*--') THEN 'sql_comment' END,
        CASE WHEN regexp_matches(html, '(?i)[''"]\\s*or\\s+[''"]?\\w+[''"]?\\s*=\\s*[''"]?\\w+') THEN 'sql_tautology' END,
        CASE WHEN regexp_matches(html, '(?i);\\s*(drop|delete|insert|update|alter)\\s') THEN 'sql_statement' END,
        CASE WHEN regexp_matches(html, '(?i)<\\s*script') THEN 'script_tag' END,
        CASE WHEN regexp_matches(html, '(?i)javascript\\s*:') THEN 'script_url' END,
        CASE WHEN regexp_matches(html, '(?i)<[^>]*\\son[a-z]+\\s*=') THEN 'event_handler' END,
        CASE WHEN length(html) > 1000 THEN 'oversized' END) AS reasons FROM pages""")
def payload_screen(d: Domain):
    """Whole page texts, as hostile values of a string field."""
    screened = validation.payload_screen(d.table("pages"), ["html"])
    return screened.select("page_id", F.array_join("reasons", ",").alias("reasons"))


_HOSTILE = """SELECT event_id, CASE k % 5 WHEN 0 THEN 400 WHEN 1 THEN 422 WHEN 2 THEN 413 WHEN 3 THEN 200 ELSE 500 END
    AS status_code, CASE event_id % 3 WHEN 0 THEN 'sql' WHEN 1 THEN 'script' ELSE 'oversized' END AS kind,
    CASE WHEN k % 25 = 4 THEN 'timeout' END AS error FROM ev"""
_SAFE = """SELECT event_id, error IS NOT NULL OR status_code IN (400, 422)
    OR (kind = 'oversized' AND status_code = 413) AS safe FROM hostile"""


def _hostile(d: Domain):
    return d.events().selectExpr(
        "event_id", "case k % 5 when 0 then 400 when 1 then 422 when 2 then 413 when 3 then 200 else 500 end "
        "as status_code", "case event_id % 3 when 0 then 'sql' when 1 then 'script' else 'oversized' end as kind",
        "case when k % 25 = 4 then 'timeout' end as error")


@plan("safe_response", with_views(_SAFE, "ev", more={"hostile": _HOSTILE}))
def safe_response(d: Domain):
    return validation.safe_response(_hostile(d)).select("event_id", "safe")


@plan("security_score", with_views("""
    SELECT count(*) FILTER (WHERE safe) AS safe, count(*) AS total,
           100::DOUBLE * count(*) FILTER (WHERE safe) / count(*) AS score FROM judged""", "ev",
                                   more={"hostile": _HOSTILE, "judged": _SAFE}))
def security_score(d: Domain):
    from tallyguard.operators import reports
    return reports.security_score(validation.safe_response(_hostile(d)))


@plan("required_fields_check", with_views("""
    SELECT event_id, concat_ws(',', CASE WHEN k % 7 = 0 THEN 'is_fraud' END,
        CASE WHEN k % 11 = 0 THEN 'fraud_probability' END) AS missing FROM ev""", "ev"))
def required_fields_check(d: Domain):
    """Response maps that lack a field now and then."""
    responses = d.events().selectExpr("event_id", """map_concat(map('transaction_id', cast(event_id as string)),
        case when k % 7 = 0 then cast(map() as map<string,string>) else map('is_fraud', 'false') end,
        case when k % 11 = 0 then cast(map() as map<string,string>) else map('fraud_probability', '0.2') end)
        as response""")
    checked = validation.required_fields_check(responses, "response", REQUIRED)
    return checked.select("event_id", F.array_join("missing", ",").alias("missing"))


@plan("parse_event_time", with_views("""
    SELECT event_id, CASE WHEN event_id % 40 = 0 THEN NULL WHEN event_id % 3 = 0 THEN date_trunc('day', ts)
        ELSE ts END::TIMESTAMP AS event_time, CASE WHEN event_id % 40 = 0 THEN NULL ELSE ts::DATE END AS event_date
    FROM ev""", "ev"))
def parse_event_time(d: Domain):
    """ISO times, plain dates and unreadable text in one column."""
    rows = d.events().selectExpr("event_id", """case when event_id % 40 = 0 then 'not a time'
        when event_id % 3 = 0 then date_format(ts, 'yyyy-MM-dd')
        else date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") end as timestamp""")
    return validation.parse_event_time(rows).select(
        "event_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "event_date")


# --- features and scores --------------------------------------------------

@plan("fill_defaults", with_views("""SELECT transaction_id, COALESCE(user_age, 35) AS user_age,
    COALESCE(location_risk_score, 0.5::DOUBLE) AS location_risk_score FROM tx""", "tx"))
def fill_defaults(d: Domain):
    return scoring.fill_defaults(d.transactions()).select("transaction_id", "user_age", "location_risk_score")


@plan("encode_category", with_views("SELECT transaction_id, merchant_category::INTEGER AS merchant_category FROM feat",
                                    "feat"))
def encode_category(d: Domain):
    return scoring.encode_category(d.transactions()).select("transaction_id", "merchant_category")


@plan("feature_projection", with_views("SELECT * EXCLUDE (label) FROM feat", "feat"))
def feature_projection(d: Domain):
    return scoring.prepare_features(d.transactions())


@plan("time_features", with_views("SELECT transaction_id, hour_of_day, day_of_week FROM tx", "tx"))
def time_features(d: Domain):
    rows = d.transactions().drop("hour_of_day", "day_of_week")
    return scoring.time_features(rows).select("transaction_id", "hour_of_day", "day_of_week")


@plan("amount_uplift", with_views("SELECT transaction_id, amount * 1.1::DOUBLE AS processed FROM tx", "tx"))
def amount_uplift(d: Domain):
    return scoring.amount_uplift(d.transactions()).select("transaction_id", "processed")


@plan("filter_fraud", with_views("SELECT transaction_id, amount, is_fraud FROM tx WHERE is_fraud = 1", "tx"))
def filter_fraud(d: Domain):
    return scoring.filter_fraud(d.transactions()).select("transaction_id", "amount", "is_fraud")


@plan("rule_score", with_views("SELECT transaction_id, fraud_probability FROM pred", "pred"))
def rule_score(d: Domain):
    return scoring.rule_score(d.transactions()).select("transaction_id", "fraud_probability")


@plan("decide_threshold", with_views("SELECT transaction_id, score > 0.7::DOUBLE AS is_fraud_predicted FROM tx", "tx"))
def decide_threshold(d: Domain):
    rows = d.transactions().withColumnRenamed("score", "fraud_probability")
    return scoring.decide_threshold(rows, 0.7).select("transaction_id", "is_fraud_predicted")


def _fallback(mode: str, sql: str):
    @plan("proba_fallback" if mode == "single" else f"proba_fallback_{mode}", with_views(
        f"SELECT event_id, {sql} AS fraud_probability, k % 4 <> 0 AS is_fraud FROM ev", "ev"))
    def fallback(d: Domain):
        rows = d.events().withColumn("label", F.col("k") % 4)
        return scoring.proba_fallback(rows, mode).select("event_id", "fraud_probability", "is_fraud")


_fallback("single", "CASE WHEN k % 4 IN (0, 1) THEN (k % 4)::DOUBLE ELSE 0.5::DOUBLE END")
_fallback("batch", "(k % 4)::DOUBLE")

_DISTANCE = "abs(k / 100::DOUBLE - 0.5::DOUBLE)"


def _band(mode: str, sql: str):
    @plan("confidence_band" if mode == "single" else f"confidence_band_{mode}", with_views(
        f"SELECT event_id, CASE {sql} WHEN {_DISTANCE} > 0.3::DOUBLE THEN 'high' ELSE 'medium' END AS confidence "
        "FROM ev", "ev"))
    def band(d: Domain):
        rows = d.events().withColumn("fraud_probability", F.expr("k / 100D"))
        return scoring.confidence_band(rows, mode).select("event_id", "confidence")


_band("single", f"WHEN {_DISTANCE} > 0.4::DOUBLE THEN 'very_high'")
_band("batch", "")


RESPONSE = """SELECT transaction_id, CASE WHEN amount > 500 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END AS fraud_probability,
        amount > 500 AS is_fraud_predicted,
        CASE WHEN abs(CASE WHEN amount > 500 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END - 0.5::DOUBLE) > 0.4::DOUBLE THEN 'very_high'
             WHEN abs(CASE WHEN amount > 500 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END - 0.5::DOUBLE) > 0.3::DOUBLE THEN 'high'
             ELSE 'medium' END AS confidence, 'model_3' AS model_name,
        (SELECT version FROM champions WHERE model_name = 'model_3') AS model_version,
        round(total_ms / count(*) OVER (PARTITION BY request_id), 2) AS processing_time_ms FROM req"""


def responses(d: Domain):
    """The answers of all requests, a row for each transaction."""
    champions = registry.resolve_champion(d.registry())
    timed = scoring.amortized_latency(scoring.decide_threshold(scoring.rule_score(d.requests())))
    return scoring.prediction_response(scoring.confidence_band(timed), champions, "model_3")


@plan("prediction_response", with_views(RESPONSE, "req", "champions"))
def prediction_response(d: Domain):
    return responses(d).select("transaction_id", "fraud_probability", "is_fraud_predicted", "confidence",
                               "model_name", "model_version", "processing_time_ms")


class LinearModel:
    """A stand-in for any fitted Python model."""

    def probability(self, x: pd.DataFrame):
        return (x["amount"] / 5000.0 + x["location_risk_score"] * 0.5).clip(upper=1.0)

    def predict(self, x: pd.DataFrame):
        return (self.probability(x) > 0.5).astype(int)

    def predict_proba(self, x: pd.DataFrame):
        p = self.probability(x)
        return pd.concat([1.0 - p, p], axis=1).to_numpy()


@plan("score_python_model", with_views("""
    SELECT transaction_id, p > 0.5::DOUBLE AS is_fraud, p AS fraud_probability FROM (SELECT transaction_id,
        least(1::DOUBLE, amount / 5000::DOUBLE + location_risk_score * 0.5::DOUBLE) AS p FROM feat)""", "feat"))
def score_python_model(d: Domain):
    scored = scoring.score_python_model(scoring.prepare_features(d.transactions()), LinearModel)
    return scored.select("transaction_id", "is_fraud", "fraud_probability")


# --- statistics -----------------------------------------------------------

@plan("fraud_rate", with_views("""SELECT count(*) AS total, sum(is_fraud)::BIGINT AS fraud,
    100::DOUBLE * sum(is_fraud)::BIGINT / count(*) AS fraud_rate_pct FROM tx""", "tx"))
def fraud_rate(d: Domain):
    return quality.fraud_rate(d.transactions())


_USERS = """SELECT user_id, count(*) AS transaction_count, sum(amount::DECIMAL(18,2))::DECIMAL(28,2) AS total_amount,
    sum(is_fraud)::BIGINT AS fraud_count FROM tx GROUP BY user_id"""


@plan("user_stats", with_views(_USERS, "tx"))
def user_stats(d: Domain):
    return quality.user_stats(d.transactions())


@plan("top_users", with_views(f"{_USERS} ORDER BY transaction_count DESC, user_id LIMIT 5", "tx"))
def top_users(d: Domain):
    return quality.top_users(quality.user_stats(d.transactions()))


@plan("describe_amount", with_views("""SELECT count(amount) AS count, round(avg(amount), 6) AS mean,
    round(stddev_samp(amount), 6) AS stddev, min(amount) AS min, max(amount) AS max FROM tx""", "tx"))
def describe_amount(d: Domain):
    return quality.describe_amount(d.transactions()).withColumns({
        c: F.round(c, 6) for c in ("mean", "stddev")})


@plan("throughput", with_views("""SELECT count(*) AS processed,
    (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000::DOUBLE AS elapsed_s,
    count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000::DOUBLE) AS rate FROM tx""", "tx"))
def throughput(d: Domain):
    return quality.throughput(d.transactions())


@plan("fraud_detection_rate", with_views(
    "SELECT count(*) FILTER (WHERE is_fraud_predicted)::DOUBLE / count(*) AS rate FROM pred", "pred"))
def fraud_detection_rate(d: Domain):
    return quality.fraud_detection_rate(d.predictions())


@plan("stream_performance", with_views("""
    SELECT count(*) AS total_transactions_processed, count(*) FILTER (WHERE k % 50 <> 0) AS total_predictions_made,
        count(*) FILTER (WHERE k % 50 <> 0 AND value * 5 > 500) AS fraud_detected_count,
        round(avg(value), 6) AS avg_processing_latency_ms, max(value) AS max_processing_latency_ms,
        0.01::DOUBLE AS target_tps, count(*) / s AS actual_avg_tps,
        100::DOUBLE * count(*) FILTER (WHERE k % 50 = 0) / count(*) AS error_rate_percent,
        100::DOUBLE * (count(*) / s) / 0.01::DOUBLE AS throughput_efficiency
        , min(ts) AS streaming_start_time, s AS streaming_duration_seconds,
        count(*) FILTER (WHERE k % 50 <> 0 AND (value * 5 > 500) = ((value * 5 > 500) <> (event_id % 17 = 0)))
            / (count(*) FILTER (WHERE k % 50 <> 0))::DOUBLE AS model_accuracy_estimate,
        round(avg(k), 6) AS cpu, round(avg(value / 5), 6) AS memory, round(avg(k / 4::DOUBLE), 6) AS disk
    FROM ev, (SELECT (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000::DOUBLE AS s FROM ev) GROUP BY s""", "ev"))
def stream_performance(d: Domain):
    rows = d.events().selectExpr("ts", "value as latency_ms", "value * 5 > 500D as is_fraud",
                                 "(value * 5 > 500D) <> (event_id % 17 = 0) as label",
                                 "case when k % 50 = 0 then 'failed' end as error")
    used = d.events().selectExpr("k as cpu_percent", "value / 5 as memory_percent", "k / 4D as disk_io_mbps")
    out = quality.stream_performance(rows, 0.01, used).withColumn(
        "avg_processing_latency_ms", F.round("avg_processing_latency_ms", 6))
    parts = {"cpu": "cpu_avg_percent", "memory": "memory_avg_percent", "disk": "disk_io_avg_mbps"}
    return out.withColumns({n: F.round(f"resource_utilization.{c}", 6) for n, c in parts.items()}).drop("resource_utilization")


@plan("preview_predictions", with_views("""SELECT transaction_id, amount, fraud_probability, is_fraud_predicted
    FROM pred ORDER BY transaction_id LIMIT 10""", "pred"))
def preview_predictions(d: Domain):
    return scoring.preview_predictions(d.predictions())


_LABELLED = "SELECT transaction_id, label, is_fraud_predicted AS prediction, score FROM pred"


def _labelled(d: Domain):
    labels = d.transactions().select("transaction_id", "label", "score")
    predictions = d.predictions().select("transaction_id", F.col("is_fraud_predicted").alias("prediction"))
    return quality.prediction_label_join(predictions, labels)


@plan("prediction_label_join", with_views(_LABELLED, "pred"))
def prediction_label_join(d: Domain):
    return _labelled(d)


@plan("unscored_transactions", with_views("SELECT transaction_id, amount FROM tx WHERE amount <= 500", "tx"))
def unscored_transactions(d: Domain):
    """Only the large amounts have been predicted so far."""
    done = d.predictions().filter("is_fraud_predicted")
    return quality.unscored_transactions(d.transactions().select("transaction_id", "amount"), done)


_CONFUSION = """SELECT count(*) FILTER (WHERE label AND prediction) AS tp,
    count(*) FILTER (WHERE NOT label AND prediction) AS fp, count(*) FILTER (WHERE NOT label AND NOT prediction) AS tn,
    count(*) FILTER (WHERE label AND NOT prediction) AS fn FROM labelled"""
_MEASURES = """(tp + tn)::DOUBLE / (tp + fp + tn + fn) AS accuracy, tp::DOUBLE / (tp + fp) AS precision,
    tp::DOUBLE / (tp + fn) AS recall, (2 * tp)::DOUBLE / (2 * tp + fp + fn) AS f1_score"""
_AUC = """SELECT sum(p.n * (2 * COALESCE(b.below, 0) + p.ties))::DOUBLE
        / (2::DOUBLE * (SELECT count(*) FROM labelled WHERE label) * (SELECT count(*) FROM labelled WHERE NOT label))
        AS auc_roc
    FROM (SELECT score, count(*) FILTER (WHERE label)::HUGEINT AS n, count(*) FILTER (WHERE NOT label) AS ties
          FROM labelled GROUP BY score) p
    JOIN (SELECT score, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
          FROM (SELECT score, count(*) FILTER (WHERE NOT label) AS neg FROM labelled GROUP BY score)) b
    USING (score)"""


@plan("classification_metrics", with_views(f"SELECT *, {_MEASURES} FROM confusion", "pred",
                                           more={"labelled": _LABELLED, "confusion": _CONFUSION}))
def classification_metrics(d: Domain):
    return quality.classification_metrics(_labelled(d))


@plan("false_positive_rate", with_views("SELECT fp::DOUBLE / (fp + tn) AS fpr FROM confusion", "pred",
                                        more={"labelled": _LABELLED, "confusion": _CONFUSION}))
def false_positive_rate(d: Domain):
    return quality.false_positive_rate(_labelled(d))


@plan("auc_roc", with_views(_AUC, "pred", more={"labelled": _LABELLED}))
def auc_roc(d: Domain):
    return quality.auc_roc(_labelled(d))


@plan("evaluate_model", with_views(f"SELECT {_MEASURES}, (SELECT auc_roc FROM auc) AS auc_roc, 0::BIGINT AS unscored FROM confusion", "tx",
                                   more={"labelled": "SELECT label, score > 0.5::DOUBLE AS prediction, score FROM tx",
                                         "confusion": _CONFUSION, "auc": _AUC}))
def evaluate_model(d: Domain):
    return quality.evaluate_model(d.transactions())


_BOUNDS = [50.0, 100.0, 200.0, 400.0, 800.0, 1600.0]
_SLOT = "CASE " + " ".join(f"WHEN amount < {b} THEN {i}" for i, b in enumerate(_BOUNDS)) + f" ELSE {len(_BOUNDS)} END"


@plan("drift_score", with_views("""
    SELECT 'amount' AS feature, round(sum((q - p) * ln(q / p)), 9) AS psi, sum((q - p) * ln(q / p)) > 0.1 AS drifted
    FROM (SELECT greatest(COALESCE(p, 0), 0.0001::DOUBLE) AS p, greatest(COALESCE(q, 0), 0.0001::DOUBLE) AS q FROM
    (SELECT bin, n / (sum(n) OVER ())::DOUBLE AS p FROM slots WHERE base) FULL JOIN
    (SELECT bin, n / (sum(n) OVER ())::DOUBLE AS q FROM slots WHERE NOT base) USING (bin))""", "tx",
    more={"slots": f"SELECT hour_of_day < 12 AS base, {_SLOT} AS bin, count(*) AS n FROM tx GROUP BY ALL"}))
def drift_score(d: Domain):
    """Morning amounts against those of the rest of the day."""
    rows = d.transactions()
    scored = quality.drift_score(rows.filter("hour_of_day < 12"), rows.filter("hour_of_day >= 12"), "amount", _BOUNDS)
    return scored.withColumn("psi", F.round("psi", 9))


_LEARNT = {
    "long": """SELECT * FROM (SELECT 'model_' || (event_id % 3) AS model, hour_of_day < 12 AS base,
        unnest(['amount', 'user_age', 'location_risk_score']) AS feature, unnest([amount, user_age, location_risk_score]) AS value
        FROM tx) WHERE value IS NOT NULL""",
    "edges": """SELECT DISTINCT model, feature, value AS edge FROM (SELECT *, count(*) OVER (PARTITION BY model, feature) AS n,
        row_number() OVER (PARTITION BY model, feature ORDER BY value) - 1 AS i FROM long WHERE base), range(1, 10) r(k)
        WHERE i = n * k // 10""",
    "slots": """SELECT model, feature, bin, count(*) FILTER (WHERE base) AS p, count(*) FILTER (WHERE NOT base) AS q
        FROM (SELECT l.*, (SELECT count(*) FROM edges e WHERE e.model = l.model AND e.feature = l.feature AND e.edge <= l.value) AS bin
              FROM long l) GROUP BY ALL""",
    "shares": """SELECT model, feature, greatest(p / sum(p) OVER w::DOUBLE, 0.0001::DOUBLE) AS p,
        greatest(q / sum(q) OVER w::DOUBLE, 0.0001::DOUBLE) AS q FROM slots WINDOW w AS (PARTITION BY model, feature)""",
}


@plan("drift_learnt_bins", with_views("""
    SELECT model, feature, round(sum((q - p) * ln(q / p)), 9) AS psi, sum((q - p) * ln(q / p)) > 0.1 AS drifted
    FROM shares GROUP BY model, feature""", "tx", more=_LEARNT))
def drift_learnt_bins(d: Domain):
    """Morning values against those of the rest of the day, per model and feature, over the morning's deciles."""
    return _learnt_drift(d).withColumn("psi", F.round("psi", 9))


def _learnt_drift(d: Domain):
    features, keys = ("amount", "user_age", "location_risk_score"), ("model",)
    rows = d.transactions().withColumn("model", F.expr("concat('model_', event_id % 3)"))
    base = rows.filter("hour_of_day < 12")
    bins = quality.learn_bins(base, features, 10, keys)
    return quality.drift_on_bins(bins, base, rows.filter("hour_of_day >= 12"), features, keys=keys)


@plan("freshness_check", with_views("""
    SELECT TIMESTAMP '2024-01-20 00:00:00' AS last_training_date,
        count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-20 00:00:00') AS new_records_available,
        count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-20 00:00:00') >= 3000 AS should_retrain,
        (SELECT count(*) FILTER (WHERE errors = '') / count(*)::DOUBLE FROM checked) AS data_quality_score,
        (SELECT bool_or(d) FROM (SELECT sum((q - p) * ln(q / p)) > 0.1 AS d FROM shares GROUP BY model, feature)) AS data_drift_detected
    FROM tx""", "checked", more=_LEARNT))
def freshness_check(d: Domain):
    score = validation.data_quality_score(validation.validate_transactions(d.raw()))
    checked = quality.freshness_check(d.transactions(), datetime(2024, 1, 20), datetime(2024, 1, 31), min_records=3000,
                                      quality=score, drift=_learnt_drift(d))
    return checked.withColumn("last_training_date", F.col("last_training_date").cast("timestamp_ntz"))


# --- splits and generators ------------------------------------------------

_CELL = "('0x' || substr(md5(transaction_id), 1, 8))::BIGINT % 10000"
_SPLIT = f"""CASE WHEN {_CELL} < 2000 THEN 'validation' WHEN {_CELL} < 3000 THEN 'test' ELSE 'train' END AS split"""


@plan("train_val_test_split", with_views(f"SELECT transaction_id, {_SPLIT} FROM tx", "tx"))
def train_val_test_split(d: Domain):
    return training.train_val_test_split(d.transactions()).select("transaction_id", "split")


def _draw_sql(salt: int) -> str:
    m = hashing.PRIME
    seed = f"((event_id % {m}) * 16807 + (event_id // {m}) * 69621 + {salt * 1000003}) % {m}"
    once = f"(({seed}) * ({seed}) + {12345 + salt}) % {m}"
    mixed = f"(({once}) * 48271 + ({seed})) % {m}"
    return f"((({mixed}) * ({mixed}) + {salt}) % {m})"


def _int_sql(salt: int, low: int, high: int) -> str:
    return f"({low} + {_draw_sql(salt)} % {high - low + 1})"


def _scaled_sql(salt: int, low: float, high: float, digits: int) -> str:
    unit = 10 ** digits
    first, last = round(low * unit), round(high * unit)
    return f"(({first} + {_draw_sql(salt)} % {last - first + 1})::DOUBLE / {unit}::DOUBLE)"


def _pick_sql(salt: int, values: list) -> str:
    return f"({values})[{_int_sql(salt, 1, len(values))}]"


@plan("gen_transactions", with_views(f"""
    SELECT event_id, 'tx_' || lpad(event_id::VARCHAR, greatest(6, length(event_id::VARCHAR))::INTEGER, '0') AS transaction_id,
        {_scaled_sql(42, 10, 1000, 2)} AS amount, 'm_' || {_int_sql(43, 100, 999)} AS merchant_id,
        'u_' || {_int_sql(44, 1000, 9999)} AS user_id,
        TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 SECOND * (event_id // 20) AS timestamp,
        CASE WHEN {_draw_sql(45)}::DOUBLE / {hashing.PRIME}::DOUBLE < 0.1::DOUBLE THEN {_int_sql(46, 0, 1)} ELSE 0 END
        AS is_fraud FROM ev""", "ev"))
def gen_transactions(d: Domain):
    """One producer message per event."""
    columns = generators.message_columns(F.col("event_id"), 20, START)
    rows = d.events().select("event_id", *[c.alias(n) for n, c in columns.items()])
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


_RISKY = f"{_draw_sql(42)}::DOUBLE / {hashing.PRIME}::DOUBLE < 0.1::DOUBLE"


@plan("gen_stress_mix", with_views(f"""
    SELECT event_id, 'stress_test_' || event_id AS transaction_id, {_RISKY} AS is_risky,
        CASE WHEN {_RISKY} THEN {_scaled_sql(43, 500, 5000, 2)} ELSE {_scaled_sql(43, 5, 500, 2)} END AS amount,
        {_pick_sql(44, generators.STRESS_CATEGORIES)} AS merchant_category,
        CASE WHEN {_RISKY} THEN {_pick_sql(45, generators.NIGHT_HOURS)} ELSE {_int_sql(45, 8, 22)} END AS hour_of_day,
        {_int_sql(46, 0, 6)} AS day_of_week, {_int_sql(47, 18, 80)} AS user_age,
        CASE WHEN {_RISKY} THEN {_scaled_sql(48, 0.7, 1.0, 3)} ELSE {_scaled_sql(48, 0.0, 0.3, 3)} END
        AS location_risk_score FROM ev""", "ev"))
def gen_stress_mix(d: Domain):
    columns = generators.stress_columns(F.col("event_id"))
    return d.events().select("event_id", *[c.alias(n) for n, c in columns.items()])


@plan("gen_uniform_pool", with_views(f"""
    SELECT event_id, 'load_test_' || event_id AS transaction_id, {_scaled_sql(43, 1, 2000, 2)} AS amount,
        {_pick_sql(44, generators.POOL_CATEGORIES)} AS merchant_category, {_int_sql(45, 0, 23)} AS hour_of_day,
        {_int_sql(46, 0, 6)} AS day_of_week, {_int_sql(47, 18, 80)} AS user_age,
        {_scaled_sql(48, 0.0, 1.0, 3)} AS location_risk_score, false AS is_risky FROM ev""", "ev"))
def gen_uniform_pool(d: Domain):
    columns = generators.uniform_columns(F.col("event_id"))
    return d.events().select("event_id", *[c.alias(n) for n, c in columns.items()])
