"""Statistics of transactions, predictions and labels."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.functions import intervals
from tallyguard.operators import ranked

DRIFT_LIMIT = 0.1          # fixed value: retrain above this drift
ACCURACY_FLOOR = 0.85      # fixed value: retrain below this accuracy
MIN_NEW_RECORDS = 10_000   # fixed value
RETRAIN_PERIOD = timedelta(days=7)  # fixed value
PSI_EPSILON = 1e-4


def percent(part: Column, whole: Column) -> Column:
    """100 * part / max(whole, 1)."""
    return F.lit(100.0) * part / F.greatest(whole, F.lit(1))


# --- transactions ---------------------------------------------------------

def fraud_rate(df: DataFrame) -> DataFrame:
    """Total, fraud and rate in one pass."""
    return (df.agg(F.count("*").alias("total"),
                   F.coalesce(F.sum(F.col("is_fraud").cast("long")), F.lit(0)).alias("fraud"))
            .withColumn("fraud_rate_pct", percent(F.col("fraud"), F.col("total"))))


def user_stats(df: DataFrame, money: str = "decimal(18,2)") -> DataFrame:
    """Count, exact amount total and fraud count per user."""
    return df.groupBy("user_id").agg(
        F.count("*").alias("transaction_count"),
        F.sum(F.col("amount").cast(money)).alias("total_amount"),
        F.sum(F.col("is_fraud").cast("long")).alias("fraud_count"))


def top_users(stats: DataFrame, n: int = 5) -> DataFrame:
    return stats.orderBy(F.desc("transaction_count"), F.asc("user_id")).limit(n)


def describe_amount(df: DataFrame, col: str = "amount") -> DataFrame:
    c = F.col(col)
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"),
                  F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"), F.max(c).alias("max"))


def throughput(df: DataFrame, col: str = "ts") -> DataFrame:
    spans = df.agg(F.count("*").alias("processed"), F.min(col).alias("_a"), F.max(col).alias("_b"))
    return spans.select(
        "processed", intervals.seconds_between(F.col("_a"), F.col("_b")).alias("elapsed_s"),
    ).withColumn("rate", F.try_divide(F.col("processed"), F.col("elapsed_s")))


def stream_performance(df: DataFrame, target_tps: float, resources: DataFrame | None = None, label: str = "label") -> DataFrame:
    """Run performance from rows of (ts, latency_ms, is_fraud, error, perhaps a label); failed rows predict nothing.

    The accuracy is that of the predictions whose label is known, null without any. ``resources`` are samples of
    (cpu_percent, memory_percent, disk_io_mbps) of the run; their means are one field, null without samples.
    """
    failed = F.col("error").isNotNull()
    known = ~failed & F.col(label).isNotNull() if label in df.columns else F.lit(False)
    right = known & (F.col("is_fraud") == F.col(label)) if label in df.columns else known
    agg = df.agg(
        F.min("ts").alias("streaming_start_time"),
        intervals.seconds_between(F.min("ts"), F.max("ts")).alias("streaming_duration_seconds"),
        F.count("*").alias("total_transactions_processed"),
        F.count_if(~failed).alias("total_predictions_made"),
        F.count_if(F.col("is_fraud") & ~failed).alias("fraud_detected_count"),
        F.avg("latency_ms").alias("avg_processing_latency_ms"),
        F.max("latency_ms").alias("max_processing_latency_ms"),
        F.try_divide(F.count_if(right), F.count_if(known)).alias("model_accuracy_estimate"))
    done = F.col("total_transactions_processed")
    used = F.lit(None).cast("struct<cpu_avg_percent:double,memory_avg_percent:double,disk_io_avg_mbps:double>")
    if resources is not None:
        used = resources.agg(F.when(F.count(F.lit(1)) > 0, F.struct(
            F.avg("cpu_percent").alias("cpu_avg_percent"), F.avg("memory_percent").alias("memory_avg_percent"),
            F.avg("disk_io_mbps").alias("disk_io_avg_mbps")))).scalar()
    return (agg.withColumn("target_tps", F.lit(float(target_tps)))
            .withColumn("actual_avg_tps", F.try_divide(done, F.col("streaming_duration_seconds")))
            .withColumn("error_rate_percent", percent(done - F.col("total_predictions_made"), done))
            .withColumn("throughput_efficiency",
                        F.lit(100.0) * F.col("actual_avg_tps") / F.col("target_tps"))
            .withColumn("resource_utilization", used))


def fraud_detection_rate(df: DataFrame, col: str = "is_fraud_predicted") -> DataFrame:
    return df.agg((F.count_if(col).cast("double")
                   / F.greatest(F.count("*"), F.lit(1))).alias("rate"))


# --- predictions against labels -------------------------------------------

def prediction_label_join(pred: DataFrame, labels: DataFrame, key: str = "transaction_id") -> DataFrame:
    return pred.join(labels, key)


def unscored_transactions(txn: DataFrame, pred: DataFrame, key: str = "transaction_id") -> DataFrame:
    return txn.join(pred.select(key), key, "left_anti")


def _confusion(label: str, prediction: str) -> list[Column]:
    actual, said = F.col(label).cast("boolean"), F.col(prediction).cast("boolean")
    return [F.count_if(actual & said).alias("tp"), F.count_if(~actual & said).alias("fp"),
            F.count_if(~actual & ~said).alias("tn"), F.count_if(actual & ~said).alias("fn")]


def _measures() -> dict[str, Column]:
    """Measures of confusion counts; one without a base is null."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return {"accuracy": F.try_divide(tp + tn, tp + fp + tn + fn), "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn), "f1_score": F.try_divide(2 * tp, 2 * tp + fp + fn)}


def classification_metrics(df: DataFrame, label: str = "label",
                           prediction: str = "prediction", keys: tuple[str, ...] = ()) -> DataFrame:
    """Confusion counts and the measures from them."""
    return df.groupBy(*keys).agg(*_confusion(label, prediction)).withColumns(_measures())


def false_positive_rate(df: DataFrame, label: str = "label", prediction: str = "prediction",
                        keys: tuple[str, ...] = ()) -> DataFrame:
    return (df.groupBy(*keys).agg(*_confusion(label, prediction))
            .select(*keys, F.try_divide(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr")))


def _by_score(df: DataFrame, label: str, score: str, keys: tuple[str, ...]) -> DataFrame:
    """Positives and negatives per distinct score, with the negatives below it and the totals.

    Rows without a score or a label are counted as ``lost``, in a row of their own without a score.
    """
    value, truth = F.col(score).cast("double"), F.col(label).cast("boolean")
    usable = value.isNotNull() & ~F.isnan(value) & truth.isNotNull()
    dist = (df.groupBy(*keys, F.when(usable, value).alias("_score"))
            .agg(F.count_if(usable & truth).alias("pos"), F.count_if(usable & ~truth).alias("neg"),
                 F.count_if(~usable).alias("lost")))
    return ranked.with_totals_below(dist, list(keys), "_score", ["pos", "neg"], ranked.double_bits(F.col("_score")))


def _auc() -> Column:
    """Area from the rows of ``_by_score``; integers, so no order of summing changes it."""
    twice = F.col("pos").cast("decimal(18,0)") * (2 * F.col("neg_below") + F.col("neg")).cast("decimal(19,0)")
    base = F.lit(2.0) * F.max("pos_total").cast("double") * F.max("neg_total").cast("double")
    return F.try_divide(F.sum(twice.cast("decimal(38,0)")).cast("double"), base)


def auc_roc(df: DataFrame, label: str = "label", score: str = "score", keys: tuple[str, ...] = ()) -> DataFrame:
    """Area under the ROC curve per key group, ties counted half, over the rows with a score and a label.

    Rows collapse to one per distinct score before anything is ordered.
    """
    return _by_score(df, label, score, keys).groupBy(*keys).agg(_auc().alias("auc_roc"))


def evaluate_model(df: DataFrame, label: str = "label", score: str = "score",
                   threshold: float = 0.5, keys: tuple[str, ...] = ()) -> DataFrame:
    """The five evaluation measures of a scored, labelled split per key group, from one pass over it.

    Rows without a score or a label take no part in any of them; ``unscored`` tells how many there are.
    """
    said = F.col("_score") > F.lit(threshold)

    def total(which: str, prediction: Column) -> Column:
        return F.coalesce(F.sum(F.when(prediction, F.col(which))), F.lit(0))

    counts = _by_score(df, label, score, keys).groupBy(*keys).agg(
        total("pos", said).alias("tp"), total("neg", said).alias("fp"),
        total("neg", ~said).alias("tn"), total("pos", ~said).alias("fn"), _auc().alias("auc_roc"),
        F.coalesce(F.sum("lost"), F.lit(0)).alias("unscored"))
    return counts.select(*keys, *[c.alias(n) for n, c in _measures().items()], "auc_roc", "unscored")


def drift_score(base: DataFrame, current: DataFrame, col: str, bounds: list[float],
                limit: float = DRIFT_LIMIT, keys: tuple[str, ...] = ()) -> DataFrame:
    """Population stability index of a column over fixed bins, per key group.

    Both sides are counted in one aggregation to at most ``len(bounds) + 1`` rows per group.
    """
    slot = F.lit(len(bounds))
    for i, bound in reversed(list(enumerate(bounds))):
        slot = F.when(F.col(col) < F.lit(float(bound)), F.lit(i)).otherwise(slot)

    def side(df: DataFrame, is_base: bool) -> DataFrame:
        return df.filter(F.col(col).isNotNull()).select(*keys, slot.alias("bin"), F.lit(is_base).alias("base"))

    counted = side(base, True).unionByName(side(current, False)).groupBy(*keys, "bin").agg(
        F.count_if("base").alias("p"), F.count_if(~F.col("base")).alias("q"))
    return _psi(counted, keys).select(
        *keys, F.lit(col).alias("feature"), "psi", (F.col("psi") > F.lit(limit)).alias("drifted"))


def _psi(counted: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, psi) of counts p and q per (keys, bin); a share is never less than a small constant."""
    every_bin = Window.partitionBy(*keys)

    def share(name: str) -> Column:
        part = F.try_divide(F.col(name), F.sum(name).over(every_bin))
        return F.greatest(F.coalesce(part, F.lit(0.0)), F.lit(PSI_EPSILON))

    shares = counted.select(*keys, share("p").alias("p"), share("q").alias("q"))
    term = (F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))
    return shares.groupBy(*keys).agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("psi"))


def _stacked(df: DataFrame, features: tuple[str, ...], keys: tuple[str, ...], *more: Column) -> DataFrame:
    """(keys, feature, value, more) of all features in one pass; null and NaN are no values."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    rows = df.select(*keys, *more, F.inline(pairs))
    return rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def learn_bins(base: DataFrame, features: tuple[str, ...], bins: int = 10, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, feature, edges): the quantile edges of every feature of a baseline, to be kept as a table.

    Edge i of n sorted values is the one at the 0-based index ``n * i div bins``, exactly. A bin holds the values
    from its edge on and below the next, so values that tie with an edge lie above it; edges
    that tie are one, and the bin between them is none. Features share one pass; equal values are
    combined before they are shuffled.
    """
    group = [*keys, "feature"]
    dist = _stacked(base, features, keys).groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n"))
    below = ranked.with_totals_below(dist, group, "value", ["n"], ranked.double_bits(F.col("value")))
    index = [F.call_function("div", F.col("n_total") * i, F.lit(bins)) for i in range(1, bins)]
    here = lambda at: (F.col("n_below") <= at) & (at < F.col("n_below") + F.col("n"))
    edges = below.groupBy(*group).agg(*[F.max(F.when(here(at), F.col("value"))).alias(f"e{i}") for i, at in enumerate(index)])
    return edges.select(*group, F.array_sort(F.array_distinct(F.array(*[f"e{i}" for i in range(len(index))]))).alias("edges"))


def drift_on_bins(bins: DataFrame, base: DataFrame, current: DataFrame, features: tuple[str, ...],
                  limit: float = DRIFT_LIMIT, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, feature, psi, drifted): population stability of all features over learnt bins, in one stacked pass.

    Groups without bins, new since the baseline, have no index. A null key is a group.
    """
    group = (*keys, "feature")
    side = lambda df, is_base: _stacked(df, features, keys, F.lit(is_base).alias("base"))
    values = side(base, True).unionByName(side(current, False)).groupBy(*group, "value").agg(
        F.count_if("base").alias("p"), F.count_if(~F.col("base")).alias("q"))
    own = bins.withColumnsRenamed({c: f"_{c}_" for c in group})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in group])
    slot = F.size(F.filter("edges", lambda e: F.col("value") >= e)).alias("bin")
    counted = values.join(own, same).select(*group, slot, "p", "q").groupBy(*group, "bin").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    return _psi(counted, group).withColumn("drifted", F.col("psi") > F.lit(limit))


# --- decisions from quality ------------------------------------------------

def freshness_check(df: DataFrame, last_training: datetime, as_of: datetime, col: str = "ts",
                    min_records: int = MIN_NEW_RECORDS, period: timedelta = RETRAIN_PERIOD,
                    quality: DataFrame | None = None, drift: DataFrame | None = None) -> DataFrame:
    """New rows since the last training; retrain when enough rows came and the period has passed.

    ``quality`` is the row of ``data_quality_score``, ``drift`` any number of rows of a drift score: drift is
    detected if one has drifted. What isn't given is null.
    """
    due = as_of - last_training >= period
    score = F.lit(None).cast("double") if quality is None else quality.agg(F.max("score")).scalar()
    drifted = F.lit(None).cast("boolean") if drift is None else drift.agg(F.coalesce(F.bool_or("drifted"), F.lit(False))).scalar()
    return (df.agg(F.count_if(F.col(col) > F.lit(last_training)).alias("new_records_available"))
            .withColumn("last_training_date", F.lit(last_training))
            .withColumn("data_quality_score", score)
            .withColumn("should_retrain",
                        (F.col("new_records_available") >= F.lit(min_records)) & F.lit(due))
            .withColumn("data_drift_detected", drifted))


def model_health(df: DataFrame, drift_limit: float = DRIFT_LIMIT,
                 accuracy_floor: float = ACCURACY_FLOOR) -> DataFrame:
    """Status per run from ``model_drift_score`` and ``accuracy``; unknown values ask for nothing."""
    poor = F.coalesce((F.col("model_drift_score") > F.lit(drift_limit))
                      | (F.col("accuracy") < F.lit(accuracy_floor)), F.lit(False))
    return df.select(
        "run_id", F.when(poor, "degraded").otherwise("healthy").alias("model_status"),
        F.when(poor, "retrain").otherwise("continue_using").alias("recommendation"),
        poor.alias("needs_retraining"))
