"""Feature preparation, scorers and the shape of predictions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyguard.functions import features as fx
from tallyguard.operators import skew
from tallyguard.session import scratch_dir


# --- features -------------------------------------------------------------

def fill_defaults(df: DataFrame, age: int = fx.DEFAULT_AGE, risk: float = fx.DEFAULT_RISK) -> DataFrame:
    """Fill the optional features where the column exists; NaN counts as missing."""
    types = dict(df.dtypes)
    fills = {"user_age": age, "location_risk_score": risk}
    return df.withColumns({
        name: F.coalesce(fx.without_nan(F.col(name), types[name]), F.lit(value))
        for name, value in fills.items() if name in types
    })


def encode_category(df: DataFrame, col: str = "merchant_category") -> DataFrame:
    return df.withColumn(col, fx.category_code(F.col(col)))


def feature_projection(df: DataFrame, keep: tuple[str, ...] = ("transaction_id",)) -> DataFrame:
    """The feature columns in model order as doubles, beside the kept id columns."""
    used = [c for c in fx.FEATURES if c not in fx.OPTIONAL_FEATURES or c in df.columns]
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in used])


def prepare_features(df: DataFrame, keep: tuple[str, ...] = ("transaction_id",)) -> DataFrame:
    return feature_projection(encode_category(fill_defaults(df)), keep)


def time_features(df: DataFrame, col: str = "ts") -> DataFrame:
    """Hour 0..23 and weekday with Monday = 0."""
    return df.withColumns({"hour_of_day": F.hour(col), "day_of_week": F.weekday(F.col(col))})


def amount_uplift(df: DataFrame, factor: float = 1.1) -> DataFrame:
    return df.withColumn("processed", F.col("amount") * F.lit(factor))


def filter_fraud(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_fraud") == 1)


# --- decisions ------------------------------------------------------------

def rule_score(df: DataFrame, cutoff: float = fx.RULE_CUTOFF) -> DataFrame:
    return df.withColumn("fraud_probability", fx.rule_probability(F.col("amount"), cutoff))


def decide_threshold(df: DataFrame, threshold: float = fx.FRAUD_THRESHOLD) -> DataFrame:
    return df.withColumn("is_fraud_predicted", F.col("fraud_probability") > F.lit(threshold))


def proba_fallback(df: DataFrame, mode: str = "single") -> DataFrame:
    """Probability and verdict of a model that only answers with a label."""
    label = F.col("label").cast("double")
    if mode == "single":
        probability = F.when(label.isin(0.0, 1.0), label).otherwise(F.lit(0.5))
    elif mode == "batch":
        probability = label
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumns({"fraud_probability": probability, "is_fraud": label != F.lit(0.0)})


def confidence_band(df: DataFrame, mode: str = "single") -> DataFrame:
    return df.withColumn("confidence", fx.confidence(F.col("fraud_probability"), mode))


def amortized_latency(df: DataFrame, key: str = "request_id", total: str = "total_ms",
                      row_id: str = "transaction_id") -> DataFrame:
    """Each row's share of its request's time, to two decimals."""
    sized = skew.with_group_totals(df, key, row_id, {"_rows": F.count("*")})
    share = F.round(F.try_divide(F.col(total).cast("double"), F.col("_rows")), 2)
    return sized.withColumn("processing_time_ms", share).drop("_rows")


def prediction_response(df: DataFrame, champions: DataFrame, model_name: str) -> DataFrame:
    """Final rows of a scored batch, carrying the resolved version of one model.

    The version is a scalar: a model without one, or with more than one champion, is an
    error as soon as a row is answered.
    """
    version = champions.filter(F.col("model_name") == model_name).select(F.col("version").cast("string")).scalar()
    unresolved = F.raise_error(F.lit(f"no usable version of model {model_name}")).cast("string")
    return df.withColumns({"model_name": F.lit(model_name), "model_version": F.coalesce(version, unresolved),
                           "prediction_timestamp": F.current_timestamp()})


def batch_response(df: DataFrame, total_ms: str = "total_ms") -> DataFrame:
    """One row per accepted request; the guard bounds the collected list by its limit."""
    row = F.struct("transaction_id", "is_fraud_predicted", "fraud_probability", "confidence")
    return (df.filter("accepted").groupBy("request_id")
            .agg(F.sort_array(F.collect_list(row)).alias("predictions"),
                 F.count("*").alias("batch_size"),
                 F.max(total_ms).alias("total_processing_time_ms")))


def preview_predictions(df: DataFrame, n: int = 10) -> DataFrame:
    return (df.select("transaction_id", "amount", "fraud_probability", "is_fraud_predicted")
            .orderBy("transaction_id").limit(n))


# --- scorers --------------------------------------------------------------

class Scorer(Protocol):
    """Anything that adds ``fraud_probability`` to rows, batch or stream."""

    def score(self, df: DataFrame) -> DataFrame: ...


class RuleScorer:
    def __init__(self, cutoff: float = fx.RULE_CUTOFF):
        self.cutoff = cutoff

    def score(self, df: DataFrame) -> DataFrame:
        return rule_score(df, self.cutoff)


class SparkModelScorer:
    def __init__(self, model: PipelineModel | str):
        self.model = model

    def score(self, df: DataFrame) -> DataFrame:
        return score_batch_model(df, self.model)


class PythonModelScorer:
    def __init__(self, loader: Callable[[], object]):
        self.loader = loader

    def score(self, df: DataFrame) -> DataFrame:
        return score_python_model(df, self.loader)


def _without_summaries(spark: SparkSession, model: PipelineModel) -> PipelineModel:
    """``model`` as it is when loaded: the summary that a stage keeps of its training refers to the session, which
    can't be sent to tasks once a row count was observed in it."""
    if not any(getattr(stage, "hasSummary", False) for stage in model.stages):
        return model
    path = scratch_dir(spark, "fitted")
    model.write().save(path)
    return PipelineModel.load(path)


def score_batch_model(df: DataFrame, model: PipelineModel | str) -> DataFrame:
    """Score feature rows with a fitted pipeline, given or loaded from its path."""
    fitted = PipelineModel.load(model) if isinstance(model, str) else _without_summaries(df.sparkSession, model)
    return (fitted.transform(df)
            .withColumns({"is_fraud": F.col("prediction") != F.lit(0.0),
                          "fraud_probability": vector_to_array("probability").getItem(1)})
            .drop("features", "rawPrediction", "probability", "prediction"))


def score_python_model(df: DataFrame, loader: Callable[[], object]) -> DataFrame:
    """Score feature rows with any Python model having ``predict`` and perhaps ``predict_proba``.

    The model is loaded once per task and sees whole Arrow batches; a model
    without probabilities, or whose probabilities fail, answers with its label.
    """
    inputs = [c for c in fx.FEATURES if c in df.columns]
    schema = T.StructType(df.schema.fields + [
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("fraud_probability", T.DoubleType()),
    ])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loader()
        for batch in batches:
            labels = model.predict(batch[inputs])
            try:
                probability = model.predict_proba(batch[inputs])[:, 1]
            except Exception:  # noqa: BLE001 - whatever the model raises, its label still stands
                probability = labels.astype(float)
            yield batch.assign(is_fraud=labels.astype(bool), fraud_probability=probability)

    return df.mapInPandas(score, schema)
