"""Latency, outcome and histogram summaries of requests."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

from tallyguard.functions import intervals
from tallyguard.operators import ranked
from tallyguard.operators.quality import percent

# Bucket bounds in seconds of the metrics client's default histogram.
DEFAULT_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75,
                  1.0, 2.5, 5.0, 7.5, 10.0, float("inf"))

# Possible outcomes of a request.


def latency_summary(df: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("status_code") == 200)
    return df.agg(
        F.avg("ms").alias("avg_response_time"), F.min("ms").alias("min_response_time"),
        F.max("ms").alias("max_response_time"), percent(ok, F.count("*")).alias("success_rate"),
        F.count("*").alias("total_requests"), ok.alias("successful_requests"))


def latency_percentiles(df: DataFrame, col: str = "ms", keys: tuple[str, ...] = (),
                        qs: tuple[float, ...] = (0.95, 0.99)) -> DataFrame:
    return ranked.values_at(df, col, list(keys), {f"p{round(q * 100)}": q for q in qs})


def success_rate(df: DataFrame, duration_s: float) -> DataFrame:
    """Totals of a run of known duration; every outcome but success is a failure."""
    ok = F.count_if(F.col("status") == "success")
    rps = F.count("*") / F.lit(float(duration_s)) if duration_s > 0 else F.lit(0.0)
    return df.agg(F.count("*").alias("total"), ok.alias("successful"),
                  (F.count("*") - ok).alias("failed"),
                  percent(ok, F.count("*")).alias("success_rate"), rps.alias("avg_rps"))


def outcome_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("status").agg(F.count("*").alias("n"))


def model_serving_metrics(df: DataFrame, col: str = "seconds") -> DataFrame:
    return df.agg(F.count(col).alias("predictions_total"),
                  F.coalesce(F.avg(col) * 1000, F.lit(0.0)).alias("avg_prediction_time_ms"))


def latency_histogram(df: DataFrame, col: str = "seconds", bounds: tuple[float, ...] = DEFAULT_BOUNDS,
                      keys: tuple[str, ...] = ()) -> DataFrame:
    """Cumulative bucket counts with sum and count, in one pass over the rows."""
    value = F.col(col)
    wide = df.groupBy(*keys).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("sum"), F.count(value).alias("count"),
        *[F.count_if(value <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(bounds)])
    pairs = [x for i, b in enumerate(bounds) for x in (F.lit(float(b)), F.col(f"b{i}"))]
    return wide.select(*keys, "sum", "count",
                       F.stack(F.lit(len(bounds)), *pairs).alias("le", "cumulative"))


def histogram_quantile(buckets: DataFrame, q: float, keys: tuple[str, ...] = ("series",)) -> DataFrame:
    """Quantile of cumulative buckets, linear inside the bucket that holds the rank.

    A rank in the unbounded bucket answers the highest finite bound; an empty
    histogram gives no row. Each series has as many rows as bounds.
    """
    by_le = Window.partitionBy(*keys).orderBy("le")
    rank = F.lit(q) * F.max("cumulative").over(Window.partitionBy(*keys))
    steps = buckets.select(
        *keys, "le", "cumulative", rank.alias("_rank"),
        F.coalesce(F.lag("le").over(by_le), F.lit(0.0)).alias("_low"),
        F.coalesce(F.lag("cumulative").over(by_le), F.lit(0)).alias("_before"))
    hit = (steps.filter((F.col("cumulative") >= F.col("_rank")) & (F.col("_rank") > 0))
           .groupBy(*keys)
           .agg(F.min_by(F.struct("le", "cumulative", "_rank", "_low", "_before"), "le").alias("h")))
    inside = (F.col("h._low") + (F.col("h.le") - F.col("h._low"))
              * ((F.col("h._rank") - F.col("h._before")) / (F.col("h.cumulative") - F.col("h._before"))))
    return hit.select(*keys, F.when(F.col("h.le") == F.lit(float("inf")), F.col("h._low"))
                      .otherwise(inside).alias("value"))


def progress_snapshots(df: DataFrame, every: timedelta, col: str = "ts") -> DataFrame:
    """Totals so far at the end of every bucket that has requests.

    Buckets are summed up inside cells of time, and cells against each other, so
    the running total is not one task's work.
    """
    buckets = df.groupBy(intervals.pane(F.col(col), every).alias("bucket")).agg(
        F.count("*").alias("requests"), F.count_if(F.col("status") == "success").alias("successes"))
    rows = ranked.with_totals_below(buckets, [], "bucket", ["requests", "successes"],
                                    ranked.time_bits(F.col("bucket")))
    total = F.col("requests_below") + F.col("requests")
    ok = F.col("successes_below") + F.col("successes")
    return rows.select("bucket", total.alias("total"), ok.alias("successful"),
                       (total - ok).alias("failed"), percent(ok, total).alias("success_rate"))
