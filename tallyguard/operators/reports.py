"""Run reports, test-run summaries and release gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyguard.functions import texts
from tallyguard.operators.quality import percent

# Exact statuses counted in a test run.
PASSED = ("✅ PASS", "✅ COMPLETED")
FAILED = "❌ FAIL"
ERRORED = "❌ ERROR"

# Limits of the run recommendations and of a release.
EFFICIENCY_FLOOR = 90.0
ACCURACY_FLOOR = 0.85
LATENCY_CEILING_MS = 300.0
GATE = {"functional": 90.0, "avg_ms": 1000.0, "success": 95.0, "tests": 70.0}


# --- runs -----------------------------------------------------------------

def run_report_join(runs: DataFrame, perf: DataFrame, quality: DataFrame, cluster: DataFrame) -> DataFrame:
    """One row per run with its parts as structs; a missing or failed part counts as not completed."""
    def part(df: DataFrame, name: str) -> DataFrame:
        fields = [c for c in df.columns if c != "run_id"]
        return df.select("run_id", F.struct(*fields).alias(name))

    rows = (runs.join(part(perf, "performance_metrics"), "run_id", "left")
            .join(part(quality, "model_quality_metrics"), "run_id", "left")
            .join(cluster, "run_id", "left"))
    return rows.withColumns({
        "streaming_completed": F.col("performance_metrics").isNotNull()
        & F.col("performance_metrics.error").isNull(),
        "model_evaluation_completed": F.col("model_quality_metrics").isNotNull()
        & F.col("model_quality_metrics.error").isNull()})


def _recommendations(perf: str, quality: str) -> Column:
    """The limits that a run breaks, from part structs; within a part, a missing number counts as 0."""
    def number(part: str, name: str) -> Column:
        return F.coalesce(F.col(f"{part}.{name}").cast("double"), F.lit(0.0))

    has_perf, has_quality = F.col(perf).isNotNull(), F.col(quality).isNotNull()
    return texts.reasons({
        f"throughput_efficiency < {EFFICIENCY_FLOOR:g}":
            has_perf & (number(perf, "throughput_efficiency") < F.lit(EFFICIENCY_FLOOR)),
        f"accuracy < {ACCURACY_FLOOR:g}":
            has_quality & (number(quality, "accuracy") < F.lit(ACCURACY_FLOOR)),
        f"avg_processing_latency_ms > {LATENCY_CEILING_MS:g}":
            has_perf & (number(perf, "avg_processing_latency_ms") > F.lit(LATENCY_CEILING_MS)),
    })


def run_recommendations(joined: DataFrame) -> DataFrame:
    return joined.select("run_id", _recommendations(
        "performance_metrics", "model_quality_metrics").alias("recommendations"))


def run_report(runs: DataFrame, perf: DataFrame, quality: DataFrame, cluster: DataFrame,
               next_steps: tuple[str, ...] = ()) -> DataFrame:
    """The joined run with its status, the limits it breaks, and the caller's next steps."""
    joined = run_report_join(runs, perf, quality, cluster)
    return joined.withColumns({
        "pipeline_status": F.lit("completed"),
        "recommendations": _recommendations("performance_metrics", "model_quality_metrics"),
        "next_steps": F.array(*[F.lit(s) for s in next_steps]).cast("array<string>")})


def training_report(runs: DataFrame, evaluation: DataFrame, promotion: DataFrame) -> DataFrame:
    """Outcome of every training run, and the next one a day later."""
    done = promotion.select("run_id", F.lit(True).alias("_promoted"))
    scored = evaluation.select("run_id", "improvement_score")
    return (runs.join(scored, "run_id", "left").join(done, "run_id", "left")
            .select("run_id", "execution_date", F.lit("completed").alias("training_status"),
                    F.coalesce("_promoted", F.lit(False)).alias("model_promoted"),
                    "improvement_score",
                    F.date_add("execution_date", 1).alias("next_training_scheduled")))


# --- test runs ------------------------------------------------------------

def test_run_summary(results: DataFrame, keys: tuple[str, ...] = ("test_run_id",)) -> DataFrame:
    """Counts by exact status; other statuses count in the total only."""
    ok = F.count_if(F.col("status").isin(*PASSED))
    seconds = F.timestamp_diff("MICROSECOND", F.min("timestamp"), F.max("timestamp")) / F.lit(1e6)
    return results.groupBy(*keys).agg(
        F.count("*").alias("total"), ok.alias("passed"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.count_if(F.col("status") == ERRORED).alias("error"),
        percent(ok, F.count("*")).alias("success_rate"),
        F.coalesce(seconds, F.lit(0.0)).alias("duration_seconds"))


def tests_by_category(results: DataFrame) -> DataFrame:
    """Counts per category and status class; the tests themselves stay rows."""
    kind = texts.status_class(F.col("status"))
    return (results.withColumns({"category": texts.test_category(F.col("test_name")), "_class": kind})
            .groupBy("category")
            .agg(F.count("*").alias("n"),
                 *[F.count_if(F.col("_class") == c).alias(f"n_{c}") for c in ("pass", "fail", "error")]))


def security_score(df: DataFrame) -> DataFrame:
    safe = F.count_if("safe")
    return df.agg(safe.alias("safe"), F.count("*").alias("total"),
                  percent(safe, F.count("*")).alias("score"))


def release_gate(summary: DataFrame, latency: DataFrame, security: DataFrame,
                 gate: dict[str, float] = GATE) -> DataFrame:
    """Release conditions of one test run from three one-row summaries."""
    def value(df: DataFrame, name: str) -> Column:
        return df.select(name).scalar()

    return summary.select(
        (F.col("success_rate") >= gate["functional"]).alias("functional_ok"),
        (F.col("success_rate") >= gate["tests"]).alias("tests_ok"),
        (value(latency, "avg_response_time") <= gate["avg_ms"]).alias("latency_ok"),
        (value(latency, "success_rate") >= gate["success"]).alias("success_ok"),
        (value(security, "safe") == value(security, "total")).alias("security_ok"),
    ).withColumn("passed", F.col("functional_ok") & F.col("tests_ok") & F.col("latency_ok")
                 & F.col("success_ok") & F.col("security_ok"))


def access_log_stats(log: DataFrame) -> DataFrame:
    return log.groupBy("path", "status_code").agg(
        F.count("*").alias("n"), F.avg("duration_ms").alias("avg_ms"),
        F.max("duration_ms").alias("max_ms"),
        F.avg(F.when(F.col("status_code") >= 400, 1.0).otherwise(0.0)).alias("error_share"))
