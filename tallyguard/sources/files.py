"""File sources: transactions, dated files, metric rows and test runs."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyguard import schemas
from tallyguard.operators.registry import DEFAULT_METRICS

DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def scan_transactions(spark: SparkSession, paths: str | list[str],
                      schema: str = schemas.TRANSACTION, bad_col: str = schemas.CORRUPT) -> DataFrame:
    """Delimited transactions with a fixed schema; a line that doesn't fit is kept whole in ``bad_col``."""
    return (spark.read.schema(f"{schema}, {bad_col} string")
            .option("header", "true").option("enforceSchema", "true")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad_col)
            .csv(paths))


def select_daily_files(files: str | None, root: str) -> list[str]:
    """A comma-separated list of names under ``root``, or the root, which stands for all files below it."""
    named = [name.strip() for name in (files or "").split(",") if name.strip()]
    return [f"{root.rstrip('/')}/{name}" for name in named] or [root]


def read_daily_files(spark: SparkSession, paths: list[str], first: date | None = None, last: date | None = None,
                     schema: str = schemas.RAW_TRANSACTION) -> DataFrame:
    """Rows of the files below ``paths`` that carry a date, with that ``file_date``, from ``first`` to ``last``.

    Files are listed by Spark's reader and chosen by their path alone, so a file outside the
    range, or without a date, is never opened and no list of files passes through this program.
    """
    path = F.col("_metadata.file_path")
    dated = F.regexp_extract(path, rf"{DATE_IN_NAME}(?!.*\d{{4}}-\d{{2}}-\d{{2}})", 1)
    rows = (spark.read.schema(schema).option("header", "true").option("recursiveFileLookup", "true").csv(paths)
            .filter(path.rlike(DATE_IN_NAME)))
    if first:
        rows = rows.filter(dated >= first.isoformat())
    if last:
        rows = rows.filter(dated <= last.isoformat())
    return rows.withColumn("file_date", F.to_date(dated))


def scan_metric_json(spark: SparkSession, path: str,
                     defaults: dict[str, float] = DEFAULT_METRICS) -> DataFrame:
    """Rows of (metric, value, _corrupt); the defaults stand in when no metric with a value is there.

    An unreadable line is kept whole in ``_corrupt``; a line without a metric or value keeps what it has.
    """
    schema = f"{schemas.METRIC_VALUE}, {schemas.CORRUPT} string"
    fallback = spark.createDataFrame([(*entry, None) for entry in sorted(defaults.items())], schema)
    try:
        read = (spark.read.schema(schema).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", schemas.CORRUPT).json(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return fallback
    found = read.agg(F.coalesce(F.bool_or(F.col("metric").isNotNull() & F.col("value").isNotNull()), F.lit(False))).scalar()
    return read.unionByName(fallback.filter(~found))


def scan_test_results(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Saved test runs, one row per test; a run is a file, or a line when not ``multi_line``."""
    runs = spark.read.schema(schemas.TEST_RUN).option("multiLine", multi_line).json(path)
    return runs.select("test_run_id", F.explode("detailed_results").alias("r")).select(
        "test_run_id", "r.test_name", "r.status", "r.response_time_ms",
        F.try_to_timestamp("r.timestamp").alias("timestamp"), "r.details")
