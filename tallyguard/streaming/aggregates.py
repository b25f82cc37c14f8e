"""Windowed and running aggregates of streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tallyguard.functions import intervals
from tallyguard.operators import quality
from tallyguard.streaming.scoring import WATERMARK


def _windowed(df: DataFrame, width: timedelta, slide: timedelta, delay: timedelta,
              aggs: list[Column], ts: str) -> DataFrame:
    window = F.window(F.col(ts), intervals.text(width), intervals.text(slide))
    return (df.withWatermark(ts, intervals.text(delay)).groupBy(window).agg(*aggs)
            .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
            .drop("window"))


def stream_throughput(df: DataFrame, width: timedelta, delay: timedelta = WATERMARK,
                      ts: str = "ts") -> DataFrame:
    """Rows and rate per tumbling window."""
    counted = _windowed(df, width, width, delay, [F.count("*").alias("rows")], ts)
    return counted.withColumn("rate", F.col("rows") / F.lit(width.total_seconds()))


def stream_panes(df: DataFrame, step: timedelta, delay: timedelta = WATERMARK, ts: str = "ts") -> DataFrame:
    """Rows per pane of one step: what a sliding rate needs of a stream. Every row counts in one pane."""
    return _windowed(df, step, step, delay, [F.count("*").alias("rows")], ts)


def rate_of_panes(panes: DataFrame, step: timedelta, window: timedelta = timedelta(minutes=5)) -> DataFrame:
    """Rows per second over a window sliding by ``step``, from a table of panes."""
    earlier = intervals.literal(window - step)
    starts = panes.select("rows", F.explode(F.sequence(
        F.col("window_start") - earlier, F.col("window_start"), intervals.literal(step))).alias("window_start"))
    return starts.groupBy("window_start").agg(F.sum("rows").alias("rows")).select(
        "window_start", (F.col("window_start") + intervals.literal(window)).alias("window_end"),
        (F.col("rows") / F.lit(window.total_seconds())).alias("rate"))


def stream_fraud_rate(pred: DataFrame, width: timedelta, delay: timedelta = WATERMARK,
                      ts: str = "ts") -> DataFrame:
    """Percentage predicted as fraud per tumbling window."""
    counted = _windowed(pred, width, width, delay, [
        F.count_if("is_fraud_predicted").alias("_hit"), F.count("*").alias("_n")], ts)
    return counted.select("window_start", "window_end",
                          (F.lit(100.0) * F.col("_hit") / F.col("_n")).alias("fraud_pct"))


def stream_user_stats(df: DataFrame) -> DataFrame:
    """The batch statistics as a running aggregate (update or complete mode)."""
    return quality.user_stats(df)


def keyed_table(df: DataFrame, keys: list[str], path: str, checkpoint: str, available_now: bool = True,
                compact_every: int = 20) -> StreamingQuery:
    """The changed rows of a running aggregate in every batch, under the batch's id; read by ``latest_rows``.

    A retried batch replaces itself. Every ``compact_every`` batches the newest row of each key is written
    whole and the folders before it go, so the table stays within that many batches of its own size.
    """
    spark, schema = df.sparkSession, df.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        if batch_id == 0 or batch_id % compact_every:
            batch.write.mode("overwrite").parquet(target)
            return
        before = [p for n, p in _batches(spark, path) if n < batch_id]
        if not _exists(spark, f"{target}/_SUCCESS"):  # else this batch is retried after its folder was written
            earlier = latest_rows(spark, path, keys, schema, batch_id).withColumn("batch_id", F.lit(-1))
            _newest(earlier.unionByName(batch.withColumn("batch_id", F.lit(batch_id))), keys).write.mode(
                "overwrite").parquet(target)
        for old in before:
            _files(spark, old)[0].delete(_files(spark, old)[1], True)

    trigger = {"availableNow": True} if available_now else {"processingTime": "30 seconds"}
    return (df.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def latest_rows(spark: SparkSession, path: str, keys: list[str], schema: StructType, before: int | None = None) -> DataFrame:
    """The newest row of every key of a ``keyed_table``."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).option(
        "basePath", path).parquet(path)
    return _newest(rows if before is None else rows.filter(F.col("batch_id") < before), keys)


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    names = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*names), "batch_id").alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in names]).select(
        *[c for c in rows.columns if c != "batch_id"])


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


def _batches(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    files, where = _files(spark, path)
    found = [s.getPath() for s in files.listStatus(where)] if files.exists(where) else []
    return [(int(p.getName().split("=")[1]), p.toString()) for p in found if p.getName().startswith("batch_id=")]


def stream_user_stats_table(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """The running statistics of every user as a keyed table."""
    return keyed_table(stream_user_stats(df), ["user_id"], path, checkpoint, available_now)


def latest_user_stats(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest row of every user; ``schema`` is that of ``stream_user_stats``."""
    return latest_rows(spark, path, ["user_id"], schema)
