"""Stream sources and sinks. Broker options come from the caller; nothing is built in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

# Fixed value: trigger interval of the scoring stream.
TRIGGER_INTERVAL = "30 seconds"


def kafka_read_options(brokers: str, topic: str, max_per_trigger: int,
                       starting: str = "latest", **extra: str) -> dict[str, str]:
    """``max_per_trigger`` over the trigger's length is the most that the stream can follow: choose it by the load."""
    if not brokers or not topic:
        raise ValueError("brokers and topic are required")
    return {"kafka.bootstrap.servers": brokers, "subscribe": topic,
            "maxOffsetsPerTrigger": str(max_per_trigger), "startingOffsets": starting,
            "failOnDataLoss": "true", **extra}


def kafka_write_options(brokers: str, topic: str, **extra: str) -> dict[str, str]:
    if not brokers or not topic:
        raise ValueError("brokers and topic are required")
    return {"kafka.bootstrap.servers": brokers, "topic": topic, **extra}


def stream_source(spark: SparkSession, options: dict[str, str], kind: str = "kafka",
                  schema: str | None = None, max_per_trigger: int | None = None) -> DataFrame:
    """A topic as (key, value, topic, timestamp), or a directory of Parquet files of ``schema``."""
    if kind == "kafka":
        return (spark.readStream.format("kafka").options(**options).load()
                .select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "timestamp"))
    if kind == "files":
        reader = spark.readStream.schema(schema)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.parquet(options["path"])
    raise ValueError(f"unknown kind {kind!r}")


def as_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as (key, JSON value)."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def _write(df: DataFrame, options: dict[str, str], checkpoint: str, kind: str, mode: str,
           available_now: bool) -> StreamingQuery:
    fmt = {"kafka": "kafka", "files": "parquet"}[kind]
    trigger = {"availableNow": True} if available_now else {"processingTime": TRIGGER_INTERVAL}
    if kind == "files" and mode == "update":
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{options['path']}/batch_id={batch_id}")

        return (df.writeStream.foreachBatch(write).outputMode(mode)
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())
    return (df.writeStream.format(fmt).options(**options).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def stream_sink_predictions(df: DataFrame, options: dict[str, str], checkpoint: str,
                            kind: str = "kafka", available_now: bool = False) -> StreamingQuery:
    """Predictions keyed by transaction id."""
    return _write(as_messages(df, "transaction_id"), options, checkpoint, kind, "append", available_now)


def stream_sink_metrics(df: DataFrame, options: dict[str, str], checkpoint: str, key: str = "window_start",
                        kind: str = "kafka", available_now: bool = False) -> StreamingQuery:
    """Run metrics to their own topic, as a second query over the predictions.

    A window is sent whenever it changes, under its key: the newest message of a key holds, and
    windows still open when the input ends are there as well.
    """
    return _write(as_messages(df, key), options, checkpoint, kind, "update", available_now)
