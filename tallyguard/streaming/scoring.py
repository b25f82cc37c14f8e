"""Scoring, quarantine and logging of streams, with the functions of the batch side."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyguard import schemas
from tallyguard.functions import features as fx, intervals
from tallyguard.operators import scoring
from tallyguard.sources import logs

WATERMARK = timedelta(minutes=10)  # our choice: how late a row may be


def stream_parse(raw: DataFrame, schema: str = schemas.STREAM_TRANSACTION) -> DataFrame:
    """JSON values as typed rows; a value that doesn't fit is kept in ``_corrupt``."""
    return logs.json_rows(raw, schema)


def stream_score(df: DataFrame, scorer: scoring.Scorer, model_name: str, model_version: str,
                 threshold: float = fx.FRAUD_THRESHOLD) -> DataFrame:
    """Probability, decision and model stamp. Stateless, so it serves batches as well."""
    decided = scoring.decide_threshold(scorer.score(df), threshold)
    return decided.withColumns({"model_name": F.lit(model_name), "model_version": F.lit(model_version),
                                "prediction_timestamp": F.current_timestamp()})


def stream_dead_letter(df: DataFrame, good_path: str, bad_path: str, checkpoint: str,
                       available_now: bool = True) -> StreamingQuery:
    """Readable rows to one place and the others to another; a retried batch replaces itself."""
    good_cols = [c for c in df.columns if c != schemas.CORRUPT]

    def route(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            bad = F.col(schemas.CORRUPT).isNotNull()
            for rows, path in ((batch.filter(~bad).select(*good_cols), good_path),
                               (batch.filter(bad).select(schemas.CORRUPT), bad_path)):
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return _each_batch(df, route, checkpoint, available_now)


def stream_predictions_log(pred: DataFrame, path: str, checkpoint: str,
                           available_now: bool = True) -> StreamingQuery:
    """Exactly-once prediction files, by the file sink's own log."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "30 seconds"}
    return (pred.withColumn("log_date", F.to_date("timestamp")).writeStream.format("parquet")
            .partitionBy("log_date").option("checkpointLocation", checkpoint).option("path", path)
            .outputMode("append").trigger(**trigger).start())


def _each_batch(df: DataFrame, write, checkpoint: str, available_now: bool) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": "30 seconds"}
    return (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def stream_label_join(pred: DataFrame, labels: DataFrame, bound: timedelta,
                      delay: timedelta = WATERMARK, unmatched: bool = False) -> DataFrame:
    """Predictions (transaction_id, ts) with labels (transaction_id, label_ts, label) at most ``bound`` later.

    With ``unmatched``, a prediction whose label can't come any more is answered without one: when both
    watermarks have passed its ``bound``, and it leaves the state.
    """
    p = pred.withWatermark("ts", intervals.text(delay)).alias("p")
    late = labels.withWatermark("label_ts", intervals.text(delay)).alias("l")
    on = ((F.col("p.transaction_id") == F.col("l.transaction_id"))
          & (F.col("l.label_ts") >= F.col("p.ts"))
          & (F.col("l.label_ts") <= F.col("p.ts") + intervals.literal(bound)))
    return p.join(late, on, "left_outer" if unmatched else "inner").drop(F.col("l.transaction_id"))
