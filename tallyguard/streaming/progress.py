"""What a stream has done: a row for every batch, and the rows that came too late.

Spark's windows drop a row whose window has closed, and only count that. ``split_arrivals`` looks
before any window does, and keeps such rows, so every row that came is answered, dead or late.
What it answers no window drops: Spark compares with the watermark of one batch earlier still.
"""

from __future__ import annotations

import json
import threading
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tallyguard import schemas
from tallyguard.functions import intervals
from tallyguard.streaming.scoring import WATERMARK

PROGRESS = ("query string, run_id string, batch_id bigint, at timestamp, rows bigint, rows_per_second double, "
            "watermark timestamp, state_rows bigint, dropped bigint")
ANSWERED, DEAD, LATE = "answered", "dead", "late"


class ProgressTable(StreamingQueryListener):
    """Writes one row per batch of every query of the session below ``path``, as a file of its own.

    A file is named by run and batch, so a batch is in the table once. ``finish`` waits for a query
    and for the last of its rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ended = spark, path, {}
        self._folder().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(self._folder())

    def __enter__(self) -> "ProgressTable":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _folder(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query": str(p.id), "run_id": str(p.runId), "batch_id": p.batchId, "at": p.timestamp, "rows": p.numInputRows,
               "rows_per_second": p.processedRowsPerSecond, "watermark": (p.eventTime or {}).get("watermark"),
               "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
               "dropped": sum(s.numRowsDroppedByWatermark for s in p.stateOperators)}
        if row["rows_per_second"] != row["rows_per_second"]:  # not a number, of an empty batch
            row["rows_per_second"] = None
        at = self._folder(f"{p.runId}-{p.batchId}.json")
        out = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
        out.write(bytearray(json.dumps(row).encode()))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def finish(self, query: StreamingQuery, wait: float = 60.0) -> None:
        query.awaitTermination()
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(wait):
            raise TimeoutError("the query's end was not reported")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).json(self.path)


def split_arrivals(rows: DataFrame, width: timedelta, path: str, checkpoint: str, delay: timedelta = WATERMARK,
                   ts: str = "ts", dead: Column | None = None, available_now: bool = True) -> StreamingQuery:
    """Write every row below ``path`` under its route: dead where ``dead`` holds, late, or answered.

    A row is late if its window of ``width`` ended at the watermark or before: ``delay`` behind the newest time
    of all earlier batches. A row without a time is never late. A repeated batch replaces what
    it wrote, and finds the same watermark.
    """
    dead = F.col(schemas.CORRUPT).isNotNull() if dead is None and schemas.CORRUPT in rows.columns else dead
    dead = F.lit(False) if dead is None else F.coalesce(dead, F.lit(False))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = _newest(spark, path).filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0] if batch_id else None
        at, size = F.unix_micros(ts), F.lit(intervals.micros(width))
        ended = at - F.pmod(at, size) + size  # a window expression would drop rows without a time
        late = F.lit(False) if newest is None else F.coalesce(ended <= newest - intervals.micros(delay), F.lit(False))
        route = F.when(dead, DEAD).when(late, LATE).otherwise(ANSWERED)
        here = f"{path}/rows/batch={batch_id}"
        batch.withColumn("route", route).write.mode("overwrite").partitionBy("route").parquet(here)
        found = spark.read.schema(batch.schema).parquet(here).agg(F.max(F.unix_micros(ts)).alias("newest"))
        found.write.mode("overwrite").parquet(f"{path}/newest/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _newest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("newest bigint, batch int").parquet(f"{path}/newest")


def arrivals(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows that ``split_arrivals`` wrote, with their ``batch`` and ``route``."""
    return spark.read.schema(f"{schema}, batch int, route string").parquet(f"{path}/rows")
