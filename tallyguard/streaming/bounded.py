"""Streams over an input that ends.

A watermark stays behind the newest row, so what a stream holds for late rows is still open
when its input ends: windows, holds, repeat limits, rows that wait for a partner. A last
row, later than all that can come, lets the watermark pass everything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

END = "9999-01-01"  # of the last row; its own windows and timers are never due


def with_end_mark(rows: DataFrame, marks: str) -> DataFrame:
    """``rows`` (a stream) and the rows that will be written to ``marks``, an own folder of this stream."""
    spark, none = rows.sparkSession, _mark(rows, None).limit(0)
    none.write.parquet(marks)
    return rows.unionByName(spark.readStream.schema(none.schema).parquet(marks))


def run_to_end(start: Callable[[], StreamingQuery], rows: DataFrame, ts: str, marks: str) -> None:
    """Run a query over all that is there, then once more for the end mark, which only has a time.

    ``start`` starts the query with one checkpoint and ends by itself (``availableNow``). Keys of the
    mark are null; its rows don't leave a windowed aggregate. A join drops rows with a null key before they
    reach the watermark, so its sides must give the mark keys that aren't null and don't match.
    """
    start().awaitTermination()
    _mark(rows, ts).write.mode("append").parquet(marks)
    start().awaitTermination()


def _mark(rows: DataFrame, ts: str | None) -> DataFrame:
    return rows.sparkSession.range(1).select(
        *[F.lit(END if f.name == ts else None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
