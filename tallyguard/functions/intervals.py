"""Time arithmetic shared by batch operators; works for both timestamp types."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def text(span: timedelta) -> str:
    """Duration string for ``window`` and ``withWatermark``."""
    return f"{micros(span)} microseconds"


def literal(span: timedelta) -> Column:
    """The span as a day-time interval column."""
    return F.lit(span)


def pane(ts: Column, width: timedelta) -> Column:
    """Start of the tumbling pane that holds ``ts``."""
    return F.window(ts, text(width)).getField("start")


def seconds_between(start: Column, end: Column) -> Column:
    """``end - start`` in seconds, as a double."""
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / F.lit(1e6)
