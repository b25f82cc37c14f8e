"""Alert state machines kept per key in the state store.

Rows are first combined into evaluations, one per key and step, by a windowed
aggregate that closes behind the watermark. What reaches a key in one trigger is
bounded by the steps in it, not by the rows, and a key holds one small value.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyguard.functions import intervals
from tallyguard.operators.notices import FIRING as TOLD, LIMITS, RESOLVED as OVER, SECOND
from tallyguard.streaming.scoring import WATERMARK

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"

INACTIVE, PENDING, FIRING, RESOLVED = "inactive", "pending", "firing", "resolved"


def _micros(stamps: pd.Series) -> list[int]:
    return stamps.astype("datetime64[us]").astype("int64").tolist()


def _ordered(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The evaluations of one key in one trigger, which come in any order."""
    return pd.concat(list(rows)).sort_values("at", ignore_index=True)


class HoldProcessor(StatefulProcessor):
    """inactive -> pending -> firing -> resolved, from evaluations (series, at, active).

    As in batch, an inactive evaluation or none for longer than ``step`` breaks the
    hold: what was firing resolves, what was pending is inactive again, both one step
    after the last active evaluation. Only series that are pending or firing have state, and an
    event-time timer breaks the hold of one that falls silent.
    """

    def __init__(self, hold_us: int, step_us: int):
        self.hold_us, self.step_us = hold_us, step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "state string, since long, last long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = self.run.exists()
        state, since, last = self.run.get() if kept else (INACTIVE, 0, 0)
        if kept:
            self.handle.deleteTimer(self._timer(last))
        changes = []
        frame = _ordered(rows)
        for at, active in zip(_micros(frame["at"]), frame["active"].tolist()):
            if state != INACTIVE and (not active or at - last > self.step_us):
                changes.append(self._broken(state, last))
                state = INACTIVE
            if active:
                if state == INACTIVE:
                    state, since = PENDING, at
                    changes.append((PENDING, at))
                if state == PENDING and at - since >= self.hold_us:
                    state = FIRING
                    changes.append((FIRING, at))
                last = at
        if state != INACTIVE:
            self.handle.registerTimer(self._timer(last))
            self.run.update((state, since, last))
        elif kept:
            self.run.clear()
        if changes:
            yield self._frame(key, changes)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.run.exists():
            state, _, last = self.run.get()
            self.run.clear()
            yield self._frame(key, [self._broken(state, last)])

    def _timer(self, last: int) -> int:
        return (last + self.step_us) // 1000

    def _broken(self, state: str, last: int) -> tuple[str, int]:
        return (RESOLVED if state == FIRING else INACTIVE), last + self.step_us

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(key: Any, changes: list[tuple[str, int]]) -> pd.DataFrame:
        return pd.DataFrame({
            "series": [str(key[0])] * len(changes), "state": [c[0] for c in changes],
            "changed_at": pd.to_datetime([c[1] for c in changes], unit="us")})


class RepeatProcessor(StatefulProcessor):
    """Send the first alert of a group, then one per ``repeat_interval`` seconds; state: the last send."""

    def __init__(self, silence_us: int):
        self.silence_us = silence_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "sent long, timer long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, timer = self.last.get() if self.last.exists() else (None, 0)
        sent = []
        frame = _ordered(rows)
        for at, gap in zip(_micros(frame["at"]), frame["repeat_interval"].tolist()):
            if last is None or at >= last + int(gap) * 1_000_000:
                sent.append(at)
                last = at
        if not sent:
            return
        if timer:
            self.handle.deleteTimer(timer)
        timer = (last + self.silence_us) // 1000
        self.handle.registerTimer(timer)
        self.last.update((last, timer))
        yield pd.DataFrame({"group_key": [str(key[0])] * len(sent),
                            "ts": pd.to_datetime(sent, unit="us")})

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


class NoticeProcessor(StatefulProcessor):
    """The notices of a group (see ``operators.notices``), from its steps (at, n, fresh, limits).

    State of an open episode: when it opened, its last step and how many members fired
    then, its last notice, and whether there are news. A timer ends an episode whose group falls silent.
    """

    def __init__(self, step_us: int):
        self.step_us = step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "opened long, seen long, n long, last long, news boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = self.open.get() if self.open.exists() else None
        out = []
        if kept:
            self.handle.deleteTimer(self._timer(kept[1]))
        frame = _ordered(rows)
        limits = frame[list(LIMITS)].astype("int64") * SECOND
        for at, n, fresh, wait, told, repeat in zip(_micros(frame["at"]), frame["n"].tolist(), frame["fresh"].tolist(),
                                                    *(limits[c].tolist() for c in LIMITS)):
            if kept and at - kept[1] > self.step_us:
                out += self._over(kept)
                kept = None
            opened, _, _, last, news = kept or (at, at, n, None, False)
            news = news or (last is not None and fresh)
            if at >= opened + wait if last is None else at >= last + repeat or (news and at >= last + told):
                out.append((at, TOLD, n, opened))
                last, news = at, False
            kept = (opened, at, n, last, news)
        self.handle.registerTimer(self._timer(kept[1]))
        self.open.update(kept)
        if out:
            yield self._frame(key, out)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            out = self._over(self.open.get())
            self.open.clear()
            if out:
                yield self._frame(key, out)

    def _timer(self, seen: int) -> int:
        """The next step would be here by then: steps are stamped by their start, and come when they have ended."""
        return (seen + 2 * self.step_us) // 1000

    def _over(self, kept: tuple) -> list[tuple]:
        opened, seen, n, last, _ = kept
        return [(seen + self.step_us, OVER, n, opened)] if last is not None else []

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(key: Any, out: list[tuple]) -> pd.DataFrame:
        found = pd.DataFrame(out, columns=["ts", "kind", "n", "opened_at"])
        for c in ("ts", "opened_at"):
            found[c] = pd.to_datetime(found[c], unit="us")
        return found.assign(group_key=str(key[0]))[["group_key", "ts", "kind", "n", "opened_at"]]


def stream_evaluations(df: DataFrame, key: str, at: str, step: timedelta, delay: timedelta,
                       **aggs: Column) -> DataFrame:
    """Rows (key, at, ts, ...) of closed steps; ``at`` is the step's ``start`` or ``end``."""
    closed = (df.withWatermark("ts", intervals.text(delay))
              .groupBy(key, F.window("ts", intervals.text(step))).agg(*[c.alias(n) for n, c in aggs.items()]))
    return closed.select(key, F.col(f"window.{at}").alias("at"), F.window_time("window").alias("ts"), *aggs)


def stream_alert_state(samples: DataFrame, hold: timedelta, step: timedelta = timedelta(minutes=1),
                       delay: timedelta = WATERMARK) -> DataFrame:
    """State changes (series, state, changed_at) of (series, ts, active), by the newest sample of a step.

    Of samples of one time an active one counts.
    """
    newest = F.max(F.struct("ts", "active"))["active"]
    flags = stream_evaluations(samples, "series", "end", step, delay, active=newest)
    return flags.groupBy("series").transformWithStateInPandas(
        HoldProcessor(intervals.micros(hold), intervals.micros(step)),
        "series string, state string, changed_at timestamp", "Append", "EventTime")


def stream_alert_throttle(alerts: DataFrame, step: timedelta = timedelta(minutes=1),
                          longest_repeat: timedelta = timedelta(hours=1),
                          delay: timedelta = WATERMARK) -> DataFrame:
    """Sent notifications (group_key, ts) of (group_key, ts, repeat_interval), stamped by their step.

    The last send is forgotten once no repeat limit can reach that far back.
    """
    due = stream_evaluations(alerts, "group_key", "start", step, delay, repeat_interval=F.max("repeat_interval"))
    return due.groupBy("group_key").transformWithStateInPandas(
        RepeatProcessor(intervals.micros(longest_repeat)),
        "group_key string, ts timestamp", "Append", "EventTime")


def stream_notifications(firing: DataFrame, step: timedelta = timedelta(minutes=1),
                         delay: timedelta = WATERMARK) -> DataFrame:
    """Notices (group_key, ts, kind, n, opened_at) of (group_key, ts, fresh, limits), a row for each member and step.

    As in batch: the first waits, news are batched, the rest is repeated, and the end of the
    last member is told. Limits are those of a group's route, in seconds.
    """
    steps = stream_evaluations(firing, "group_key", "start", step, delay, n=F.count(F.lit(1)),
                               fresh=F.coalesce(F.bool_or("fresh"), F.lit(False)), **{c: F.max(c) for c in LIMITS})
    return steps.groupBy("group_key").transformWithStateInPandas(
        NoticeProcessor(intervals.micros(step)),
        "group_key string, ts timestamp, kind string, n long, opened_at timestamp", "Append", "EventTime")
