"""Notices of alert groups: wait, batching, repeats and resolution.

A group (its keys and limits) is looked at once a step, where at least one member fires.
Steps that follow each other are an episode: it opens with the first member, goes on
while any member fires, and ends one step after the last. A group that fires again opens
a new one. In an episode

- the first notice is sent at the first step that is ``group_wait`` seconds after the opening
  or later, and tells all members that fire then; one that ends before sends nothing;
- after that, news (members that began to fire since) are sent ``group_interval`` seconds after
  the last notice or later, and without news the notice is repeated after ``repeat_interval``;
- ``resolved`` is sent at the end, if anything was sent before.

A notice depends on the one before it, but a segment of time only needs to know how the
last one ended. An episode that covers a whole segment maps the last notice before it to
its own last one; this map has as many rows as steps in the longest limit. The maps of a
group are chained in a few rows, and then every segment is walked on its own.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyguard.functions import intervals

LIMITS = ("group_wait", "group_interval", "repeat_interval")
FIRING, RESOLVED = "firing", "resolved"
NEVER = np.iinfo(np.int64).max
SECOND = 1_000_000


class Limits:
    """Wait, news and repeat limits of a group, in microseconds."""

    def __init__(self, wait: int, news: int, repeat: int):
        if min(news, repeat) <= 0:
            raise ValueError("group and repeat intervals must be positive")
        self.wait, self.news, self.repeat = int(wait) * SECOND, int(news) * SECOND, int(repeat) * SECOND

    def next_after(self, times: np.ndarray, last, first_news) -> np.ndarray:
        """The place of the notice after one at ``last``, when the first news since is at ``first_news``."""
        told = np.maximum(first_news, np.minimum(last, NEVER - self.news) + self.news)
        return np.minimum(np.searchsorted(times, last + self.repeat), np.searchsorted(times, told))


class Episode:
    """How far an open episode has come: when it opened, its last notice (or none), and whether there are news since."""

    def __init__(self, opened: int, last: int | None = None, news: bool = False):
        self.opened, self.last, self.news = opened, last, news

    def walk(self, times: np.ndarray, fresh: np.ndarray, limits: Limits) -> list[int]:
        """Go on over more steps of the episode; the places of those at which a notice is sent."""
        sent, news = [], times[fresh]
        while True:
            if self.last is None:
                at = int(np.searchsorted(times, self.opened + limits.wait))
            else:
                k = int(np.searchsorted(news, self.last, side="right"))
                first = self.last if self.news else news[k] if k < len(news) else NEVER
                at = int(limits.next_after(times, self.last, first))
            if at >= len(times):
                break
            sent.append(at)
            self.last, self.news = int(times[at]), False
        if self.last is not None:
            self.news = self.news or bool((news > self.last).any())
        return sent


def _micros(column: pd.Series) -> np.ndarray:
    return column.astype("datetime64[us]").astype("int64").to_numpy()


def _starts(times: np.ndarray, step: int) -> np.ndarray:
    """Places where an episode starts, the first one among them."""
    return np.flatnonzero(np.concatenate(([True], np.diff(times) > step)))


def group_notices(firing: DataFrame, keys: tuple[str, ...], step: timedelta, until: Column | None = None,
                  segment: timedelta = timedelta(days=7), ts: str = "ts", fresh: str = "fresh") -> DataFrame:
    """(keys, ts, kind, n, opened_at) of every notice of ``firing``, in rows of one member and step.

    ``firing`` has the keys, the time, the limits in seconds, and ``fresh``: whether the member began
    to fire at this step. ``n`` is the number of members that fired at the notice's step, of a
    resolution the number at the last step. An episode that reaches ``until``, the last step that
    was evaluated, is open and has no resolution yet; without it, all that ends is resolved.
    Rows of one step are combined before they are shuffled; nulls in keys are a group.
    """
    group, width = [*keys, *LIMITS], intervals.micros(step)
    rows = (firing.groupBy(*group, intervals.pane(F.col(ts), step).alias("ts"))
            .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_or(fresh), F.lit(False)).alias("fresh"))
            .withColumn("_seg", intervals.pane(F.col("ts"), segment)))
    fields = {f.name: f for f in rows.schema.fields}
    own = [fields[k] for k in group]
    state = T.StructType([T.StructField(n, t) for n, t in (
        ("_opened", T.LongType()), ("_last", T.LongType()), ("_news", T.BooleanType()))])

    def limits_of(pdf: pd.DataFrame) -> Limits:
        return Limits(*(pdf[c].iloc[0] for c in LIMITS))

    def maps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts", ignore_index=True)
        times, news, limits = _micros(pdf["ts"]), pdf["fresh"].to_numpy(bool), limits_of(pdf)
        starts = _starts(times, width)
        tail = Episode(int(times[starts[-1]]))
        tail.walk(times[starts[-1]:], news[starts[-1]:], limits)
        out = {"_first": times[0], "_end": times[-1], "_fresh": times[news][0] if news.any() else NEVER, "_opened": tail.opened,
               "_last": tail.last, "_news": tail.news, "_at": [], "_to": [], "_left": []}
        if len(starts) == 1:  # an episode may come in and go on: where would each first notice lead?
            told = times[news]
            k = np.searchsorted(told, times, side="right")
            after = limits.next_after(times, times, np.append(told, NEVER)[k])
            ahead, here = np.where(after < len(times), after, np.arange(len(times))), None
            while here is None or not np.array_equal(here, ahead):  # doubles the reach each round
                here, ahead = ahead, ahead[ahead]
            reach = np.searchsorted(times, _micros(pdf["_seg"])[0] + max(limits.repeat, limits.wait)) + 1
            last = times[here[:reach]]
            out |= {"_at": times[:reach].tolist(), "_to": last.tolist(), "_left": ((told[-1] if len(told) else -NEVER) > last).tolist()}
        return pd.DataFrame([{**pdf.loc[0, [*group, "_seg"]], **out}])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_seg", ignore_index=True)
        limits, now, end, carried = limits_of(pdf), None, None, []
        for _, seg in pdf.iterrows():
            goes_on = now is not None and seg["_first"] - end <= width
            carried.append((now.opened, now.last, now.news) if goes_on else (None, None, None))
            if goes_on and len(seg["_at"]):
                at = np.asarray(seg["_at"])
                if now.last is None:
                    i = int(np.searchsorted(at, now.opened + limits.wait))
                else:
                    i = int(limits.next_after(at, now.last, now.last if now.news else seg["_fresh"]))
                if i < len(at):
                    now = Episode(now.opened, int(seg["_to"][i]), bool(seg["_left"][i]))
                elif now.last is not None:
                    now = Episode(now.opened, now.last, now.news or seg["_fresh"] < NEVER)
            else:
                now = Episode(int(seg["_opened"]), None if pd.isna(seg["_last"]) else int(seg["_last"]), bool(seg["_news"]))
            end = seg["_end"]
        out = pdf[[*group, "_seg"]].copy()
        for i, name in enumerate(("_opened", "_last")):
            out[name] = pd.Series([c[i] for c in carried], dtype="Int64")
        out["_news"] = pd.Series([c[2] for c in carried], dtype="boolean")
        out["_next"] = pdf["_first"].shift(-1).astype("Int64")
        return out

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts", ignore_index=True)
        times, news, n, limits = _micros(pdf["ts"]), pdf["fresh"].to_numpy(bool), pdf["n"].to_numpy(), limits_of(pdf)
        begun, out = pdf.loc[0, ["_opened", "_last", "_news", "_next"]], []
        starts = _starts(times, width)
        for i, a in enumerate(starts):
            b = starts[i + 1] if i + 1 < len(starts) else len(times)
            episode = Episode(int(times[a]))
            if i == 0 and not pd.isna(begun["_opened"]):
                episode = Episode(int(begun["_opened"]), None if pd.isna(begun["_last"]) else int(begun["_last"]), bool(begun["_news"]))
            out += [(times[a + at], FIRING, n[a + at], episode.opened) for at in episode.walk(times[a:b], news[a:b], limits)]
            goes_on = b == len(times) and not pd.isna(begun["_next"]) and begun["_next"] - times[-1] <= width
            if not goes_on and episode.last is not None:
                out.append((times[b - 1] + width, RESOLVED, n[b - 1], episode.opened))
        found = pd.DataFrame(out, columns=["ts", "kind", "n", "opened_at"])
        for c in ("ts", "opened_at"):
            found[c] = pd.to_datetime(found[c].astype("int64"), unit="us")
        for c in keys:
            found[c] = pdf[c].iloc[0]
        return found[[*keys, "ts", "kind", "n", "opened_at"]]

    longs = T.ArrayType(T.LongType())
    mapped = rows.groupBy(*group, "_seg").applyInPandas(maps, T.StructType(
        [*own, fields["_seg"], *[T.StructField(c, T.LongType()) for c in ("_first", "_end", "_fresh")], *state.fields,
         T.StructField("_at", longs), T.StructField("_to", longs), T.StructField("_left", T.ArrayType(T.BooleanType()))]))
    carries = mapped.groupBy(*group).applyInPandas(
        chain, T.StructType([*own, fields["_seg"], *state.fields, T.StructField("_next", T.LongType())]))
    carries = carries.select(*[F.col(k).alias(f"_{k}_") for k in [*group, "_seg"]], *state.names, "_next")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}_")) for k in [*group, "_seg"]])
    stamp = fields["ts"].dataType
    notices = rows.join(carries, same).drop(*[f"_{k}_" for k in [*group, "_seg"]]).groupBy(*group, "_seg").applyInPandas(
        walk, T.StructType([fields[k] for k in keys] + [T.StructField("ts", stamp), T.StructField("kind", T.StringType()),
                                                        T.StructField("n", T.LongType()), T.StructField("opened_at", stamp)]))
    return notices if until is None else notices.filter((F.col("kind") == FIRING) | (F.col("ts") <= until))
