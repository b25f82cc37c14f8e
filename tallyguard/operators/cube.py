"""One cube of panes for many rules: gauges, counters and sums of all series from one pass.

Rows are scrapes: a series, a time, and a column for each metric, null where a scrape lacks
it. Rows of a step are combined into a pane, whose state can be merged with that of the next:
the newest value of a gauge; the first and last value of a counter and its rise between them;
sums. Trailing windows merge panes, so rows are read once however many rules look at them,
and a rule is an expression over the columns of a window.

Counters that belong together, like the buckets of a histogram, start over together: where one
of them drops, all have, and their new values are their rise.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.functions import intervals
from tallyguard.operators import timeseries


@dataclass(frozen=True)
class Metrics:
    """Which columns are gauges, which counters (grouped by what starts over together), and which expressions are summed."""

    gauges: tuple[str, ...] = ()
    counters: tuple[tuple[str, ...], ...] = ()
    sums: dict[str, Column] = field(default_factory=dict)

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.gauges, *(c for group in self.counters for c in group))


def _any(tests: list[Column]) -> Column:
    return reduce(Column.__or__, [F.coalesce(t, F.lit(False)) for t in tests])


def _stamped(pick, at: str, column: str) -> Column:
    """The row of the first or last value that isn't null, as (at, value)."""
    return pick(F.when(F.col(column).isNotNull(), F.struct(F.col(at).alias("at"), F.col(column).alias("v"))))


def _rises(group: tuple[str, ...], before, now) -> dict[str, Column]:
    """What each counter of a group rose by, from its value before to that of now."""
    reset = _any([now(c) < before(c) for c in group])
    return {c: F.when(reset, now(c)).otherwise(now(c) - before(c)) for c in group}


def panes(rows: DataFrame, step: timedelta, metrics: Metrics, keys: tuple[str, ...] = ("series",), ts: str = "ts") -> DataFrame:
    """(keys, _pane, state of every metric) of every pane that has rows.

    Rises are taken inside (series, pane) and then across panes, so a long series is many groups.
    """
    sums = {f"_s_{n}": c for n, c in metrics.sums.items()}
    cut = rows.select(*keys, F.col(ts).alias("_ts"), *metrics.columns, *[c.alias(n) for n, c in sums.items()],
                      intervals.pane(F.col(ts), step).alias("_pane"))
    before = Window.partitionBy(*keys, "_pane").orderBy("_ts").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumns({f"_b_{c}": F.last(c, ignorenulls=True).over(before) for g in metrics.counters for c in g})
    inside = {f"_i_{c}": r for g in metrics.counters for c, r in _rises(g, lambda c: F.col(f"_b_{c}"), F.col).items()}
    aggs = [_stamped(F.max, "_ts", c).alias(f"_g_{c}") for c in metrics.gauges]
    aggs += [x for g in metrics.counters for c in g for x in (
        F.coalesce(F.sum(f"_i_{c}"), F.lit(0)).alias(f"_i_{c}"),
        _stamped(F.min, "_ts", c).alias(f"_f_{c}"), _stamped(F.max, "_ts", c).alias(f"_l_{c}"))]
    aggs += [F.sum(n).alias(n) for n in sums]
    made = (cut.withColumns(inside) if inside else cut).groupBy(*keys, "_pane").agg(*aggs)
    earlier = Window.partitionBy(*keys).orderBy("_pane").rowsBetween(Window.unboundedPreceding, -1)
    made = made.withColumns({f"_b_{c}": F.last(F.col(f"_l_{c}")["v"], ignorenulls=True).over(earlier)
                             for g in metrics.counters for c in g})
    across = {f"_a_{c}": r for g in metrics.counters
              for c, r in _rises(g, lambda c: F.col(f"_b_{c}"), lambda c: F.col(f"_f_{c}")["v"]).items()}
    return made.withColumns(across).drop(*[f"_b_{c}" for g in metrics.counters for c in g]) if across else made


def windows(cube: DataFrame, step: timedelta, window: timedelta, metrics: Metrics, keys: tuple[str, ...] = ("series",)) -> DataFrame:
    """(keys, step, gauges, counters' rises, ``<counter>_seconds`` of each group's first counter, sums) at every step.

    A gauge is its newest value in the window. A rise covers the samples inside the window, and
    ``_seconds`` the time between the first and the last; with a single time both are zero.
    """
    timeseries._check(window, step)
    at = cube.select("*", timeseries._covering_steps(window, step).alias("step"))
    aggs = []
    for c in metrics.gauges:
        aggs.append(F.max(F.when(F.col(f"_g_{c}").isNotNull(), F.struct("_pane", F.col(f"_g_{c}")["v"].alias("v"))))["v"].alias(c))
    for group in metrics.counters:
        for c in group:
            rise = F.coalesce(F.col(f"_a_{c}"), F.lit(0))
            seen = F.col(f"_f_{c}").isNotNull()
            first = F.min(F.when(seen, F.struct(F.col("_pane").alias("p"), rise.alias("v"))))["v"]
            aggs.append(F.when(F.max(seen), F.sum(F.col(f"_i_{c}")) + F.sum(rise) - first).alias(c))
        a, b = F.min(F.col(f"_f_{group[0]}")["at"]), F.max(F.col(f"_l_{group[0]}")["at"])
        aggs.append(intervals.seconds_between(a, b).alias(f"{group[0]}_seconds"))
    aggs += [F.sum(f"_s_{n}").alias(n) for n in metrics.sums]
    return at.groupBy(*keys, "step").agg(*aggs)


def windowed(rows: DataFrame, step: timedelta, window: timedelta, metrics: Metrics, keys: tuple[str, ...] = ("series",),
             ts: str = "ts") -> DataFrame:
    """The trailing windows of all metrics, from one pass over the rows."""
    return windows(panes(rows, step, metrics, keys, ts), step, window, metrics, keys)


def rate(counter: str, group: str | None = None) -> Column:
    """Rise per second of a counter of a window; null without two samples of different time."""
    seconds = F.col(f"{group or counter}_seconds")
    return F.when(seconds > 0, F.col(counter) / seconds)


def share(part: str, whole: str) -> Column:
    """Percentage of one column of the whole; null where there is none of it."""
    return F.lit(100.0) * F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def bucket_quantile(columns: list[str], bounds: tuple[float, ...], q: float) -> Column:
    """Quantile of cumulative buckets that are columns, in the order of their bounds; the last one holds all.

    Linear inside the bucket that holds the rank; the unbounded one answers the highest finite bound, and an
    empty histogram nothing.
    """
    if len(columns) != len(bounds):
        raise ValueError("every bucket has one bound")
    rank, found = F.lit(q) * F.col(columns[-1]), []
    for i, (c, bound) in enumerate(zip(columns, bounds)):
        low = F.lit(bounds[i - 1] if i else 0.0)
        before = F.col(columns[i - 1]) if i else F.lit(0)
        value = low if bound == float("inf") else low + (F.lit(bound) - low) * ((rank - before) / (F.col(c) - before))
        found.append(F.when(F.col(c) >= rank, value))
    return F.when(rank > 0, F.coalesce(*found))


# --- scraped samples ------------------------------------------------------

def _label(k: str) -> Column:
    return F.coalesce(F.try_element_at("labels", F.lit(k)), F.lit(""))


def matching_labels(samples: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Samples (name, labels, value, ts) whose labels have these values; a missing label is the empty text."""
    return samples.filter(reduce(Column.__and__, [_label(k) == v for k, v in labels.items()], F.lit(True)))


def label_set(labels: Column, without: tuple[str, ...] = ()) -> Column:
    """The labels but for some, as a text that is equal for equal sets."""
    kept = F.map_filter(labels, lambda k, v: ~k.isin(*without) & (v != "")) if without else F.map_filter(labels, lambda k, v: v != "")
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept))))


def scrapes(samples: DataFrame, columns: dict[str, tuple[str, dict[str, str]]], without: tuple[str, ...] = ("le",)) -> DataFrame:
    """(series, ts, columns): the samples of one target and time as one row; a series is its labels, as JSON.

    ``columns`` says of each which metric it holds and the labels it must have, such as a bucket's
    bound; those in ``without`` don't tell series apart. Of samples that repeat a time the largest counts.
    """
    hit = lambda name, labels: reduce(Column.__and__, [_label(k) == v for k, v in labels.items()], F.col("name") == name)
    wanted = samples.filter(F.col("name").isin(sorted({n for n, _ in columns.values()})) & F.col("ts").isNotNull())
    own = wanted.select(label_set(F.col("labels"), without).alias("series"), "ts", "name", "labels", "value")
    return own.groupBy("series", "ts").agg(*[F.max(F.when(hit(*of), F.col("value"))).alias(c) for c, of in columns.items()])


def sum_by(vectors: DataFrame, columns: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Sums of window columns over the series that share ``keys``, step by step."""
    return vectors.groupBy(*keys, "step").agg(*[F.sum(c).alias(c) for c in columns])
