"""Alert rules over metric vectors: hold times, routing, grouping and repeat limits."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import timedelta
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyguard.functions import intervals
from tallyguard.operators import cube, latency, notices, timeseries
from tallyguard.session import staged

DAY = timedelta(days=1)


@dataclass(frozen=True)
class Rule:
    alertname: str
    severity: str
    alert_type: str
    op: str
    threshold: float
    hold: timedelta

    def tuned(self, **changes) -> "Rule":
        return replace(self, **changes)

    def test(self, value: Column) -> Column:
        limit = F.lit(self.threshold)
        return {">": value > limit, ">=": value >= limit, "<": value < limit, "==": value == limit}[self.op]


def _minutes(n: int) -> timedelta:
    return timedelta(minutes=n)


# Severity, type, predicate and hold of the nine rules.
HIGH_LOAD = Rule("HighLoad", "critical", "performance", ">", 80.0, _minutes(5))
MAX_REPLICAS = Rule("MaxReplicas", "warning", "scaling", ">=", 6.0, _minutes(2))
HIGH_MEMORY = Rule("HighMemory", "warning", "resources", ">", 85.0, _minutes(3))
HIGH_LATENCY = Rule("HighLatency", "warning", "performance", ">", 0.5, _minutes(2))
HIGH_ERROR_RATE = Rule("HighErrorRate", "critical", "errors", ">", 5.0, _minutes(2))
SERVICE_DOWN = Rule("ServiceDown", "critical", "availability", "==", 0.0, _minutes(1))
LOW_PREDICTION_RATE = Rule("LowPredictionRate", "warning", "business", "<", 1.0, _minutes(5))
NODE_NOT_READY = Rule("NodeNotReady", "critical", "infrastructure", "==", 0.0, _minutes(3))
CRASH_LOOP = Rule("CrashLoop", "warning", "infrastructure", ">", 5.0, _minutes(1))

# Receivers, first match wins; waits and repeat limits in seconds.
ROUTES = (
    ("severity", "critical", "critical", 0, 300),
    ("alert_type", "performance", "performance", 10, 900),
    ("alert_type", "infrastructure", "infrastructure", 10, 1800),
)
DEFAULT_ROUTE = ("default", 10, 3600)
GROUP_INTERVAL = 10  # fixed value: seconds between a notice and one with news

GROUP_KEYS = ("alertname", "cluster", "service")
SENT_KEYS = (*GROUP_KEYS, "receiver")  # each route groups and sends on its own


# --- hold times -----------------------------------------------------------

def alert_for_duration(flags: DataFrame, hold: timedelta | str, step: timedelta,
                       keys: tuple[str, ...] = ("series",), segment: timedelta = DAY) -> DataFrame:
    """Per evaluation (keys, ts, active): since when the predicate holds, and whether it fires.

    ``hold`` is a span, or the name of an interval column where rules differ.

    An inactive evaluation, or none for longer than ``step``, breaks the hold.
    Runs are found inside (series, segment); a run that crosses segments takes
    its start from a per-segment summary, so no series is scanned as a whole.
    """
    every = intervals.literal(step)
    rows = flags.withColumn("_seg", intervals.pane(F.col("ts"), segment))
    inside = Window.partitionBy(*keys, "_seg").orderBy("ts")
    before_ts, before = F.lag("ts").over(inside), F.lag("active").over(inside)
    goes_on = F.coalesce(before & (F.col("ts") <= before_ts + every), F.lit(False))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (rows.withColumn("_mark", F.when(F.col("active") & ~goes_on, F.col("ts")))
            .withColumn("_start", F.when(F.col("active"), F.last("_mark", ignorenulls=True).over(so_far)))
            .withColumn("_head", F.first("ts").over(so_far)))

    ends = rows.groupBy(*keys, "_seg").agg(
        F.min("ts").alias("_first"), F.max("ts").alias("_last"),
        F.min_by("active", F.struct("ts", "active")).alias("_opens"),
        F.max_by("active", F.struct("ts", "active")).alias("_closes"),
        F.max_by("_start", F.struct("ts", "active")).alias("_run"))
    by_seg = Window.partitionBy(*keys).orderBy("_seg")
    joins_on = F.coalesce(F.col("_opens") & F.lag("_closes").over(by_seg)
                          & (F.col("_first") <= F.lag("_last").over(by_seg) + every), F.lit(False))
    carried = (ends.withColumn("_joins", joins_on)
               .withColumn("_anchor", F.when(F.col("_closes") & ~(F.col("_joins") & (F.col("_run") == F.col("_first"))),
                                             F.col("_run")))
               .withColumn("_carry", F.when(F.col("_joins"), F.last("_anchor", ignorenulls=True).over(
                   by_seg.rowsBetween(Window.unboundedPreceding, -1))))
               .select(*keys, "_seg", "_carry"))

    since = F.when(F.col("_start") == F.col("_head"),
                   F.coalesce(F.col("_carry"), F.col("_start"))).otherwise(F.col("_start"))
    carried = carried.select(*[F.col(k).alias(f"_{k}_") for k in [*keys, "_seg"]], "_carry")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}_")) for k in [*keys, "_seg"]])
    done = (rows.join(carried, same).withColumn("pending_since", since)
            .drop(*[f"_{k}_" for k in [*keys, "_seg"]]))
    held = F.col(hold) if isinstance(hold, str) else intervals.literal(hold)
    firing = F.coalesce(F.col("ts") >= F.col("pending_since") + held, F.lit(False))
    return done.withColumn("firing", firing).drop("_seg", "_mark", "_start", "_head", "_carry")


def alert_lifecycle(flags: DataFrame, hold: timedelta, step: timedelta,
                    keys: tuple[str, ...] = ("series",)) -> DataFrame:
    """One row per firing run: start, end and whether it is over.

    The end is the first evaluation at which the run no longer holds; a run
    reaching the last evaluation of all series is still open.
    """
    held = alert_for_duration(flags, hold, step, keys)
    last_step = flags.agg(F.max("ts")).scalar()
    runs = (held.filter("active").groupBy(*keys, "pending_since")
            .agg(F.min(F.when(F.col("firing"), F.col("ts"))).alias("starts_at"),
                 F.max("ts").alias("_last")))
    over = F.col("_last") < last_step
    return (runs.filter("starts_at is not null")
            .select(*keys, "starts_at",
                    F.when(over, F.col("_last") + intervals.literal(step)).alias("ends_at"),
                    over.alias("resolved")))


# --- rules ----------------------------------------------------------------

def rule_flags(flags: DataFrame, rule: Rule) -> DataFrame:
    """Stamp (series, ts, active, value) with a rule, so that flags of many rules can be stacked."""
    return flags.select(
        F.lit(rule.alertname).alias("alertname"), F.lit(rule.severity).alias("severity"),
        F.lit(rule.alert_type).alias("alert_type"), F.col("series").cast("string").alias("series"),
        "ts", "active", F.col("value").cast("double").alias("value"), intervals.literal(rule.hold).alias("hold"))


def threshold_flags(vector: DataFrame, rule: Rule) -> DataFrame:
    """Judge a vector of (series, step, value)."""
    active = rule.test(F.col("value").cast("double"))
    return rule_flags(vector.select("series", F.col("step").alias("ts"), active.alias("active"), "value"), rule)


def flags_on_windows(windows: DataFrame, rules: list[tuple[Rule, Column, Column | None]]) -> DataFrame:
    """The flags of many rules on the windows of a cube, in one pass: (rule, its value, what must hold beside its limit).

    A value that is null is no evaluation.
    """
    judged = []
    for rule, value, beside in rules:
        value = value.cast("double")
        active = rule.test(value) if beside is None else rule.test(value) & F.coalesce(beside, F.lit(False))
        judged.append(F.struct(
            F.lit(rule.alertname).alias("alertname"), F.lit(rule.severity).alias("severity"),
            F.lit(rule.alert_type).alias("alert_type"), F.col("series").cast("string").alias("series"), F.col("step").alias("ts"),
            active.alias("active"), value.alias("value"), intervals.literal(rule.hold).alias("hold")))
    return windows.select(F.inline(F.array(*judged))).filter("value is not null")


def flags_on_scrapes(rows: DataFrame, step: timedelta, buckets: list[str], bounds: tuple[float, ...],
                     window: timedelta = timeseries.FIVE_MINUTES, total: str = "total", errors: str = "errors",
                     rules: tuple[Rule, Rule, Rule] | None = None, q: float = 0.95) -> DataFrame:
    """Latency, error share and request rate of scraped counters (see ``cube.scrapes``), judged in one pass.

    ``buckets`` are the histogram's columns in the order of their ``bounds``. All need two samples of different
    time in the window, and a share or a quantile needs a rise.
    """
    metrics = cube.Metrics(counters=((total,), (errors,), tuple(buckets)))
    windows = cube.windowed(rows, step, window, metrics)
    return flags_on_windows(windows, scraped_rules(buckets, bounds, total, errors, rules, q))


def scraped_rules(buckets: list[str], bounds: tuple[float, ...], total: str = "total", errors: str = "errors",
                  rules: tuple[Rule, Rule, Rule] | None = None, q: float = 0.95) -> list[tuple[Rule, Column, Column | None]]:
    """The rules on latency, error share and request rate, over the windows of a cube."""
    latency_rule, error_rule, rate_rule = rules or (HIGH_LATENCY, HIGH_ERROR_RATE, LOW_PREDICTION_RATE)
    timed = lambda group, value: F.when(F.col(f"{group}_seconds") > 0, value)
    return [(latency_rule, timed(buckets[0], cube.bucket_quantile(buckets, bounds, q)), None),
            (error_rule, timed(total, cube.share(errors, total)), None), (rate_rule, cube.rate(total), None)]


def evaluate_rules(flags: DataFrame, step: timedelta) -> DataFrame:
    """First firing evaluation of every run, for the stacked flags of any number of rules at once."""
    held = alert_for_duration(flags, "hold", step, ("alertname", "series"))
    return (held.filter("firing").groupBy("alertname", "severity", "alert_type", "series", "pending_since")
            .agg(F.min("ts").alias("starts_at"), F.min_by("value", "ts").alias("value"))
            .select("alertname", "severity", "alert_type", "series", "starts_at", "value"))


def union_rules(flags: list[DataFrame]) -> DataFrame:
    """Stack the flags of several rules: their holds are then found in one pass."""
    return reduce(DataFrame.unionByName, flags)


def firing_evaluations(flags: DataFrame, step: timedelta) -> DataFrame:
    """Every firing evaluation (alertname, severity, alert_type, series, ts, value, fresh) of stacked flags.

    The first of a run is ``fresh``. Flags come every ``step``.
    """
    first = F.col("ts") < F.col("pending_since") + F.col("hold") + intervals.literal(step)
    return alert_for_duration(flags, "hold", step, ("alertname", "series")).filter("firing").select(
        "alertname", "severity", "alert_type", "series", "ts", "value", first.alias("fresh"))


def notifications(flags: DataFrame, step: timedelta, labels: dict[str, Column],
                  segment: timedelta = 7 * DAY) -> DataFrame:
    """The whole chain: held flags of all rules, routed, grouped, and what is sent of each group.

    ``labels`` are the cluster and service of a firing series. A row is one notice of a
    group (alertname, cluster, service, receiver) at ``ts``, of ``kind`` firing or resolved
    (see ``notices``). A group that fires at the last evaluation of all is still open. The
    flags are written once, for the hold and for that last evaluation.
    """
    flags = staged(flags, "flags")
    firing = alert_routing(firing_evaluations(flags, step).withColumns(labels))
    last = flags.agg(F.max("ts")).scalar()
    return notices.group_notices(firing, SENT_KEYS, step, last, segment)


# Every rule comes as flags, to be stacked, and as ``alert_*``, its own evaluation.

def flags_highload(cpu: DataFrame, up_counts: DataFrame, rule: Rule = HIGH_LOAD,
                   min_instances: int = 6) -> DataFrame:
    joined = timeseries.highload_join(cpu, up_counts, rule.threshold, min_instances)
    return rule_flags(joined.select("series", F.col("step").alias("ts"), "active", F.col("cpu").alias("value")), rule)


def flags_on_latest(samples: DataFrame, step: timedelta, rule: Rule,
                    lookback: timedelta = timeseries.FIVE_MINUTES) -> DataFrame:
    """Rules on the newest value of a gauge."""
    return threshold_flags(timeseries.latest_sample(samples, step, lookback), rule)


def flags_on_samples(samples: DataFrame, step: timedelta, rules: dict[str, Rule],
                     lookback: timedelta = timeseries.FIVE_MINUTES) -> DataFrame:
    """Rules on the newest values of the gauges of one table (name, series, ts, value), by gauge name, in one pass.

    A name has one rule; samples of other names take no part.
    """
    newest = timeseries.latest_sample(samples.filter(F.col("name").isin(list(rules))), step, lookback, ("name", "series"))

    def by_name(of) -> Column:
        out = F.lit(None)
        for name, rule in rules.items():
            out = F.when(F.col("name") == name, of(rule)).otherwise(out)
        return out

    value = F.col("value").cast("double")
    tests = {">": value.__gt__, ">=": value.__ge__, "<": value.__lt__, "==": value.__eq__}
    return newest.select(
        by_name(lambda r: F.lit(r.alertname)).alias("alertname"), by_name(lambda r: F.lit(r.severity)).alias("severity"),
        by_name(lambda r: F.lit(r.alert_type)).alias("alert_type"), F.col("series").cast("string").alias("series"),
        F.col("step").alias("ts"), by_name(lambda r: tests[r.op](F.lit(r.threshold))).alias("active"),
        value.alias("value"), by_name(lambda r: intervals.literal(r.hold)).alias("hold"))


def flags_high_memory(used: DataFrame, limits: DataFrame, step: timedelta,
                      lookback: timedelta = timeseries.FIVE_MINUTES, rule: Rule = HIGH_MEMORY) -> DataFrame:
    return threshold_flags(timeseries.pod_memory_percent(used, limits, step, lookback), rule)


def latency_quantile_over_time(df: DataFrame, step: timedelta, window: timedelta, q: float,
                               bounds: tuple[float, ...] = latency.DEFAULT_BOUNDS) -> DataFrame:
    """Histogram quantile of (series, ts, seconds) over the trailing window at every step."""
    counts = {f"b{i}": F.count_if(F.col("seconds") <= F.lit(b)) for i, b in enumerate(bounds)}
    wide = timeseries.trailing(df, counts, window, step, ("series",))
    pairs = [x for i, b in enumerate(bounds) for x in (F.lit(float(b)), F.col(f"b{i}"))]
    buckets = wide.select("series", "step", F.stack(F.lit(len(bounds)), *pairs).alias("le", "cumulative"))
    return latency.histogram_quantile(buckets, q, ("series", "step"))


def flags_high_latency(df: DataFrame, step: timedelta, window: timedelta = timeseries.FIVE_MINUTES,
                       rule: Rule = HIGH_LATENCY, q: float = 0.95) -> DataFrame:
    return threshold_flags(latency_quantile_over_time(df, step, window, q), rule)


def flags_high_error_rate(df: DataFrame, step: timedelta, window: timedelta = timeseries.FIVE_MINUTES,
                          rule: Rule = HIGH_ERROR_RATE) -> DataFrame:
    rates = timeseries.error_rate(df, step, window, ("series",))
    return threshold_flags(rates.withColumnRenamed("error_rate_pct", "value"), rule)


def flags_low_prediction_rate(df: DataFrame, step: timedelta, window: timedelta = timeseries.FIVE_MINUTES,
                              rule: Rule = LOW_PREDICTION_RATE) -> DataFrame:
    """A series without samples gives no value, so it can't be low."""
    rates = timeseries.request_rate(df, step, window, ("series",))
    return threshold_flags(rates.withColumnRenamed("rate", "value"), rule)


def alert_highload(cpu: DataFrame, up_counts: DataFrame, step: timedelta, rule: Rule = HIGH_LOAD,
                   min_instances: int = 6) -> DataFrame:
    return evaluate_rules(flags_highload(cpu, up_counts, rule, min_instances), step)


def _alert_on_latest(rule: Rule):
    def alert(samples: DataFrame, step: timedelta, lookback: timedelta = timeseries.FIVE_MINUTES,
              rule: Rule = rule) -> DataFrame:
        return evaluate_rules(flags_on_latest(samples, step, rule, lookback), step)

    alert.__doc__ = f"{rule.alertname}: latest gauge value {rule.op} {rule.threshold}, held."
    return alert


alert_max_replicas = _alert_on_latest(MAX_REPLICAS)
alert_service_down = _alert_on_latest(SERVICE_DOWN)
alert_node_not_ready = _alert_on_latest(NODE_NOT_READY)
alert_crash_loop = _alert_on_latest(CRASH_LOOP)


def alert_high_memory(used: DataFrame, limits: DataFrame, step: timedelta,
                      lookback: timedelta = timeseries.FIVE_MINUTES, rule: Rule = HIGH_MEMORY) -> DataFrame:
    return evaluate_rules(flags_high_memory(used, limits, step, lookback, rule), step)


def alert_high_latency(df: DataFrame, step: timedelta, window: timedelta = timeseries.FIVE_MINUTES,
                       rule: Rule = HIGH_LATENCY) -> DataFrame:
    return evaluate_rules(flags_high_latency(df, step, window, rule), step)


def alert_high_error_rate(df: DataFrame, step: timedelta, window: timedelta = timeseries.FIVE_MINUTES,
                          rule: Rule = HIGH_ERROR_RATE) -> DataFrame:
    return evaluate_rules(flags_high_error_rate(df, step, window, rule), step)


def alert_low_prediction_rate(df: DataFrame, step: timedelta, window: timedelta = timeseries.FIVE_MINUTES,
                              rule: Rule = LOW_PREDICTION_RATE) -> DataFrame:
    return evaluate_rules(flags_low_prediction_rate(df, step, window, rule), step)


# --- notification ---------------------------------------------------------

def alert_routing(alerts: DataFrame) -> DataFrame:
    """Add receiver, group wait, group interval and repeat interval (seconds)."""
    receiver, wait, repeat = (F.lit(x) for x in DEFAULT_ROUTE)
    for col, value, name, wait_s, repeat_s in reversed(ROUTES):
        match = F.col(col) == value
        receiver = F.when(match, name).otherwise(receiver)
        wait = F.when(match, wait_s).otherwise(wait)
        repeat = F.when(match, repeat_s).otherwise(repeat)
    return alerts.withColumns({"receiver": receiver, "group_wait": wait, "group_interval": F.lit(GROUP_INTERVAL),
                               "repeat_interval": repeat})


def alert_grouping(alerts: DataFrame, keys: tuple[str, ...] = GROUP_KEYS) -> DataFrame:
    """Size, first start and breadth of every notification group.

    The members stay rows of ``alerts`` under the same keys: a group has no
    bounded size, so it is never folded into one array.
    """
    return alerts.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min("starts_at").alias("starts_at"),
        F.max("starts_at").alias("latest_start"))


def alert_repeat_throttle(firing: DataFrame, keys: tuple[str, ...] = SENT_KEYS, ts: str = "ts",
                          repeat: str = "repeat_interval", segment: timedelta = 7 * DAY,
                          step: timedelta = timedelta(seconds=15)) -> DataFrame:
    """The notifications really sent: each at least ``repeat`` seconds after the last of its group.

    A group is what shares ``keys`` and a repeat limit: alerts with another limit are sent
    by another route. Times count by the ``step`` they fall into.

    Every send depends on the one before, but a segment only needs to know the
    last send before it. So: (1) per segment, from each row that could be the
    first send, find the last one; (2) per group, chain these few rows through
    its segments; (3) per segment, walk from the known last send. Rows of one
    step are combined first, on the map side, so a segment holds no more rows
    than steps: 40,320 in a week of 15-second steps. Nulls in keys are a group.
    """
    group = [*keys, "_gap"]
    rows = (firing.select(*keys, F.col(repeat).alias("_gap"), intervals.pane(F.col(ts), step).alias("ts")).distinct()
            .withColumn("_seg", intervals.pane(F.col("ts"), segment)))
    fields = {f.name: f for f in rows.schema.fields}
    key_fields = [fields[k] for k in group]
    stamp = fields["ts"].dataType

    def first_at(times: np.ndarray, last, gap) -> int:
        return 0 if pd.isna(last) else int(np.searchsorted(times, last + gap))

    def spans(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts", ignore_index=True)
        times, gap = pdf["ts"].to_numpy(), np.timedelta64(int(pdf["_gap"].max()), "s")
        after = np.searchsorted(times, times + gap)
        last, own = None, np.arange(len(times))
        ahead = np.where(after < len(times), after, own)
        while last is None or not np.array_equal(last, ahead):  # doubles the reach each round
            last, ahead = ahead, ahead[ahead]
        reach = np.searchsorted(times, pdf["_seg"].to_numpy()[0] + gap) + 1
        return pdf.head(reach).assign(_exit=times[last[:reach]])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_seg", "ts"], ignore_index=True)
        heads, last = [], np.datetime64("NaT", "ns")
        for _, part in pdf.groupby("_seg", sort=True):
            heads.append((part.index[0], last))
            at = first_at(part["ts"].to_numpy(), last, np.timedelta64(int(part["_gap"].max()), "s"))
            if at < len(part):
                last = part["_exit"].to_numpy()[at]
        carried = pdf.loc[[i for i, _ in heads], [*group, "_seg"]]
        return carried.assign(_carry=pd.Series([c for _, c in heads], index=carried.index,
                                               dtype=pdf["ts"].dtype))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts", ignore_index=True)
        times, gap = pdf["ts"].to_numpy(), np.timedelta64(int(pdf["_gap"].max()), "s")
        sent, at = [], first_at(times, pdf["_carry"].to_numpy()[0], gap)
        while at < len(times):
            sent.append(at)
            at = int(np.searchsorted(times, times[at] + gap))
        return pdf.loc[sent, [*group, "ts"]]

    exits = rows.groupBy(*group, "_seg").applyInPandas(
        spans, T.StructType(rows.schema.fields + [T.StructField("_exit", stamp)]))
    carries = exits.groupBy(*group).applyInPandas(
        chain, T.StructType(key_fields + [fields["_seg"], T.StructField("_carry", stamp)]))
    carries = carries.select(*[F.col(k).alias(f"_{k}_") for k in [*group, "_seg"]], "_carry")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}_")) for k in [*group, "_seg"]])
    carried = rows.join(carries, same).drop(*[f"_{k}_" for k in [*group, "_seg"]])
    return carried.groupBy(*group, "_seg").applyInPandas(
        walk, T.StructType(key_fields + [fields["ts"]])).drop("_gap")
