"""Metric windows on an evaluation step.

Every trailing window is built from panes one step wide: rows are combined into
panes first, and only panes are copied into the windows that cover them. An
evaluation at ``step`` covers ``(step - window, step]`` in whole panes, and a
series without rows there gives no row.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.functions import intervals

FIVE_MINUTES = timedelta(minutes=5)  # fixed value: the trailing window of all rates


def _check(window: timedelta, step: timedelta) -> None:
    if window % step:
        raise ValueError("the window must be a whole number of steps")


def _covering_steps(window: timedelta, step: timedelta, start: str = "_pane") -> Column:
    """The evaluations whose window covers the pane that starts at ``start``."""
    first = F.col(start) + intervals.literal(step)
    if window == step:
        return first
    return F.explode(F.sequence(first, F.col(start) + intervals.literal(window),
                                intervals.literal(step)))


def trailing(df: DataFrame, sums: dict[str, Column], window: timedelta, step: timedelta,
             keys: tuple[str, ...] = (), ts: str = "ts") -> DataFrame:
    """Aggregate ``sums`` (counts or sums of a row) over the trailing window at every step."""
    _check(window, step)
    panes = (df.groupBy(*keys, intervals.pane(F.col(ts), step).alias("_pane"))
             .agg(*[c.alias(name) for name, c in sums.items()]))
    at_steps = panes.select(*keys, *sums, _covering_steps(window, step).alias("step"))
    if window == step:
        return at_steps
    return at_steps.groupBy(*keys, "step").agg(*[F.sum(n).alias(n) for n in sums])


def request_rate(df: DataFrame, step: timedelta, window: timedelta = FIVE_MINUTES,
                 keys: tuple[str, ...] = (), ts: str = "ts") -> DataFrame:
    """Events per second over the trailing window."""
    counted = trailing(df, {"_n": F.count("*")}, window, step, keys, ts)
    return counted.select(*keys, "step", (F.col("_n") / F.lit(window.total_seconds())).alias("rate"))


def share_over_time(df: DataFrame, flag: Column, name: str, step: timedelta,
                    window: timedelta = FIVE_MINUTES, keys: tuple[str, ...] = (),
                    ts: str = "ts") -> DataFrame:
    """Percentage of rows with ``flag`` over the trailing window."""
    counted = trailing(df, {"_hit": F.count_if(flag), "_n": F.count("*")}, window, step, keys, ts)
    return counted.select(*keys, "step", (F.lit(100.0) * F.col("_hit") / F.col("_n")).alias(name))


def error_rate(df: DataFrame, step: timedelta, window: timedelta = FIVE_MINUTES,
               keys: tuple[str, ...] = ()) -> DataFrame:
    """Errors per attempt, in percent."""
    return share_over_time(df, F.col("is_error"), "error_rate_pct", step, window, keys)


def fraud_rate_over_time(df: DataFrame, step: timedelta, window: timedelta = FIVE_MINUTES) -> DataFrame:
    return share_over_time(df, F.col("is_fraud_predicted"), "fraud_pct", step, window)


def counter_rate(samples: DataFrame, step: timedelta, window: timedelta = FIVE_MINUTES,
                 keys: tuple[str, ...] = ("series",), ts: str = "ts", value: str = "value") -> DataFrame:
    """Rise per second of a monotone counter; a drop is a reset and adds the new value.

    Rises are taken inside (series, pane), so a long series is many groups; rises
    across panes come from the panes' first and last samples. The rise into the
    first pane of a window lies outside the window. Needs two samples of
    different time; one sample per (series, time).
    """
    _check(window, step)

    def rise(now: Column, before: Column) -> Column:
        return F.when(now < before, now).otherwise(now - before)

    rows = samples.select(*keys, F.col(ts).alias("_ts"), F.col(value).alias("_v"),
                          intervals.pane(F.col(ts), step).alias("_pane"))
    in_pane = Window.partitionBy(*keys, "_pane").orderBy("_ts", "_v")
    panes = (rows.withColumn("_rise", rise(F.col("_v"), F.lag("_v").over(in_pane)))
             .groupBy(*keys, "_pane")
             .agg(F.coalesce(F.sum("_rise"), F.lit(0)).alias("_inside"),
                  F.min("_ts").alias("_from"), F.max("_ts").alias("_to"),
                  F.min(F.struct("_ts", "_v"))["_v"].alias("_open"), F.max(F.struct("_ts", "_v"))["_v"].alias("_close")))
    by_pane = Window.partitionBy(*keys).orderBy("_pane")
    panes = panes.withColumn(
        "_across", F.coalesce(rise(F.col("_open"), F.lag("_close").over(by_pane)), F.lit(0)))
    at_steps = panes.select("*", _covering_steps(window, step).alias("step"))
    rates = at_steps.groupBy(*keys, "step").agg(
        (F.sum("_inside") + F.sum("_across") - F.min_by("_across", "_pane")).alias("_rise"),
        F.min("_from").alias("_from"), F.max("_to").alias("_to"))
    span = intervals.seconds_between(F.col("_from"), F.col("_to"))
    return (rates.filter(F.col("_to") > F.col("_from"))
            .select(*keys, "step", (F.col("_rise") / span).alias("rate")))


def latest_sample(samples: DataFrame, step: timedelta, lookback: timedelta = FIVE_MINUTES,
                  keys: tuple[str, ...] = ("series",), ts: str = "ts", value: str = "value") -> DataFrame:
    """The newest value of each series at every step, at most ``lookback`` old; of one time, the largest."""
    _check(lookback, step)
    panes = (samples.groupBy(*keys, intervals.pane(F.col(ts), step).alias("_pane"))
             .agg(F.max(F.struct(F.col(ts).alias("t"), F.col(value).alias("v")))["v"].alias("value")))
    at_steps = panes.select(*keys, "_pane", "value", _covering_steps(lookback, step).alias("step"))
    if lookback == step:
        return at_steps.drop("_pane")
    return at_steps.groupBy(*keys, "step").agg(F.max_by("value", "_pane").alias("value"))


def vector_ratio(left: DataFrame, right: DataFrame, keys: tuple[str, ...], scale: float = 100.0) -> DataFrame:
    """Divide two metric vectors where their labels are equal."""
    a = left.select(*keys, F.col("value").alias("_left"))
    b = right.select(*keys, F.col("value").alias("_right"))
    ratio = F.lit(scale) * F.try_divide(F.col("_left").cast("double"), F.col("_right").cast("double"))
    return a.join(b, list(keys)).select(*keys, ratio.alias("value"))


def pod_cpu_percent(samples: DataFrame, step: timedelta, window: timedelta = FIVE_MINUTES) -> DataFrame:
    """Percent of one core per series, from a counter of cpu seconds."""
    rates = counter_rate(samples, step, window)
    return rates.select("series", "step", (F.col("rate") * F.lit(100.0)).alias("value"))


def pod_memory_percent(used: DataFrame, limits: DataFrame, step: timedelta,
                       lookback: timedelta = FIVE_MINUTES) -> DataFrame:
    return vector_ratio(latest_sample(used, step, lookback), latest_sample(limits, step, lookback),
                        ("series", "step"))


def instances_up(up: DataFrame) -> DataFrame:
    """Targets up and down at every step, from the latest ``up`` value of each."""
    return up.groupBy("step").agg(F.count_if(F.col("value") == 1).alias("up_count"),
                                  F.count_if(F.col("value") != 1).alias("down_count"))


def rate_per_instance(rates: DataFrame, up_counts: DataFrame) -> DataFrame:
    """(step, value): the rate of all requests over the instances up at the same step; none up gives no row."""
    both = rates.join(up_counts.select("step", "up_count"), "step")
    return both.filter("up_count > 0").select("step", (F.col("rate") / F.col("up_count")).alias("value"))


def instances_down(up: DataFrame) -> DataFrame:
    """The down list, one row per (step, series)."""
    return up.filter(F.col("value") != 1).select("step", "series")


def highload_join(cpu: DataFrame, up_counts: DataFrame, cpu_limit: float = 80.0,
                  min_instances: int = 6) -> DataFrame:
    """Per-series cpu beside the number of instances up at the same step."""
    both = cpu.join(up_counts.select("step", "up_count"), "step")
    return both.select(
        "series", "step", F.col("value").alias("cpu"), F.col("up_count").alias("instances"),
        ((F.col("value") > F.lit(cpu_limit)) & (F.col("up_count") >= F.lit(min_instances))).alias("active"))


def stress_goals(replicas: DataFrame, cpu: DataFrame, max_replicas: int = 6,
                 cpu_limit: float = 80.0) -> DataFrame:
    """Did the run ever reach the most replicas, and ever see high cpu?"""
    seen = replicas.agg(F.max("value").alias("max_replicas"))
    high = cpu.agg(F.coalesce(F.bool_or(F.col("value") > F.lit(cpu_limit)), F.lit(False)))
    reached = F.coalesce(F.col("max_replicas") >= F.lit(max_replicas), F.lit(False))
    return (seen.withColumn("max_replicas_reached", reached)
            .withColumn("high_cpu_detected", high.scalar())
            .withColumn("goal_met", F.col("max_replicas_reached") & F.col("high_cpu_detected")))


# Scale-up limits of cpu %, memory %, requests/s per pod, P95 ms.
SCALE_LIMITS = {"cpu": 70.0, "memory": 80.0, "rps_per_pod": 50.0, "p95_ms": 500.0}


def scaling_signals(cpu: DataFrame, memory: DataFrame, rps_per_pod: DataFrame, p95_ms: DataFrame,
                    limits: dict[str, float] = SCALE_LIMITS) -> DataFrame:
    """Four flags per step from vectors of (step, value); a missing value raises no flag.

    The vectors are stacked and folded by step: one shuffle instead of three full joins.
    """
    parts = {"cpu": cpu, "memory": memory, "rps_per_pod": rps_per_pod, "p95_ms": p95_ms}
    stacked = None
    for name, vector in parts.items():
        part = vector.select("step", (F.col("value") > F.lit(limits[name])).alias("over"),
                             F.lit(name).alias("signal"))
        stacked = part if stacked is None else stacked.unionByName(part)
    flags = [F.coalesce(F.bool_or(F.when(F.col("signal") == name, F.col("over"))),
                        F.lit(False)).alias(f"{name}_high") for name in parts]
    return (stacked.groupBy("step").agg(*flags)
            .withColumn("scale_up", F.col("cpu_high") | F.col("memory_high")
                        | F.col("rps_per_pod_high") | F.col("p95_ms_high")))


def scaling_flags(by_step: DataFrame, limits: dict[str, float] = SCALE_LIMITS) -> DataFrame:
    """The same flags from one row per step with a column for each signal."""
    flags = [F.coalesce(F.col(name) > F.lit(limit), F.lit(False)).alias(f"{name}_high") for name, limit in limits.items()]
    return by_step.select("step", *flags).withColumn("scale_up", F.col("cpu_high") | F.col("memory_high")
                                                     | F.col("rps_per_pod_high") | F.col("p95_ms_high"))


def readiness_rollup(samples: DataFrame) -> DataFrame:
    """Worst state of each host from its (cpu, memory) samples."""
    level = (F.when(F.col("memory") > 95, 2)
             .when((F.col("memory") > 90) | (F.col("cpu") > 95), 1).otherwise(0))
    worst = F.max(level)
    return samples.groupBy("host").agg(
        F.when(worst == 2, "critical").when(worst == 1, "warning").otherwise("ready").alias("status"))
