import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import alerts

T0 = datetime(2024, 1, 1)
MIN = timedelta(minutes=1)


def flags(spark, series):
    rows = [(name, T0 + i * MIN, mark == "x", float(i)) for name, marks in series.items()
            for i, mark in enumerate(marks) if mark != " "]
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, active boolean, value double")


def firing(marks, hold):
    """Minutes that fire: a dot or a missing evaluation breaks the hold."""
    out, since = [], None
    for i, mark in enumerate(marks):
        since = (i if since is None else since) if mark == "x" else None
        if since is not None and i - since >= hold:
            out.append(i)
    return out


@pytest.mark.parametrize("marks,fires", [
    ("xx.", []), ("xxx", [2]), ("xx.xxx", [5]), ("xx xx", []), ("xxxx", [2, 3]), ("...", [])])
def test_hold(spark, marks, fires):
    held = alerts.alert_for_duration(flags(spark, {"s": marks}), 2 * MIN, MIN)
    assert sorted((r.ts - T0) // MIN for r in held.filter("firing").collect()) == fires == firing(marks, 2)


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 1440])
def test_hold_is_the_same_for_any_segment(spark, segment):
    rng = random.Random(segment)
    series = {f"s{i}": "".join(rng.choices("x. ", [12, 2, 1], k=40)) for i in range(12)} | {"all": "x" * 40}
    held = alerts.alert_for_duration(flags(spark, series), 3 * MIN, MIN, segment=segment * MIN)
    got = {name: [] for name in series}
    for r in held.filter("firing").orderBy("series", "ts").collect():
        got[r.series].append((r.ts - T0) // MIN)
    assert got == {name: firing(marks, 3) for name, marks in series.items()}


def test_firing_only_where_active(spark):
    held = alerts.alert_for_duration(flags(spark, {"s": "xxx.xxxx"}), MIN, MIN)
    assert held.filter("firing and not active").count() == 0
    assert held.filter("not active and pending_since is not null").count() == 0


def test_lifecycle(spark):
    runs = alerts.alert_lifecycle(flags(spark, {"a": "xxx.xx.", "b": "....xxx"}), 2 * MIN, MIN).orderBy("series").collect()
    assert [(r.series, (r.starts_at - T0) // MIN, r.ends_at and (r.ends_at - T0) // MIN, r.resolved) for r in runs] == [
        ("a", 2, 3, True), ("b", 6, None, False)]


def test_rules_are_held_together_but_apart(spark):
    one = alerts.rule_flags(flags(spark, {"s": "xxxx"}), alerts.HIGH_LOAD.tuned(hold=2 * MIN))
    two = alerts.rule_flags(flags(spark, {"s": "x.xx"}), alerts.CRASH_LOOP.tuned(hold=MIN))
    got = alerts.evaluate_rules(alerts.union_rules([one, two]), MIN).orderBy("alertname").collect()
    assert [(r.alertname, r.severity, (r.starts_at - T0) // MIN, r.value) for r in got] == [
        ("CrashLoop", "warning", 3, 3.0), ("HighLoad", "critical", 2, 2.0)]


def test_default_hold_on_minute_steps(spark):
    rows = spark.createDataFrame([("d", T0 + i * MIN, 6) for i in range(4)], "series string, ts timestamp_ntz, value int")
    got = alerts.alert_max_replicas(rows, MIN).collect()
    assert [(r.alertname, (r.starts_at - T0) // MIN, r.value) for r in got] == [("MaxReplicas", 3, 6.0)]


def test_low_rate_ignores_silence(spark):
    rows = spark.createDataFrame([("p", T0)], "series string, ts timestamp_ntz")
    got = alerts.alert_low_prediction_rate(rows, MIN, rule=alerts.LOW_PREDICTION_RATE.tuned(hold=4 * MIN)).collect()
    assert [(r.series, (r.starts_at - T0) // MIN) for r in got] == [("p", 5)]
    assert alerts.alert_low_prediction_rate(rows, MIN).count() == 0


def test_routing(spark):
    rows = spark.createDataFrame([("critical", "performance"), ("warning", "performance"), ("warning", "infrastructure"),
                                  ("warning", "scaling")], "severity string, alert_type string")
    assert [(r.receiver, r.group_wait, r.repeat_interval) for r in alerts.alert_routing(rows).collect()] == [
        ("critical", 0, 300), ("performance", 10, 900), ("infrastructure", 10, 1800), ("default", 10, 3600)]


def test_grouping(spark):
    rows = spark.createDataFrame([("a", "c", "s", T0 + i * MIN) for i in range(3)] + [("b", "c", "s", T0)],
                                 "alertname string, cluster string, service string, starts_at timestamp_ntz")
    got = {r.alertname: (r.n, r.starts_at) for r in alerts.alert_grouping(rows).collect()}
    assert got == {"a": (3, T0), "b": (1, T0)}


def sends(times, gap):
    out = []
    for t in sorted(set(times)):
        if not out or t >= out[-1] + gap:
            out.append(t)
    return out


@pytest.mark.parametrize("segment", [3, 10, 60, 1440])
@pytest.mark.parametrize("gap", [4, 25])
def test_throttle_is_the_same_for_any_segment(spark, segment, gap):
    rng = random.Random(gap * segment)
    times = {g: [rng.randint(0, 400) for _ in range(n)] for g, n in (("a", 300), ("b", 40), ("c", 1))}
    rows = spark.createDataFrame([(g, T0 + t * MIN, gap * 60) for g, ts in times.items() for t in ts],
                                 "alertname string, ts timestamp_ntz, repeat_interval int")
    out = alerts.alert_repeat_throttle(rows, ("alertname",), segment=segment * MIN)
    got = {g: sorted((r.ts - T0) // MIN for r in out.filter(F.col("alertname") == g).collect()) for g in times}
    assert got == {g: sends(ts, gap) for g, ts in times.items()}


@pytest.mark.parametrize("segment", [60, 600, 10_080])
def test_routes_of_a_group_send_apart(spark, segment):
    """Six critical sends five minutes apart and one of an hourly route are seven, for any segment."""
    rows = spark.createDataFrame(
        [("a", "critical", T0 + 5 * i * MIN, 300) for i in range(6)] + [("a", "default", T0 + 12 * MIN, 3600), ("a", "default", T0 + 40 * MIN, 3600)]
        + [(None, "critical", T0, 300), (None, "critical", T0 + MIN, 300)],
        "alertname string, receiver string, ts timestamp_ntz, repeat_interval int")
    out = alerts.alert_repeat_throttle(rows, ("alertname", "receiver"), segment=segment * MIN).collect()
    assert sorted(((r.ts - T0) // MIN, r.receiver) for r in out if r.alertname) == [
        (0, "critical"), (5, "critical"), (10, "critical"), (12, "default"), (15, "critical"), (20, "critical"), (25, "critical")]
    assert [r.ts for r in out if r.alertname is None] == [T0]


def test_times_within_a_step_are_one(spark):
    sec = timedelta(seconds=1)
    rows = spark.createDataFrame([("a", T0 + i * sec, 20) for i in range(60)], "alertname string, ts timestamp_ntz, repeat_interval int")
    out = alerts.alert_repeat_throttle(rows, ("alertname",)).collect()
    assert sorted((r.ts - T0) // sec for r in out) == [0, 30]


def test_a_null_series_is_held(spark):
    held = alerts.alert_for_duration(flags(spark, {None: "xxx"}), MIN, MIN)
    assert sorted((r.ts - T0) // MIN for r in held.filter("firing").collect()) == [1, 2]


def test_gauges_of_one_table(spark):
    rows = [("up", "p", T0 + i * MIN, 0) for i in range(3)] + [("restarts", "p", T0 + i * MIN, 9) for i in range(3)]
    rows += [("other", "p", T0, 0), ("up", "q", T0, 1), ("up", "q", T0, 0)]
    samples = spark.createDataFrame(rows, "name string, series string, ts timestamp_ntz, value int")
    rules = {"up": alerts.SERVICE_DOWN, "restarts": alerts.CRASH_LOOP}
    together = alerts.flags_on_samples(samples, MIN, rules, MIN)
    apart = alerts.union_rules([alerts.flags_on_latest(samples.filter(F.col("name") == n).drop("name"), MIN, r, MIN) for n, r in rules.items()])
    assert together.columns == apart.columns and sorted(map(str, together.collect())) == sorted(map(str, apart.collect()))
    assert together.filter("series = 'q' and active").count() == 0  # of one time the larger value counts


def test_notifications_of_held_rules(spark):
    one = alerts.rule_flags(flags(spark, {"s": "x" * 30}), alerts.HIGH_LOAD.tuned(hold=2 * MIN))
    two = alerts.rule_flags(flags(spark, {"s": "x" * 30}), alerts.CRASH_LOOP.tuned(hold=MIN))
    labels = {"cluster": F.lit("c"), "service": F.col("series")}
    out = alerts.notifications(alerts.union_rules([one, two]), MIN, labels).collect()
    sent = sorted((r.alertname, r.receiver, (r.ts - T0) // MIN, r.kind) for r in out)
    assert sent == [("CrashLoop", "infrastructure", 2, "firing")] + [("HighLoad", "critical", i, "firing") for i in range(2, 30, 5)]
