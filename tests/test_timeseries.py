import random
from datetime import datetime, timedelta

import pytest

from tallyguard.operators import timeseries

T0 = datetime(2024, 1, 1)
MIN = timedelta(minutes=1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def samples(spark, rows):
    return spark.createDataFrame([(s, at(t), float(v)) for s, t, v in rows], "series string, ts timestamp_ntz, value double")


def test_request_rate_needs_samples(spark):
    rows = samples(spark, [("a", 0, 1), ("a", 30, 1), ("a", 61, 1)])
    got = {r.step: r.rate for r in timeseries.request_rate(rows, MIN).collect()}
    assert got == {at(60 * i): n / 300 for i, n in ((1, 2), (2, 3), (3, 3), (4, 3), (5, 3), (6, 1))}


def test_window_must_be_whole_steps(spark):
    with pytest.raises(ValueError):
        timeseries.request_rate(samples(spark, [("a", 0, 1)]), timedelta(minutes=2))


def test_counter_reset_and_single_sample(spark):
    rows = samples(spark, [("a", 10, 5), ("a", 20, 9), ("a", 70, 2), ("a", 80, 4), ("b", 10, 1)])
    got = {(r.series, r.step): r.rate for r in timeseries.counter_rate(rows, MIN, 2 * MIN).collect()}
    assert got == {("a", at(60)): 4 / 10, ("a", at(120)): (4 + 2 + 2) / 70, ("a", at(180)): 2 / 10}


def _rates(rows, step, window):
    """Increase over the span of the samples inside each window, by definition."""
    out = {}
    for series in {s for s, _, _ in rows}:
        points = sorted((t, v) for s, t, v in rows if s == series)
        for k in range(1, max(t for t, _ in points) // step + window // step + 2):
            end = k * step
            inside = [(t, v) for t, v in points if end - window <= t < end]
            if len(inside) > 1:
                rise = sum(v if v < u else v - u for (_, u), (_, v) in zip(inside, inside[1:]))
                out[series, at(end)] = rise / (inside[-1][0] - inside[0][0])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_counter_rate_against_definition(spark, seed):
    rng = random.Random(seed)
    rows = [(s, t, rng.randint(0, 50)) for s in "ab" for t in sorted(rng.sample(range(3600), 60))]
    got = {(r.series, r.step): r.rate for r in timeseries.counter_rate(samples(spark, rows), 5 * MIN, 15 * MIN).collect()}
    assert got == pytest.approx(_rates(rows, 300, 900))


def test_latest_sample_lookback(spark):
    rows = samples(spark, [("a", 10, 1), ("a", 50, 2), ("a", 130, 3)])
    got = {r.step: r.value for r in timeseries.latest_sample(rows, MIN, 2 * MIN).collect()}
    assert got == {at(60): 2.0, at(120): 2.0, at(180): 3.0, at(240): 3.0}


def test_ratio_needs_equal_labels(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0)], "series string, value double")
    right = spark.createDataFrame([("a", 4.0), ("b", 0.0)], "series string, value double")
    assert {r.series: r.value for r in timeseries.vector_ratio(left, right, ("series",)).collect()} == {"a": 25.0, "b": None}


def test_highload_needs_both(spark):
    cpu = spark.createDataFrame([("p", 1, 81.0), ("p", 2, 81.0), ("q", 1, 80.0)], "series string, step int, value double")
    up = spark.createDataFrame([(1, 6), (2, 5)], "step int, up_count long")
    assert {(r.series, r.step): r.active for r in timeseries.highload_join(cpu, up).collect()} == {
        ("p", 1): True, ("p", 2): False, ("q", 1): False}


def test_stress_goals(spark):
    replicas = spark.createDataFrame([(4,), (6,)], "value int")
    cpu = spark.createDataFrame([(80.0,), (80.5,)], "value double")
    assert timeseries.stress_goals(replicas, cpu).first().goal_met
    assert not timeseries.stress_goals(replicas, cpu.limit(0)).first().goal_met
    assert not timeseries.stress_goals(replicas.filter("value < 6"), cpu).first().goal_met


def test_scaling_signals_missing_value_is_quiet(spark):
    def vector(*rows):
        return spark.createDataFrame(list(rows), "step int, value double")
    out = timeseries.scaling_signals(vector((1, 70.0), (2, 70.1)), vector((1, 80.0)), vector((1, 50.0)),
                                     vector((1, 500.0), (3, 501.0)))
    got = {r.step: (r.cpu_high, r.memory_high, r.rps_per_pod_high, r.p95_ms_high, r.scale_up) for r in out.collect()}
    assert got == {1: (False,) * 5, 2: (True, False, False, False, True), 3: (False, False, False, True, True)}


def test_readiness(spark):
    rows = spark.createDataFrame([("a", 95.0, 90.0), ("b", 95.1, 10.0), ("c", 1.0, 90.1), ("d", 1.0, 95.1), ("d", 1.0, 1.0)],
                                 "host string, cpu double, memory double")
    assert {r.host: r.status for r in timeseries.readiness_rollup(rows).collect()} == {
        "a": "ready", "b": "warning", "c": "warning", "d": "critical"}
