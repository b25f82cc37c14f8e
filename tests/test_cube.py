import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import alerts, cube, latency
from tallyguard.sources import logs

T0 = datetime(2024, 1, 1)
MIN = timedelta(minutes=1)
BUCKETS, BOUNDS = ["b0", "b1", "b2"], (0.1, 0.5, float("inf"))
SCHEMA = "series string, ts timestamp_ntz, g int, c long, b0 long, b1 long, b2 long, hit int"


@pytest.fixture
def metrics(spark):
    return cube.Metrics(gauges=("g",), counters=(("c",), tuple(BUCKETS)), sums={"n": F.lit(1), "hits": F.col("hit")})


def rise(values):
    """Rise of a vector of counters over time: a drop in one is a reset of all."""
    total = [0] * len(values[0])
    for before, now in zip(values, values[1:]):
        reset = any(x < y for x, y in zip(now, before))
        total = [t + (x if reset else x - y) for t, x, y in zip(total, now, before)]
    return total


def made(rng, n):
    rows, now, c = [], [0, 0, 0], 0
    for t in sorted(rng.sample(range(0, 40 * 60), n)):
        if rng.random() < 0.1:
            now[rng.randrange(3)] = 0
        if rng.random() < 0.1:
            c = 0
        now = [x + rng.randint(0, 9) for x in now]
        c += rng.randint(0, 9)
        lacks = rng.random() < 0.2
        rows.append((t, rng.choice([None, 0, 1, 5]), None if lacks else c, *([None] * 3 if lacks else now), rng.randint(0, 1)))
    return rows


@pytest.mark.parametrize("step,window", [(1, 5), (3, 3), (2, 20), (40, 40)])
def test_windows_match_a_look_at_the_samples(spark, metrics, step, window):
    rng = random.Random(window)
    series = {f"s{i}": made(rng, rng.randint(1, 120)) for i in range(6)} | {None: made(rng, 30)}
    rows = [(s, T0 + timedelta(seconds=r[0]), *r[1:]) for s, rs in series.items() for r in rs]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {(r.series, (r.step - T0) // MIN): r for r in cube.windowed(df, step * MIN, window * MIN, metrics).collect()}
    want = {}
    for s, rs in series.items():
        for at in range(step, 40 + window + step, step):
            inside = [r for r in rs if (at - window) * 60 <= r[0] < at * 60]
            if inside:
                want[s, at] = inside
    assert set(got) == set(want)
    for key, inside in want.items():
        r = got[key]
        gauges = [x[1] for x in inside if x[1] is not None]
        assert r.g == (gauges[-1] if gauges else None) and (r.n, r.hits) == (len(inside), sum(x[6] for x in inside))
        counted = [x for x in inside if x[2] is not None]
        if counted:
            assert r.c == rise([[x[2]] for x in counted])[0] and [r.b0, r.b1, r.b2] == rise([x[3:6] for x in counted])
            assert r.c_seconds == r.b0_seconds == counted[-1][0] - counted[0][0]
        else:
            assert r.c is r.b0 is r.c_seconds is None


def test_a_drop_in_one_bucket_is_a_reset_of_all(spark, metrics):
    rows = [("s", T0, 1, 9, 5, 8, 10, 0), ("s", T0 + MIN, 1, 9, 6, 7, 11, 0), ("s", T0 + 2 * MIN, 1, 9, 7, 9, 13, 0)]
    for step in (1, 4):  # across panes, and inside one
        out = cube.windowed(spark.createDataFrame(rows, SCHEMA), step * MIN, 4 * MIN, metrics)
        r = out.filter(F.col("step") == F.lit(T0 + 4 * MIN)).first()
        assert (r.c, r.b0, r.b1, r.b2) == (0, 6 + 1, 7 + 2, 11 + 2)


def test_bucket_quantile_as_by_rows(spark):
    rng = random.Random(3)
    vectors = [(f"s{i}", *sorted(rng.choices(range(20), k=3))) for i in range(50)] + [("none", 0, 0, 0)]
    wide = spark.createDataFrame(vectors, "series string, b0 long, b1 long, b2 long")
    long = wide.select("series", F.expr("stack(3, 0.1D, b0, 0.5D, b1, double('inf'), b2) as (le, cumulative)"))
    for q in (0.5, 0.95):
        got = wide.select("series", cube.bucket_quantile(BUCKETS, BOUNDS, q).alias("value")).filter("value is not null")
        assert sorted(got.collect()) == sorted(latency.histogram_quantile(long, q).collect())
    with pytest.raises(ValueError):
        cube.bucket_quantile(BUCKETS, BOUNDS[:2], 0.5)


def test_scrapes_of_exposition_text(spark):
    """Label sets in any order are one series; other jobs, metrics and labels stay out; the sum over pods is by bucket."""
    lines, at = [], [T0, T0 + MIN]
    for i, t in enumerate(at):
        for pod in ("a", "b"):
            lines += [(f'total{{job="api",pod="{pod}"}} {10 * i}', t), (f'total{{job="other",pod="{pod}"}} 5', t),
                      (f'seconds_bucket{{le="0.1",pod="{pod}",job="api"}} {4 * i}', t), (f'seconds_bucket{{pod="{pod}",job="api",le="+Inf"}} {9 * i}', t),
                      (f'seconds_bucket{{pod="{pod}",job="api",le="0.5",extra=""}} {8 * i}', t), ("broken{", t)]
    samples = logs.parse_exposition(spark.createDataFrame(lines, "value string, at timestamp"), "at")
    bucket = lambda le: ("seconds_bucket", {"le": le})
    rows = cube.scrapes(cube.matching_labels(samples, {"job": "api"}), {
        "total": ("total", {}), "b0": bucket("0.1"), "b1": bucket("0.5"), "b2": bucket("+Inf")})
    assert rows.count() == 4 and rows.filter("total is null or b0 is null or b1 is null or b2 is null").count() == 0
    metrics = cube.Metrics(counters=(("total",), tuple(BUCKETS)))
    windows = cube.windowed(rows, MIN, 5 * MIN, metrics)
    r = cube.sum_by(windows, ["total", *BUCKETS]).filter(F.col("total") > 0).orderBy("step").first()
    assert (r.total, r.b0, r.b1, r.b2) == (20, 8, 16, 18)


def test_scraped_rules(spark):
    rows = []
    for i in range(40):  # ten requests a minute, a fifth of them errors, two thirds slow
        rows.append(("bad", T0 + i * MIN, 10 * i, 2 * i, 3 * i, 3 * i, 10 * i))
        rows.append(("good", T0 + i * MIN, 600 * i, 0, 600 * i, 600 * i, 600 * i))
        rows.append(("idle", T0 + i * MIN, 7, 7, 7, 7, 7))
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, total long, errors long, b0 long, b1 long, b2 long")
    flags = alerts.flags_on_scrapes(df, MIN, BUCKETS, BOUNDS)
    active = {(r.alertname, r.series) for r in flags.filter("active").collect()}
    assert active == {("HighErrorRate", "bad"), ("LowPredictionRate", "bad"), ("LowPredictionRate", "idle")}
    slow = alerts.flags_on_scrapes(df, MIN, BUCKETS, (0.1, 0.6, float("inf")))
    assert {r.series for r in slow.filter("active and alertname = 'HighLatency'").collect()} == {"bad"}
    assert flags.filter("series = 'idle' and alertname != 'LowPredictionRate'").count() == 0  # no rise: no share, no quantile
