import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import alerts, notices

T0 = datetime(2024, 1, 1)
MIN = timedelta(minutes=1)
SCHEMA = "grp string, member string, ts timestamp_ntz, fresh boolean, group_wait int, group_interval int, repeat_interval int"


def plain(steps, wait, news, repeat, until=None):
    """(minute, kind, n, opened) of one group, minute by minute; steps: minute -> (members, any fresh)."""
    out, opened, last, due, before = [], None, None, False, None
    for t in [*sorted(steps), None]:
        if opened is not None and (t is None or t > before + 1):
            if last is not None and (until is None or before + 1 <= until):
                out.append((before + 1, "resolved", steps[before][0], opened))
            opened = last = None
            due = False
        if t is None:
            break
        if opened is None:
            opened = t
        due = due or (last is not None and steps[t][1])
        if (t >= opened + wait) if last is None else (t >= last + repeat or (due and t >= last + news)):
            out.append((t, "firing", steps[t][0], opened))
            last, due = t, False
        before = t
    return out


def rows_of(group, steps, wait, news, repeat):
    return [(group, f"m{i}", T0 + t * MIN + timedelta(seconds=i % 60), fresh and i == 0, 60 * wait, 60 * news, 60 * repeat)
            for t, (n, fresh) in steps.items() for i in range(n)]


def minutes(rows):
    return sorted(((r.ts - T0) // MIN, r.kind, r.n, (r.opened_at - T0) // MIN) for r in rows)


@pytest.mark.parametrize("segment", [2, 7, 60, 1440])
def test_notices_are_the_same_for_any_segment(spark, segment):
    rng, rows, want = random.Random(segment), [], {}
    for g in range(24):
        wait, news, repeat = rng.choice([0, 1, 3, 15]), rng.choice([1, 2, 6]), rng.choice([1, 5, 9, 40])
        density, fresh = rng.choice([0.5, 0.9, 0.99, 1.0]), rng.choice([0.0, 0.05, 0.5])
        steps = {t: (rng.randint(1, 3), rng.random() < fresh) for t in range(rng.randint(1, 200)) if rng.random() < density}
        name = f"g{g}" if g else None
        rows += rows_of(name, steps, wait, news, repeat)
        want[name] = sorted(plain(steps, wait, news, repeat))
    out = notices.group_notices(spark.createDataFrame(rows, SCHEMA).repartition(5), ("grp",), MIN, segment=segment * MIN).collect()
    got = {name: minutes(r for r in out if r.grp == name) for name in want}
    assert got == want and sum(map(len, want.values())) > 300


def test_what_arrives_in_the_wait_is_one_notice(spark):
    steps = {0: (1, True), 1: (2, True), 2: (4, True), 3: (4, False), 4: (5, True), 5: (5, False)}
    out = notices.group_notices(spark.createDataFrame(rows_of("a", steps, 2, 1, 60), SCHEMA), ("grp",), MIN)
    assert minutes(out.collect()) == [(2, "firing", 4, 0), (4, "firing", 5, 0), (6, "resolved", 5, 0)]


def test_an_episode_shorter_than_the_wait_is_silent(spark):
    steps = {0: (1, True), 1: (1, False), 5: (1, True), 6: (1, False), 7: (2, False)}
    out = notices.group_notices(spark.createDataFrame(rows_of("a", steps, 2, 1, 60), SCHEMA), ("grp",), MIN)
    assert minutes(out.collect()) == [(7, "firing", 2, 5), (8, "resolved", 2, 5)]


def test_resolved_when_the_last_member_ends_and_open_at_the_end(spark):
    steps = {t: (1, t in (0, 2)) for t in range(4)} | {t: (1, t == 6) for t in range(6, 9)}
    rows = spark.createDataFrame(rows_of("a", steps, 0, 5, 60), SCHEMA)
    until = F.lit(T0 + 8 * MIN).cast("timestamp_ntz")
    out = notices.group_notices(rows, ("grp",), MIN, until)
    assert minutes(out.collect()) == [(0, "firing", 1, 0), (4, "resolved", 1, 0), (6, "firing", 1, 6)]
    assert (9, "resolved", 1, 6) in minutes(notices.group_notices(rows, ("grp",), MIN).collect())


def test_no_rows(spark):
    assert notices.group_notices(spark.createDataFrame([], SCHEMA), ("grp",), MIN).collect() == []


def test_the_chain_from_flags(spark):
    """Two members of one rule: news after the first notice, then repeats, one resolution and a new opening."""
    marks = {"s1": "xxxxxxxxxxxx......xxxx", "s2": "....xxxxxxxxxx........"}
    rows = [(name, T0 + i * MIN, m == "x", 1.0) for name, ms in marks.items() for i, m in enumerate(ms)]
    flags = alerts.rule_flags(spark.createDataFrame(rows, "series string, ts timestamp_ntz, active boolean, value double"),
                              alerts.HIGH_LOAD.tuned(hold=2 * MIN))
    labels = {"cluster": F.lit("c"), "service": F.lit("v")}
    out = alerts.notifications(flags, MIN, labels)
    assert out.columns == ["alertname", "cluster", "service", "receiver", "ts", "kind", "n", "opened_at"]
    assert minutes(out.collect()) == [(2, "firing", 1, 2), (6, "firing", 2, 2), (11, "firing", 2, 2), (14, "resolved", 1, 2),
                                      (20, "firing", 1, 20)]
