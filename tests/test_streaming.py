import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyguard import schemas
from tallyguard.operators import alerts, quality, scoring
from tallyguard.streaming import aggregates, alert_state, bounded, progress, scoring as stream
from tests.test_notices import minutes, plain, rows_of

T0 = datetime(2024, 1, 1)
MIN = timedelta(minutes=1)
FLAGS = "series string, ts timestamp, active boolean"


def run(df, tmp_path, name="out", mode="append"):
    path = str(tmp_path / name)
    (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-checkpoint")
     .outputMode(mode).trigger(availableNow=True).start().awaitTermination())
    return path


def write(spark, rows, schema, path, name):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def source(spark, tmp_path, schema, per_trigger=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(f"{tmp_path}/in/*")


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(alert_state.STATE_STORE_CONF)
    spark.conf.set(alert_state.STATE_STORE_CONF, alert_state.ROCKSDB)
    yield
    spark.conf.set(alert_state.STATE_STORE_CONF, before)


def test_scores_as_in_batch_over_many_files(spark, tmp_path):
    schema = "transaction_id string, amount double"
    rows = [(f"t{i}", float(i * 60)) for i in range(20)]
    for i in range(4):
        write(spark, rows[i * 5:i * 5 + 5], schema, tmp_path / "in", f"f{i}")
    def scored(df):
        return stream.stream_score(df, scoring.RuleScorer(), "m", "1").drop("prediction_timestamp")
    got = spark.read.parquet(run(scored(source(spark, tmp_path, schema)), tmp_path))
    want = scored(spark.createDataFrame(rows, schema))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == 20


def test_parse_and_dead_letter(spark, tmp_path):
    lines = [('{"transaction_id":"a","amount":5.0,"timestamp":"2024-01-01T00:00:00"}',), ("{cut",), ('{"amount":"x"}',)]
    write(spark, lines, "value string", tmp_path / "in", "f")
    parsed = stream.stream_parse(source(spark, tmp_path, "value string"))
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for _ in range(2):  # the second run finds nothing new
        stream.stream_dead_letter(parsed, good, bad, str(tmp_path / "checkpoint")).awaitTermination()
    assert [r.transaction_id for r in spark.read.parquet(good).collect()] == ["a"]
    assert sorted(r[schemas.CORRUPT] for r in spark.read.parquet(bad).collect()) == ['{"amount":"x"}', "{cut"]


def test_windows_close_behind_the_watermark(spark, tmp_path):
    rows = [(T0 + i * MIN,) for i in range(0, 120, 10)]
    write(spark, rows[:6], "ts timestamp", tmp_path / "in", "a")
    write(spark, rows[6:], "ts timestamp", tmp_path / "in", "b")
    out = spark.read.parquet(run(aggregates.stream_throughput(source(spark, tmp_path, "ts timestamp"), 30 * MIN), tmp_path))
    got = sorted(((r.window_start - T0) // MIN, r.rows, r.rate) for r in out.collect())
    assert got == [(0, 3, 3 / 1800), (30, 3, 3 / 1800), (60, 3, 3 / 1800)]


def test_user_stats_follow_restart(spark, tmp_path):
    schema = "user_id string, amount double, is_fraud int"
    first, second = [("a", 1.0, 1), ("b", 2.0, 0)], [("a", 3.0, 0), ("c", 4.0, 1)]
    path, checkpoint = str(tmp_path / "stats"), str(tmp_path / "checkpoint")
    for i, rows in enumerate((first, second)):
        write(spark, rows, schema, tmp_path / "in", f"f{i}")
        aggregates.stream_user_stats_table(source(spark, tmp_path, schema), path, checkpoint).awaitTermination()
    got = aggregates.latest_user_stats(spark, path, aggregates.stream_user_stats(spark.createDataFrame([], schema)).schema)
    want = quality.user_stats(spark.createDataFrame(first + second, schema))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_alert_states_survive_restart(spark, tmp_path, rocksdb):
    marks = "xx.xxxx.x"
    rows = [("s", T0 + i * MIN, m == "x") for i, m in enumerate(marks)]
    rows.append(("later", T0 + 50 * MIN, False))
    for i, part in enumerate((rows[:5], rows[5:])):  # the run that fires crosses the restart
        write(spark, part, FLAGS, tmp_path / "in", f"f{i}")
        df = alert_state.stream_alert_state(source(spark, tmp_path, FLAGS), 2 * MIN, delay=MIN)
        path = run(df, tmp_path)
    got = sorted(((r.changed_at - T0) // MIN - 1, r.state) for r in spark.read.parquet(path).collect())
    assert got == [(0, "pending"), (2, "inactive"), (3, "pending"), (5, "firing"), (7, "resolved"), (8, "pending"),
                   (9, "inactive")]


def test_newest_sample_of_a_step_decides(spark, tmp_path, rocksdb):
    sec = timedelta(seconds=1)
    rows = [("s", T0 + 5 * sec, True), ("s", T0 + 50 * sec, False), ("s", T0 + 70 * sec, True), ("s", T0 + 300 * MIN, False)]
    write(spark, rows, FLAGS, tmp_path / "in", "a")
    df = alert_state.stream_alert_state(source(spark, tmp_path, FLAGS), 2 * MIN)
    got = [((r.changed_at - T0) // MIN, r.state) for r in spark.read.parquet(run(df, tmp_path)).collect()]
    assert sorted(got) == [(2, "pending"), (3, "inactive")]


def test_missing_evaluations_break_the_hold_as_in_batch(spark, tmp_path, rocksdb):
    at = [0, 39, 40, 41, 42, 60, 61, 62, 63]
    rows = [("s", T0 + i * MIN, True) for i in at]
    for i, part in enumerate((rows[:3], rows[3:], [("other", T0 + 300 * MIN, False)])):
        write(spark, part, FLAGS, tmp_path / "in", f"f{i}")
        path = run(alert_state.stream_alert_state(source(spark, tmp_path, FLAGS), 3 * MIN, delay=MIN), tmp_path)
    got = sorted(((r.changed_at - T0) // MIN - 1, r.state) for r in spark.read.parquet(path).collect())
    assert got == [(0, "pending"), (1, "inactive"), (39, "pending"), (42, "firing"), (43, "resolved"), (60, "pending"),
                   (63, "firing"), (64, "resolved")]
    held = alerts.alert_for_duration(spark.createDataFrame(rows, FLAGS), 3 * MIN, MIN).filter("firing").collect()
    assert sorted((r.ts - T0) // MIN for r in held) == [42, 63]


def test_silent_series_resolves(spark, tmp_path, rocksdb):
    write(spark, [("s", T0 + i * MIN, True) for i in range(4)], FLAGS, tmp_path / "in", "a")
    write(spark, [("other", T0 + 300 * MIN, False)], FLAGS, tmp_path / "in", "b")
    write(spark, [("other", T0 + 600 * MIN, False)], FLAGS, tmp_path / "in", "c")
    df = alert_state.stream_alert_state(source(spark, tmp_path, FLAGS), 2 * MIN)
    got = sorted(((r.changed_at - T0) // MIN, r.state) for r in spark.read.parquet(run(df, tmp_path)).collect())
    assert got == [(1, "pending"), (3, "firing"), (5, "resolved")]


def test_throttle_as_in_batch_across_restart(spark, tmp_path, rocksdb):
    schema = "group_key string, ts timestamp, repeat_interval int"
    rows = [(g, T0 + i * gap * MIN, 300) for g, gap in (("a", 2), ("b", 7)) for i in range(20)]
    rows.sort(key=lambda r: r[1])
    flush = [("later", T0 + 600 * MIN, 300)]
    for i, part in enumerate((rows[:20], rows[20:] + flush)):
        write(spark, part, schema, tmp_path / "in", f"f{i}")
        path = run(alert_state.stream_alert_throttle(source(spark, tmp_path, schema)), tmp_path)
    got = sorted(map(tuple, spark.read.parquet(path).collect()))
    want = alerts.alert_repeat_throttle(spark.createDataFrame(rows, schema), ("group_key",))
    assert got == sorted(map(tuple, want.collect()))


def test_label_join_bound(spark, tmp_path):
    pred = [("a", T0, True), ("b", T0, False), ("c", T0, True)]
    labels = [("a", T0 + 120 * MIN, True), ("b", T0 + 121 * MIN, True), ("c", T0 - MIN, True)]
    write(spark, pred, "transaction_id string, ts timestamp, is_fraud_predicted boolean", tmp_path / "pred", "f")
    write(spark, labels, "transaction_id string, label_ts timestamp, label boolean", tmp_path / "labels", "f")
    p = spark.readStream.schema("transaction_id string, ts timestamp, is_fraud_predicted boolean").parquet(f"{tmp_path}/pred/*")
    late = spark.readStream.schema("transaction_id string, label_ts timestamp, label boolean").parquet(f"{tmp_path}/labels/*")
    out = run(stream.stream_label_join(p, late, 120 * MIN), tmp_path)
    assert [r.transaction_id for r in spark.read.parquet(out).collect()] == ["a"]


def test_a_keyed_table_is_compacted(spark, tmp_path):
    schema = "k string, n long"
    path, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    df = None
    for i in range(8):
        write(spark, [("a", 1), (f"k{i}", i)], schema, tmp_path / "in", f"f{i}")
        df = source(spark, tmp_path, schema).groupBy("k").agg(F.sum("n").alias("n"))
        aggregates.keyed_table(df, ["k"], path, checkpoint, compact_every=3).awaitTermination()
    got = {r.k: r.n for r in aggregates.latest_rows(spark, path, ["k"], df.schema).collect()}
    assert got == {"a": 8, **{f"k{i}": i for i in range(8)}}
    assert len(list((tmp_path / "table").glob("batch_id=*"))) <= 3


def test_rates_from_panes_include_the_last_windows(spark):
    panes = spark.createDataFrame([(T0, 3), (T0 + MIN, 6)], "window_start timestamp, rows long")
    got = {(r.window_start - T0) // MIN: r.rate * 120 for r in aggregates.rate_of_panes(panes, MIN, 2 * MIN).collect()}
    assert got == {-1: 3.0, 0: 9.0, 1: 6.0}


def test_notices_as_in_batch_over_restarts_and_to_the_end(spark, tmp_path, rocksdb):
    rng, rows, want = random.Random(5), [], {}
    for g in range(6):
        wait, news, repeat = rng.choice([0, 2]), rng.choice([1, 3]), rng.choice([4, 9])
        steps = {t: (rng.randint(1, 3), rng.random() < 0.2) for t in range(40) if rng.random() < 0.9}
        rows += [(r[0], r[2], r[3], *r[4:]) for r in rows_of(f"g{g}", steps, wait, news, repeat)]
        want[f"g{g}"] = sorted(plain(steps, wait, news, repeat))
    schema = "group_key string, ts timestamp, fresh boolean, group_wait int, group_interval int, repeat_interval int"
    for i in range(2):
        part = [r for r in rows if (r[1] < T0 + 17 * MIN) == (i == 0)]
        write(spark, part, schema, tmp_path / "in", f"f{i}")
        firing = bounded.with_end_mark(source(spark, tmp_path, schema, 10), str(tmp_path / "marks")) if i == 0 else firing
        df = alert_state.stream_notifications(firing, MIN, delay=MIN)
        if i == 0:
            path = run(df, tmp_path)
    out = str(tmp_path / "out")
    start = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
             .trigger(availableNow=True).start)
    bounded.run_to_end(start, firing, "ts", str(tmp_path / "marks"))
    told = spark.read.parquet(path).collect()
    assert {g: minutes(r for r in told if r.group_key == g) for g in want} == want


def test_every_row_is_answered_dead_or_late(spark, tmp_path):
    """Late is what came after its window closed, by the watermark of the batches before; Spark's windows drop no other."""
    schema, minutes_of = "id long, ts timestamp, ok boolean", [[0, 5, 31, 45], [7, 29, 30, 95, None], [31, 59, 60, 89, 90, 94, 7]]
    for i, ms in enumerate(minutes_of):
        write(spark, [(10 * i + j, None if m is None else T0 + m * MIN, j != 1) for j, m in enumerate(ms)], schema, tmp_path / "in", f"f{i}")
    rows = source(spark, tmp_path, schema)
    path, windows = str(tmp_path / "arrivals"), str(tmp_path / "windows")
    with progress.ProgressTable(spark, str(tmp_path / "progress")) as table:
        for _ in range(2):  # the second run finds nothing new
            table.finish(progress.split_arrivals(rows, 30 * MIN, path, str(tmp_path / "c1"), 10 * MIN, dead=~F.col("ok")))
        counted = aggregates.stream_throughput(rows.filter("ok"), 30 * MIN, 10 * MIN)
        query = (counted.writeStream.format("memory").queryName("kept").option("checkpointLocation", windows)
                 .outputMode("update").trigger(availableNow=True).start())
        table.finish(query)
        batches = table.rows().collect()
    got = {r.id: r.route for r in progress.arrivals(spark, path, schema).collect()}
    assert sorted(got) == [10 * i + j for i, ms in enumerate(minutes_of) for j in range(len(ms))] and {i for i, r in got.items() if r == "dead"} == {1, 11, 21}
    assert {i for i, r in got.items() if r == "late"} == {10, 20, 26}  # their half hours had ended at 0:35 and 1:25
    split = [b for b in batches if b.run_id != str(query.runId)]
    assert sum(b.rows for b in split) == len(got)
    own = [b for b in batches if b.run_id == str(query.runId)]
    newest = {}
    for r in spark.table("kept").collect():
        newest[r.window_start] = max(r.rows, newest.get(r.window_start, 0))
    answered = [i for i, r in got.items() if r == "answered"]
    assert len(answered) - 1 <= sum(newest.values()) < len(answered) + 2  # the row without a time is in no window
    assert sum(b.dropped for b in own) > 0 and max(b.watermark for b in own if b.watermark) == T0 + 85 * MIN
    assert len({(b.run_id, b.batch_id) for b in batches}) == len(batches) and any(b.state_rows for b in own)
