import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import registry, registry_store

TS = datetime(2024, 2, 1)
NEW = "model_name string, run_id string, params map<string,string>, metrics map<string,string>, source_path string, ts timestamp"


def champion_of(spark, run_id):
    """Register one more version of model m and make it the champion."""
    def change(rows):
        added = registry.register_version(rows, spark.createDataFrame([("m", run_id, {}, {}, "s", TS)], NEW))
        moves = added.filter(F.col("run_id") == run_id).select("model_name", "version", F.lit(TS).alias("ts"))
        return registry.promote_champion(added, moves)
    return change


def test_commits_follow_each_other(spark, tmp_path):
    store = registry_store.RegistryStore(spark, str(tmp_path))
    assert store.latest() == 0 and store.read().count() == 0
    assert [store.commit(champion_of(spark, f"r{i}")) for i in range(2)] == [1, 2]
    assert {r.version: r.alias for r in store.read().collect()} == {"1": None, "2": "champion"}
    assert {r.version: r.alias for r in store.read(1).collect()} == {"1": "champion"}


def test_two_writers_at_once_give_two_versions_and_one_champion(spark, tmp_path):
    stores = [registry_store.RegistryStore(spark, str(tmp_path)) for _ in range(2)]
    stores[0].commit(champion_of(spark, "r0"))
    together, called, done = threading.Barrier(2), [], []

    def write(i):
        change = champion_of(spark, f"w{i}")

        def slow(rows):
            called.append(i)
            if called.count(i) == 1:
                together.wait(60)  # both have read the same snapshot
            return change(rows)
        done.append(stores[i].commit(slow))

    threads = [threading.Thread(target=write, args=(i,)) for i in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert sorted(done) == [2, 3] and len(called) == 3
    rows = stores[0].read().collect()
    assert sorted(r.version for r in rows) == ["1", "2", "3"] and {r.run_id for r in rows} == {"r0", "w0", "w1"}
    assert [r.version for r in rows if r.alias == "champion"] == ["3"] == [r.version for r in rows if r.stage == "Production"]
    assert len(list((tmp_path / "data").iterdir())) == 3 and not [p for p in (tmp_path / "commits").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_a_number_is_taken_once(spark, tmp_path):
    store = registry_store.RegistryStore(spark, str(tmp_path))
    assert store._publish(1, {"data": "a"}) and not store._publish(1, {"data": "b"})
    with pytest.raises(registry_store.CommitConflict):
        store.latest = lambda: 0  # a writer that never sees the others
        store.read = lambda number=None: spark.createDataFrame([], store.schema)
        store.commit(champion_of(spark, "r"), tries=2)
    assert list((tmp_path / "data").iterdir()) == []
