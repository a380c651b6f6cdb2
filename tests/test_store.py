"""The compacted store against a dict."""

import random

import pytest
from pyspark.sql import functions as F

from tripweave.sources.store import Conflict, Store

SCHEMA = "PK string, SK string, seq long, title string, gone boolean"


def rows_of(frame, columns):
    return {tuple(r[c] for c in ("PK", "SK")): tuple(r[c] for c in columns) for r in frame.collect()}


def batches_of(seed, count):
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(25)]
    return [
        [(rng.choice(["C1", "C2", None, ""]), rng.choice(keys), s, rng.choice([None, "a", "b", f"t{s}"]), rng.random() < 0.2) for s in range(30)]
        for _ in range(count)
    ]


def apply(state, batch):
    for pk, sk, seq, title, gone in batch:
        if pk:
            state.pop((pk, sk), None) if gone else state.__setitem__((pk, sk), (seq, title))
    return state


@pytest.mark.parametrize("compact_at", [set(), {0, 4, 9}, set(range(10))])
def test_store_equals_a_dict(spark, tmp_path, compact_at):
    store, state = Store(spark, str(tmp_path), buckets=3, fan=3), {}
    assert store.current() is None and store.compact().version == 0 and store.tidy().version == 0
    for n, batch in enumerate(batches_of(1, 10)):
        store.append(spark.createDataFrame(batch, SCHEMA), n + 1, ["seq"], F.col("gone"))
        apply(state, batch)
        before = store.manifest().version
        assert store.append(spark.createDataFrame(batch[::-1], SCHEMA), n + 1, ["seq"]).version == before  # a retry
        store.tidy()
        if n in compact_at:
            store.compact()
        got = store.current()
        assert rows_of(got, ("seq", "title")) == state and got.count() == len(state)
    assert len(store.manifest().deltas) <= 4
    store.compact()
    old = store.manifest()
    assert store.vacuum() > 0 and store.vacuum() == 0 and rows_of(store.current(), ("seq", "title")) == state and old.deltas == []


def test_base_does_not_move(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=4)
    for n, batch in enumerate(batches_of(2, 3)):
        store.append(spark.createDataFrame(batch, SCHEMA).drop("gone"), n + 1, ["seq"])
        if n == 1:
            store.compact()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = store.current()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = plan.index("Bucketed: true")
    above = plan[plan.rindex("SortMergeJoin", 0, scan) : scan]
    assert "Exchange" not in above and "SelectedBucketsCount: 4 out of 4" in plan


def test_base_does_not_move_with_fewer_buckets_than_shuffle_partitions(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=2)
    for n, batch in enumerate(batches_of(3, 3)):
        store.append(spark.createDataFrame(batch, SCHEMA).drop("gone"), n + 1, ["seq"])
        if n == 0:
            store.compact()
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.shuffle.partitions", 48)
    try:
        plan = store.current()._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    scan = plan.index("Bucketed: true")
    assert "Exchange" not in plan[plan.rindex("SortMergeJoin", 0, scan) : scan]
    assert plan.count("Exchange") == 1 and "partial_max_by" not in plan  # the deltas, each row once


def test_base_gets_more_buckets_as_it_grows(spark, tmp_path, monkeypatch):
    store, state = Store(spark, str(tmp_path), buckets=2), {}
    for n, batch in enumerate(batches_of(4, 3)):
        store.append(spark.createDataFrame(batch, SCHEMA), n + 1, ["seq"], F.col("gone"))
        apply(state, batch)
        monkeypatch.setattr("tripweave.sources.store.BUCKET_BYTES", 1 << 20 if n == 0 else 700)
        own = store.compact().buckets
        assert own == 2 if n == 0 else own > 4
        assert rows_of(store.current(), ("seq", "title")) == state


def test_another_session_reads_the_base(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=2)
    store.append(spark.createDataFrame([("C", "a", 1, "x", False)], SCHEMA), 1, ["seq"])
    store.compact()
    for table in [t.name for t in spark.catalog.listTables() if t.name.startswith("store_")]:
        spark.sql(f"DROP TABLE {table}")
    again = Store(spark, str(tmp_path))
    assert rows_of(again.current(), ("seq", "title")) == {("C", "a"): (1, "x")}
    again.append(spark.createDataFrame([("C", "b", 1, None, "new")], "PK string, SK string, seq long, title string, extra string"), 2, ["seq"])
    assert rows_of(again.current(), ("title", "extra")) == {("C", "a"): ("x", None), ("C", "b"): (None, "new")}
    again.compact()
    assert again.manifest().buckets == 2 and rows_of(again.current(), ("title", "extra")) == {("C", "a"): ("x", None), ("C", "b"): (None, "new")}
    assert rows_of(again.current(1), ("title",)) == {("C", "a"): ("x",)}


CHANGES = "PK string, SK string, title string, price double, expected_version long"


def test_conditional_writes(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    change = lambda *rows: spark.createDataFrame(list(rows), CHANGES)
    store.write_if(change(("C", "a", "one", 1.0, None), ("C", "b", "two", 2.0, None), ("C", "c", "x", 0.0, 4), (None, "d", "x", 0.0, None)), 1)
    assert rows_of(store.current(), ("title", "price", "row_version")) == {("C", "a"): ("one", 1.0, 1), ("C", "b"): ("two", 2.0, 1)}
    refused = [("c", "price", None, "0.0", 4, None), ("c", "title", None, "x", 4, None)]
    told = lambda: sorted((r["SK"], r["field"], r["stored"], r["offered"], r["expected_version"], r["found_version"]) for r in store.history().collect())
    assert told() == refused
    store.compact()
    store.write_if(change(("C", "a", "uno", 1.0, 1), ("C", "b", "due", 2.0, 7), ("C", "b2", "n", 3.0, None)), 2)
    assert rows_of(store.current(), ("title", "price", "row_version")) == {
        ("C", "a"): ("uno", 1.0, 2), ("C", "b"): ("two", 2.0, 1), ("C", "b2"): ("n", 3.0, 1),
    }
    assert told() == [("b", "title", "two", "due", 7, 1), *refused]
    version = store.manifest().version
    assert store.write_if(change(("C", "a", "again", 1.0, 2)), 2).version == version  # a retry
    assert store.write_if(change().limit(0), 3).version == version + 1


def test_fields_that_a_change_does_not_name_stay(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.append(spark.createDataFrame([("C", "a", 5, "one", False)], SCHEMA).drop("gone"), 1, ["seq"])
    store.write_if(spark.createDataFrame([("C", "a", "uno", 0)], "PK string, SK string, title string, expected_version long"), 2)
    assert rows_of(store.current(), ("seq", "title", "row_version")) == {("C", "a"): (5, "uno", 1)}


def test_one_of_two_writers_commits(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.append(spark.createDataFrame([("C", "a", 1, "x", False)], SCHEMA), 1, ["seq"])
    read = store.manifest()
    other = Store(spark, str(tmp_path))
    other.append(spark.createDataFrame([("C", "a", 1, "theirs", False)], SCHEMA), 2, ["seq"])
    with pytest.raises(Conflict):
        store.write_if(spark.createDataFrame([("C", "a", "mine", 1.0, 0)], CHANGES), 3, since=read.version)
    with pytest.raises(Conflict):
        store._publish(read, batch=9)
    assert rows_of(store.current(), ("title",)) == {("C", "a"): ("theirs",)} and store.manifest().batch == 2
