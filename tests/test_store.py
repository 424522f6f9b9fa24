"""The table store: null orders, clashing names, writers at once, rows without keys, growth, replays."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gleanworks.operators import dedup, sinks
from gleanworks.storage import names_in


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_null_order_loses_and_no_row_is_lost(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, "b"), (2, None, "c"), (None, None, "d"), (3, None, "e"), (3, None, "e")], "k int, seq int, v string")
    assert rows_of(dedup.last_wins(df, ["k"], F.col("seq"))) == [(1, None, "a"), (2, 5, "b"), (3, None, "e"), (None, None, "d")]
    assert rows_of(dedup.first_wins(df, ["k"], F.col("seq"))) == [(1, None, "a"), (2, 5, "b"), (3, None, "e")]
    ties = spark.createDataFrame([(1, 7, x) for x in "abcdef"], "k int, seq int, v string")
    assert len({rows_of(dedup.last_wins(ties.repartition(n), ["k"], F.col("seq")))[0] for n in (1, 3, 5)}) == 1


def test_null_orders_in_the_store(spark, tmp_path):
    path, df = f"{tmp_path}/t", (lambda rows: spark.createDataFrame(rows, "k int, seq int, v string"))
    sinks.upsert_table(df([(1, None, "a"), (2, 5, "b"), (None, None, "x")]), path, ["k"], "seq")
    sinks.upsert_table(df([(1, None, "a"), (2, None, "later"), (3, None, "c")]), path, ["k"], "seq")
    sinks.upsert_table(df([(3, 0, "d")]), path, ["k"], "seq")
    assert rows_of(sinks.read_table(spark, path)) == [(1, None, "a"), (2, 5, "b"), (3, 0, "d"), (None, None, "x")]


def test_a_column_named_like_the_store_s(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(k, 1, k * 10, "x") for k in range(50)], "k int, seq int, Bucket_ int, bucket__ string")
    sinks.write_table(df, path, ["k"])
    sinks.upsert_table(df.where("k = 3").withColumn("seq", F.lit(2)).withColumn("Bucket_", F.lit(7)), path, ["k"], "seq")
    assert {r.k: (r.Bucket_, r.bucket__) for r in sinks.read_table(spark, path).collect()} == {k: (7 if k == 3 else k * 10, "x") for k in range(50)}


def test_writers_at_once(spark, tmp_path, monkeypatch):
    path, df = f"{tmp_path}/t", (lambda rows: spark.createDataFrame(rows, "k int, seq int, v string"))
    sinks.upsert_table(df([(0, 1, "first"), (1, 1, "first")]), path, ["k"], "seq")
    merge, between = sinks._merge, []

    def slow(*a):
        made = merge(*a)
        if not between:
            between.append(1)
            sinks.upsert_table(df([(0, 2, "other")]), path, ["k"], "seq")  # commits between read and swap
        return made

    monkeypatch.setattr(sinks, "_merge", slow)
    sinks.upsert_table(df([(1, 2, "mine"), (None, 1, "loose")]), path, ["k"], "seq")
    assert rows_of(sinks.read_table(spark, path)) == [(0, 2, "other"), (1, 2, "mine"), (None, 1, "loose")]

    monkeypatch.setattr(sinks, "_write_buckets", lambda d, p, k, n, f=sinks._write_buckets: (sinks.upsert_table(df([(9, 1, "x")]), path, ["k"], "seq"), f(d, p, k, n))[1] if not between.append(1) and len(between) == 2 else f(d, p, k, n))
    with pytest.raises(sinks.ConcurrentWrite):
        sinks.write_table(df([(5, 5, "all")]), path, ["k"])
    assert 9 in {r.k for r in sinks.read_table(spark, path).collect()}


def test_without_keys_rows_stay_as_they_are_dealt(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_table(spark.range(1000, numPartitions=16), path)
    (folder,) = sinks._state(spark, path)["loose"]
    assert sum(n.startswith("part-") for n in names_in(spark, f"{path}/{folder}")) == 16
    sinks.append_table(spark.range(5), path)
    before = sinks._state(spark, path)["version"]
    sinks.append_table(spark.range(0), path)
    assert sinks.read_table(spark, path).count() == 1005 and sinks._state(spark, path)["version"] == before
    with pytest.raises(ValueError, match="kept by"):
        sinks.upsert_table(spark.range(3).withColumn("seq", F.lit(1)), path, ["id"], "seq")


def test_buckets_grow_with_the_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    df = lambda a, b, seq: spark.range(a, b).select(F.col("id").alias("k"), F.lit(seq).alias("seq"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    monkeypatch.setattr(sinks, "BUCKETS", 2)
    sinks.upsert_table(df(0, 100, 1), path, ["k"], "seq")
    assert sinks._state(spark, path)["buckets"] == 2
    monkeypatch.setattr(sinks, "BUCKET_BYTES", 20_000)
    sinks.upsert_table(df(50, 3000, 2), path, ["k"], "seq")
    state = sinks._state(spark, path)
    assert state["buckets"] > 8 and len(state["parts"]) == state["buckets"]
    sinks.upsert_table(df(7, 8, 3), path, ["k"], "seq")
    got = {r.k: r.seq for r in sinks.read_table(spark, path).collect()}
    assert got == {k: 3 if k == 7 else 1 if k < 50 else 2 for k in range(3000)}


def test_replays_change_nothing_and_old_versions_stay_a_while(spark, tmp_path):
    path, df = f"{tmp_path}/t", (lambda rows: spark.createDataFrame(rows, "k int, seq int"))
    sinks.upsert_table(df([(1, 1), (None, 1)]), path, ["k"], "seq", ("q", 0))
    sinks.upsert_table(df([(1, 1), (None, 1)]), path, ["k"], "seq", ("q", 0))
    assert rows_of(sinks.read_table(spark, path)) == [(1, 1), (None, 1)]
    held = sinks.read_table(spark, path)
    for k in range(sinks.KEEP_VERSIONS - 1):
        sinks.upsert_table(df([(1, 2 + k)]), path, ["k"], "seq", ("q", 1 + k))
    assert rows_of(held) == [(1, 1), (None, 1)]
    sinks.upsert_table(df([(1, 99)]), path, ["k"], "seq")
    assert len(names_in(spark, f"{path}/commits")) <= sinks.KEEP_VERSIONS + 1 and rows_of(sinks.read_table(spark, path)) == [(1, 99), (None, 1)]
