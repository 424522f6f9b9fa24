"""Streams: the first of each key by sequence, bounded state, counts by kind, the last step, names in SQL."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gleanworks.functions import names
from gleanworks.functions import text as X
from gleanworks.operators import dedup, sinks
from gleanworks.streaming import finalise, upsert

SCHEMA = "k string, seq long, v long, row string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def arrive(spark, path, parts):
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_first_by_sequence_whatever_the_arrival(spark, tmp_path):
    r, src = random.Random(4), f"{tmp_path}/src"
    rows = [(f"k{k % 9}", (1 << 60) + k if k % 4 else None, None if k % 3 == 0 else (1 << 61) + k, "x") for k in range(80)] + [("only", None, 1, "y"), (None, 1, 1, "z")]
    r.shuffle(rows)
    arrive(spark, src, [rows[k::5] for k in range(5)])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    for _ in range(2):  # the second run finds nothing new
        upsert.stream_first(stream, f"{tmp_path}/t", f"{tmp_path}/cp", ["k"], "seq").awaitTermination()
    assert rows_of(sinks.read_table(spark, f"{tmp_path}/t")) == rows_of(dedup.first_wins(spark.read.parquet(src), ["k"], F.col("seq")))
    # Keys that come when their state is gone are still set right by the table, and state holds the keys of its lifetime only.
    arrive(spark, src, [[("k1", 5, 7, "earlier")], [("k2", 1 << 62, 8, "later"), ("new", 1, 1, "n")]])
    query = upsert.stream_first(stream, f"{tmp_path}/t", f"{tmp_path}/cp2", ["k"], "seq", lifetime_s=0.001)
    query.awaitTermination()
    assert rows_of(sinks.read_table(spark, f"{tmp_path}/t")) == rows_of(dedup.first_wins(spark.read.parquet(src), ["k"], F.col("seq")))
    assert min(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress[-2:]) < 11


def test_counts_are_exact_with_a_task_tried_again_and_a_failing_export_is_only_logged(spark, tmp_path, caplog):
    src = f"{tmp_path}/src"
    arrive(spark, src, [[(["school", "game", None, "odd"][k % 4], k, k, "x") for k in range(part, 100, 2)] for part in range(2)])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    counters = finalise.Counters()
    spark.streams.addListener(counters)
    try:
        items = finalise.counted(stream, "items", "k", ["school", "game"])
        query = items.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()

        def export():
            raise OSError("the disk is full")

        assert finalise.finish(query, export, counters) is None and query.exception() is None
        assert counters.of("items") == {"school": 25, "game": 25, "other": 50}
        assert "export" in caplog.text and spark.read.parquet(f"{tmp_path}/out").count() == 100

        def broken(batches):
            for _ in batches:
                raise ValueError("a bad page")
            yield from ()

        failing = stream.mapInPandas(broken, SCHEMA).writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/cp3").trigger(availableNow=True).start()
        done = []
        with pytest.raises(Exception, match="bad page"):
            finalise.finish(failing, lambda: done.append(1), counters)
        assert done == [1]
    finally:
        spark.streams.removeListener(counters)


def test_names_in_sql_are_the_library_s(spark):
    names.register(spark)
    texts = [None, "", "  ", "The High School", "THE", "high_school", "St-Mary's  HS", "Home | Oak High School - Just another", "Error 404: not found", "welcome to: Oak · Elm", "W 34 - 20", " L 2024-10-12", "T3 1–2", "x.org", "a 'quoted' \"title\" – b", "Ünï | doesn't exist"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, s string")
    got = spark.sql("SELECT k, normalize_name(s) AS a, clean_title(s) AS b, is_junk(s) AS c, result_of(s) AS d, score_of(s) AS e FROM {df}", df=df)
    s = F.col("s")
    want = df.select("k", X.normalize_name(s), X.clean_title(s), X.is_junk(s), X.result_of(s), X.score_of(s))
    assert rows_of(got) == rows_of(want)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    page = "<table><tr><th>Date<th>Opponent</tr><tbody><tr><td>1/1<td><a href='/a/'>@S</a></tr><tr><td>x</tr><tr><td>1/2<td>B<td>W 3 - 1<td>more</tr></tbody></table>"
    pages = spark.createDataFrame([(1, page), (2, None), (3, "<p>")], "id int, html string")
    three = spark.sql("SELECT id, t.* FROM {p}, LATERAL schedule_table(html, 'date, opponent, info') AS t", p=pages)
    assert three.columns == ["id", "game_index", "date", "opponent", "info", "opp_href"]
    assert rows_of(three) == [(1, 0, "1/1", "@S", "", "/a/"), (1, 2, "1/2", "B", "W 3 - 1", None)]
    assert spark.sql("SELECT t.* FROM {p}, LATERAL schedule_table(html, 'date') AS t", p=pages).columns == ["game_index", "date", "opp_href"]


def test_a_batch_takes_the_state_s_step_once_and_natively(spark, tmp_path):
    src = f"{tmp_path}/src"
    arrive(spark, src, [[(f"k{k}", 9, k, "x") for k in range(30)], [(f"k{k}", 10 if k else 1, k, "y") for k in range(30)]])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    query = upsert.stream_first(stream, f"{tmp_path}/t", f"{tmp_path}/cp", ["k"], "seq")
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) == 30
    assert rows_of(sinks.read_table(spark, f"{tmp_path}/t").where("seq < 9")) == [("k0", 1, 0, "y")]
    passed = upsert.improving(stream, ["k"], "seq").writeStream.outputMode("update").format("memory").queryName("passed")
    query = passed.option("checkpointLocation", f"{tmp_path}/cp2").trigger(availableNow=True).start()
    query.awaitTermination()
    assert "Python" not in query._jsq.explainInternal(False) and spark.table("passed").count() == 31
