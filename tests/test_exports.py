"""Rewrites that keep the order, one file at any moment, and parallel exports."""

from __future__ import annotations

import csv
import io
import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from gleanworks import cli
from gleanworks.operators import sinks
from gleanworks.sources import tables
from gleanworks.storage import join_files


def written(path, rows, head):
    with open(path, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(head)
        w.writerows(rows)


def test_enrichment_keeps_rows_in_their_order(spark, tmp_path):
    path = f"{tmp_path}/x.csv"
    rows = [(str(k), f"name {k % 7}", 'a "q",\n ü' if k % 5 == 0 else "") for k in range(400)]
    written(path, rows, ["id", "name", "Pos_"])
    names = spark.createDataFrame([(f"name {k}", k) for k in range(6)], "name string, n int")
    n = cli.enrich_csv(spark, path, lambda d: d.repartition(7).join(names.hint("merge"), "name", "left").withColumn("again", F.col("id")))
    assert n == 400 and os.path.isfile(path)
    with open(path, encoding="utf-8", newline="") as f:
        got = list(csv.reader(f))
    assert got[0] == ["id", "name", "Pos_", "n", "again"]
    assert [tuple(r) for r in got[1:]] == [(i, a, c, "" if int(i) % 7 == 6 else str(int(i) % 7), i) for i, a, c in rows]


def test_no_moment_without_a_file(spark, tmp_path):
    path, seen, stop = f"{tmp_path}/x.csv", [], threading.Event()
    written(path, [(k,) for k in range(50)], ["id"])

    def watch():
        while not stop.is_set():
            with open(path) as f:
                seen.append(len(f.read().splitlines()))
            time.sleep(0.001)

    t = threading.Thread(target=watch)
    t.start()
    try:
        for k in range(2):
            cli.enrich_csv(spark, path, lambda d, k=k: d.withColumn(f"c{k}", F.lit("x")).repartition(3))
    finally:
        stop.set()
        t.join()
    assert set(seen) == {51}


def test_a_failed_enrichment_leaves_the_file(spark, tmp_path):
    path = f"{tmp_path}/x.csv"
    written(path, [("1",), ("2",)], ["id"])
    with pytest.raises(Exception, match="no such|fail"):
        cli.enrich_csv(spark, path, lambda d: d.withColumn("x", F.raise_error(F.lit("fail"))))
    with open(path) as f:
        assert f.read() == "id\n1\n2\n"


def by_hand(rows):
    out = io.StringIO()
    out.write("[")
    for k, r in enumerate(rows):
        out.write(("\n  " if k == 0 else ",\n  ") + json.dumps(r, ensure_ascii=False, separators=(",", ":")))
    out.write("\n]\n" if rows else "]\n")
    return out.getvalue()


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_json_array_has_the_bytes_of_a_writer_by_hand(spark, tmp_path, n):
    rows = [{"k": k, "s": None if k % 3 == 0 else f'ü "{k}"\n', "l": ["a", None] if k % 2 else None, "at": k} for k in range(n)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "k long, s string, l array<string>, at long").repartition(9)
    assert sinks.write_json_array(df, f"{tmp_path}/x.json", ["k"]) == n
    with open(f"{tmp_path}/x.json", encoding="utf-8", newline="") as f:
        assert f.read() == by_hand(rows)
    assert sinks.write_json_array(df, f"{tmp_path}/y.json") == n
    with open(f"{tmp_path}/y.json", encoding="utf-8") as f:
        assert sorted(json.load(f), key=lambda r: r["k"]) == rows


def test_nothing_goes_through_the_driver(spark, tmp_path, monkeypatch):
    kind = type(spark.range(1))
    for name in ("toLocalIterator", "toPandas", "toArrow"):
        monkeypatch.setattr(kind, name, lambda *a, **b: pytest.fail("rows came to the driver"))
    df = spark.range(5000).withColumn("s", F.lit("x"))
    sinks.write_json_array(df, f"{tmp_path}/x.json", ["id"])
    sinks.write_csv_file(df, f"{tmp_path}/x.csv", ["id", "s"], "id")
    with open(f"{tmp_path}/x.csv") as f:
        assert f.read() == "id,s\n" + "".join(f"{k},x\n" for k in range(5000))


def test_files_are_joined_in_order(spark, tmp_path):
    for k in range(12):
        with open(f"{tmp_path}/p{k}", "w") as f:
            f.write(f"{k};" if k != 5 else "")
    with open(f"{tmp_path}/whole", "w") as f:
        f.write("old and longer than what follows " * 9)
    join_files(spark, [f"{tmp_path}/p{k}" for k in range(12)], f"{tmp_path}/whole")
    with open(f"{tmp_path}/whole") as f:
        assert f.read() == "0;1;2;3;4;6;7;8;9;10;11;"


def test_csv_of_no_rows_and_odd_heads(spark, tmp_path):
    df = spark.createDataFrame([], "a string, `b,c` string")
    sinks.write_csv_file(df, f"{tmp_path}/x.csv", ["a", "b,c"])
    assert tables.read_csv(spark, f"{tmp_path}/x.csv").columns == ["a", "b,c"]
