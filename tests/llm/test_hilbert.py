"""Hilbert order and shards: the curve, the laws of the shards, pruning."""

from __future__ import annotations

import itertools
import os
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from gleanworks.llm import hilbert
from gleanworks.llm.common import scratch_path


def test_curve_visits_each_cell_once_by_steps_of_one():
    for dims, bits in ((2, 4), (3, 3), (4, 2), (1, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        at = hilbert.hilbert_index(cells, bits)
        assert sorted(at) == list(range(len(cells)))
        path = cells[np.argsort(at)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(rows, out, shards):
    """rows: (doc_id, text)."""
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    counts = [len(slots.get(k, [])) for k in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=repr) == want
    order = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in order)


def test_shards_of_odd_rows(spark):
    rows = [(k, "t" * (k % 7), "en" if k % 3 else None, "hot" if k % 2 else f"s{k}", k) for k in range(101)]
    rows += [(None, None, None, None, None), (5, "é" * 50_000, "en", "hot", 1)] + [(7, "same", "en", "hot", 3)] * 40
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, lang string, source string, n_chars long, rank long, tie long")
    for shards in (40, 7, 300):
        check([x[:2] for x in rows], hilbert.hilbert_shards(df, shards).collect(), shards)
    assert hilbert.hilbert_shards(df.limit(0)).count() == 0
    check([x[:2] for x in rows], hilbert.hilbert_shards(df.select("doc_id", "text")).collect(), 40)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = hilbert.op6_sharding(spark, sf_dir).collect()
    check(rows, out, 40)
    assert {r.law for r in out} == {"rows"} and {r.grown_shard for r in out} == {None}


def turned(x, y, n):
    """The place of a cell on the plane's curve, by the usual turning of quadrants."""
    d, s = 0, n // 2
    while s:
        rx, ry = int(bool(x & s)), int(bool(y & s))
        d += s * s * ((3 * rx) ^ ry)
        if not ry:
            if rx:
                x, y = n - 1 - x, n - 1 - y
            x, y = y, x
        s //= 2
    return d


def test_plane_curve_is_the_independent_one():
    n = 16
    cells = np.array(list(itertools.product(range(n), repeat=2)))
    mine = hilbert.hilbert_index(cells, 4)
    others = {tuple(mine), *(tuple(n * n - 1 - mine) for _ in "r")}
    made = {tuple(turned(*(c if k == 0 else c[::-1]), n) for c in cells.tolist()) for k in (0, 1)}
    assert others & made


def long_named(spark, n=4000):
    r = np.random.default_rng(3)
    rows = [(k, "t" * int(r.integers(1, 9)), ["english", "englisch", "french", "spanish"][int(r.integers(0, 4))], f"https://example.org/common/prefix/source_{int(r.integers(0, 24)):04d}", int(r.integers(0, 10_000))) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_values_with_a_common_prefix_have_cells_of_their_own(spark):
    df = long_named(spark)
    at = hilbert.with_hilbert(df, ["source"], "at").select("source", "at").distinct().collect()
    assert len(at) == 24 == len({r["at"] for r in at}) and [r.source for r in sorted(at, key=lambda r: r["at"])] == sorted(r.source for r in at)
    assert hilbert.with_hilbert(df, ["lang"], "at").select("at").distinct().count() == 4
    hot = df.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "https://example.org/common/prefix/hot").otherwise(F.col("source")))
    assert hilbert.with_hilbert(hot, ["source"], "at").select("source", "at").distinct().groupBy("source").count().where("count > 1").count() == 0


def test_written_shards_prune_on_each_dimension(spark):
    docs = long_named(spark)
    path = scratch_path(spark, "shards")
    hilbert.write_shards(docs, path, shards=64)
    back = spark.read.parquet(path)
    assert back.count() == docs.count() and back.select(*docs.columns).exceptAll(docs).count() == 0
    # Rows of the runs whose least and greatest values let a filter in; in a random order all runs do.
    spans = back.groupBy("shard_").agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}_{w}") for c in ("lang", "source", "n_chars") for w, f in (("a", F.min), ("b", F.max))]).collect()
    assert max(s.n for s in spans) < 4 * 4000 / 64
    for column, value in (("source", "https://example.org/common/prefix/source_0007"), ("lang", "english"), ("n_chars", 5000)):
        read = sum(s.n for s in spans if s[f"{column}_a"] <= value <= s[f"{column}_b"])
        assert read < 0.5 * 4000, column


def test_rows_of_one_index_are_split(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "'x' as text", "'en' as lang", "'s' as source", "1L as n_chars")
    path = scratch_path(spark, "hot")
    hilbert.write_shards(docs, path, shards=8)
    counts = [r["count"] for r in spark.read.parquet(path).groupBy("shard_").count().collect()]
    assert len(counts) >= 6 and max(counts) < 700


def test_written_shards_of_an_empty_table_and_nulls(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, Curve_ int, shard_ string"
    hilbert.write_shards(spark.createDataFrame([], schema), f"{tmp_path}/none")
    assert not any(n.endswith(".parquet") for _, _, names in os.walk(f"{tmp_path}/none") for n in names)
    rows = [(k, None if k % 3 else "t", None if k % 2 else "en", None, None, k, "x") for k in range(20)] * 2
    hilbert.write_shards(spark.createDataFrame(rows, schema), f"{tmp_path}/some", shards=3)
    back = spark.read.parquet(f"{tmp_path}/some")
    assert sorted((tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars", "Curve_", "shard_")) for r in back.collect()), key=repr) == sorted(rows, key=repr)
