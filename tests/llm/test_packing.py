"""Best-fit packing: against brute force, capacity, conflicts and wholeness."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from gleanworks.llm import packing


def brute_best_fit(items, capacity, limit):
    bins = []
    out = []
    for n, s, c in items:
        fits = [
            (b["left"], k)
            for k, b in enumerate(bins)
            if n <= b["left"] and (s is None or b["s"][s] < limit) and (c is None or c not in b["c"])
        ]
        if fits:
            k = min(fits)[1]
        else:
            k = len(bins)
            bins.append({"left": capacity, "s": Counter(), "c": set()})
        out.append((k, capacity - bins[k]["left"]))
        bins[k]["left"] -= n
        bins[k]["s"][s] += 1
        bins[k]["c"].add(c)
    return out, len(bins)


def test_best_fit_is_tightest_compatible():
    for seed in range(40):
        r = random.Random(seed)
        items = [(r.randint(0, 50), r.choice([None, 1, 1, 1, 2, 3]), r.choice([None, *range(8)])) for _ in range(120)]
        for limit in (1, 3):
            assert packing.best_fit(items, 50, limit) == brute_best_fit(items, 50, limit)


def check(rows, out, capacity, limit):
    by_bin, pieces = defaultdict(list), defaultdict(list)
    for x in out:
        by_bin[x.bin_id].append(x)
        pieces[x.doc_id].append(x)
    for held in by_bin.values():
        assert sum(x.length for x in held) <= capacity
        at = 0
        for x in sorted(held, key=lambda x: (x.bin_offset, x.length)):
            assert x.bin_offset == at
            at += x.length
        assert all(n <= limit for s, n in Counter(x.source for x in held).items() if s is not None)
        assert all(n == 1 for c, n in Counter(x.cluster for x in held).items() if c is not None)
    want = Counter()
    for i, n, *_ in rows:
        want[i] += max(n or 0, 0)
    assert {i: sum(x.length for x in p) for i, p in pieces.items()} == dict(want)


def test_pack_keeps_all_rows_within_limits(spark):
    r = random.Random(1)
    rows = [(k, r.choice([None, -1, 0, 5, 99, 100, 101, 250, r.randint(1, 100)]), r.choice(["hot", "hot", None, "b", "c"]), r.choice([None, 1, 1, k])) for k in range(500)]
    rows += [(None, 10, "hot", 1), (None, 10, "hot", 1), (7, 30, "b", None)]
    df = spark.createDataFrame([(*x, 5) for x in rows], "doc_id long, n int, source string, cluster long, length int")
    for pack_rows in (50, 10_000):
        out = packing.pack(df, "n", cluster_col="cluster", capacity=100, source_limit=2, pack_rows=pack_rows).collect()
        check(rows, out, 100, 2)
        assert Counter(x.doc_id for x in out if x.piece == 0) == Counter(x[0] for x in rows)


def test_missing_source_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: (r.length, r.source, r.cluster is None) for r in packing.pack_documents(df).collect()}
    assert got == {1: (3, None, False), 2: (0, None, True), 3: (0, None, True)}
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_query_is_whole_and_tight(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = packing.op3_packing(spark, sf_dir).collect()
    rows = [(r.doc_id, len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", r.text) if w])) for r in docs.collect()]
    check(rows, out, packing.CAPACITY, packing.SOURCE_LIMIT)
    assert docs.select(F.sum(packing.word_count("text"))).first()[0] == sum(n for _, n in rows)


def test_empty_pieces_go_to_the_tightest_bin():
    assert packing.best_fit([(100, None, None), (0, None, None)], 100, 4) == ([(0, 0), (0, 100)], 1)
