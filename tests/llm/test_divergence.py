"""The source audit against brute force; rounds, cells and shares one by one."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanworks.llm import common, divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(rows, min_docs=10, top=10):
    """rows: (lang, source, text)."""
    df, n, of_lang, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source, found = lang or "", source or "", terms(text)
        groups.add((lang, source))
        df[lang].update(set(found))
        n[lang, source].update(found)
        of_lang[lang].update(found)
    out = []
    for lang, source in groups:
        kept = [t for t, k in df[lang].items() if k >= min_docs]
        total = lambda c: sum(c[t] for t in kept)  # noqa: E731, B023
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (total(c) + 2 * len(kept)) for t in kept}  # noqa: E731, B023
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        p, q = share(n[lang, source]), share(of_lang[lang])
        pairs = []
        for other in [s for k, s in groups if k == lang and s != source]:
            o = share(n[lang, other])
            pairs.append((other, sum(gap(p[t], o[t]) for t in kept)))
        ahead = [(t, gap(p[t], q[t])) for t in kept if n[lang, source][t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", ahead, top)):
            found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found)]
    return sorted(out)


def made_rows():
    r = random.Random(2)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)] + ["Été", "été", "naïve", "日本"]
    rows = []
    for lang, sources in (("en", 11), ("de", 4), ("fr", 1), ("xx", 6)):
        for s in range(sources):
            mine = r.sample(words, 40) if lang != "xx" else [f"only{s}"]
            for _ in range(r.randint(3, 9) if lang != "xx" else 1):
                rows.append((lang, f"s{s}", " ".join(r.choice(mine).upper() if r.random() < 0.2 else r.choice(mine) for _ in range(r.randint(0, 30)))))
    rows += [(None, None, "alpha beta"), ("", "", "alpha"), ("", None, None), (None, "s1", "")] * 4
    rows += [("en", "silent", None), ("en", "silent", "12 34 !?"), ("de", "long", "wort " * 30_000), ("en", "ß", "waa waa2waa_waa")]
    return rows + rows[:3]


def frame(spark, rows):
    return spark.createDataFrame([(*x, "clash", 1, 2) for x in rows], "lang string, source string, text string, term string, g int, block int").repartition(6)


@pytest.mark.parametrize(("block", "cell", "held", "heavy"), [(4, 1 << 17, 1 << 18, 4096), (1, 8, 7, 1), (2, 64, 1 << 18, 3)])
def test_against_brute_force(spark, monkeypatch, block, cell, held, heavy):
    monkeypatch.setattr(common, "HEAVY_KEYS", heavy)
    rows, rounds = made_rows(), []
    got = divergence.divergence(frame(spark, rows), block_groups=block, cell_entries=cell, held_terms=held, rounds=rounds)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    n = -(-13 // block)  # blocks of "en": 11 sources, "silent" and a sharp s
    assert len(rounds) == (n + n % 2 if n > 1 else 1) and all(rounds[1 if block == 1 else 0 :])


def test_other_thresholds_and_no_kept_terms(spark):
    rows = made_rows()
    for min_docs, top in ((1, 3), (10_000, 10)):
        got = divergence.divergence(frame(spark, rows), min_docs=min_docs, top=top)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, min_docs, top)


def test_empty_table(spark):
    df = divergence.divergence(spark.createDataFrame([], "lang string, source string, text string"))
    assert df.collect() == [] and df.columns == ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("n", range(2, 12))
def test_every_two_blocks_meet_once(spark, n):
    df = spark.range(n).select(F.col("id").alias("a"), F.lit(n).cast("long").alias("n"))
    met = Counter()
    for r in range(1, n + n % 2):
        pairs = {(x.a, x.b) for x in df.select("a", divergence.opponent(r, F.col("a"), F.col("n")).alias("b")).collect() if x.b is not None}
        assert pairs == {(b, a) for a, b in pairs}
        met.update({tuple(sorted(p)) for p in pairs})
    assert met == Counter({p: 1 for p in combinations(range(n), 2)})


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**12), st.integers(0, 10**12), st.integers(1, 10**9))
def test_shares_are_exact(count, more, kept):
    got = divergence.shares(np.array([count]), np.array([count + more]), np.array([kept]))
    assert got[0] == 1 + 10**9 * (count + 2) // (count + more + 2 * kept)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 19), st.integers(1, 10**9 + 1), max_size=20), min_size=1, max_size=4), st.integers(0, 2))
def test_cells_meet_exactly(vectors, shift):
    absent = [7 + 1000 * k for k in range(len(vectors))]

    def cell(at):
        parts = [(np.array(sorted(v), np.int64), np.array([v[t] for t in sorted(v)], np.int64)) for v in vectors]
        return divergence.pack(np.arange(at, at + len(vectors)), np.array(absent), 20, parts)

    home, peer = cell(0), cell(100 * shift)
    want = []
    for i, v in enumerate(vectors):
        for j, w in enumerate(vectors):
            if shift or j > i:
                value = sum((v.get(t, absent[i]) - w.get(t, absent[j])) ** 2 // (v.get(t, absent[i]) + w.get(t, absent[j])) for t in range(20))
                want += [(i, j + 100 * shift, value), (j + 100 * shift, i, value)]
    assert sorted(divergence.meet(home, peer)) == sorted(want)


def test_residents_are_not_shuffled_again(spark, monkeypatch):
    """In a round only the visitors move: one exchange beside the residents' cached partitions."""
    plans, kind = [], type(spark.range(1))
    run = kind.mapInArrow

    def spy(self, *a, **b):
        if self.columns == ["body", "peer"]:
            plans.append(self._jdf.queryExecution().executedPlan().toString())
        return run(self, *a, **b)

    monkeypatch.setattr(kind, "mapInArrow", spy)
    divergence.divergence(frame(spark, made_rows()))
    assert len(plans) == 4
    for plan in plans[1:]:
        top = [line for line in plan.splitlines() if not re.search(r"^[ :]*\+- .*InMemoryRelation", line)]
        cached = plan[plan.index("InMemoryRelation") :].split("\n")[1:]
        depth = len(re.match(r"[ :]*", cached[0])[0])
        inside = 0
        for line in cached:
            if len(re.match(r"[ :]*", line)[0]) < depth:
                break
            inside += "Exchange hashpartitioning" in line
        assert "SortMergeJoin" in plan and sum("Exchange hashpartitioning" in line for line in top) - inside == 1, plan


def test_query(spark, sf_dir):
    rows = [(d.lang, d.source, d.text) for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in divergence.op12_divergence(spark, sf_dir).collect()) == brute(rows)
