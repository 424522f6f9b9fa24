"""Vector codes against brute force; the radius and the ties one by one."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanworks.llm import common, exponion


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """rows: (id, vector, label) in the order of ids; codes and errors by row, and the codebooks."""
    ok = [(i, [math.floor(scale * float(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(ok[0][1]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, v, _ in ok]
    first = sorted(range(len(ok)), key=lambda k: (ok[k][0] is None, ok[k][0] or 0, ok[k][1]))[:entries]
    books = [[list(cut[k][p]) for k in first] for p in range(parts)]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        codes = [[min((d2(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]
        if turn == rounds:
            break
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, code in zip(cut, codes, strict=True) if code[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return [(i, [k for _, k in code], sum(d for d, _ in code), lab) for (i, _, lab), code in zip(ok, codes, strict=True)], books


def made(n=90, dim=8):
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, dim))
    rows = [(k, (centres[k % 6] + 0.1 * r.normal(size=dim)).astype(np.float32).tolist(), [0, 1, None][k % 3]) for k in range(n)]
    rows += [(n + k, [0.0] * dim, 5) for k in range(4)] + [(3, rows[3][1], 1), (3, rows[4][1], 1), (None, rows[5][1], None), (None, None, 2)]
    rows += [(500, None, 0), (501, [None, *rows[0][1][1:]], 0), (502, [float("nan"), *rows[0][1][1:]], 1), (503, [float("-inf"), *rows[0][1][1:]], 1)]
    return rows


@pytest.mark.parametrize(("entries", "rounds", "parts"), [(16, 4, 4), (256, 4, 4), (1, 2, 2), (40, 0, 1)])
def test_against_brute_force(spark, entries, rounds, parts):
    rows = made()
    df = spark.createDataFrame([(i, v, lab, "clash", 1) for i, v, lab in rows], "vec_id long, embedding array<float>, label int, code string, v int").repartition(3)
    got, books = exponion.compress(df, keep=("label", "v"), entries=entries, rounds=rounds, parts=parts)
    want, want_books = brute(rows, parts, entries, rounds)
    assert sorted(((r.vec_id, list(r.code), r.error, r.label) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert [b.tolist() for b in books] == want_books and got.columns == ["vec_id", "label", "v", "code", "error"]


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 70), st.integers(1, 5), st.integers(1, 40))
def test_search_is_exact_from_any_start(seed, k, dim, spread):
    r = np.random.default_rng(seed)
    book, x = r.integers(-spread, spread + 1, (k, dim)), r.integers(-spread, spread + 1, (200, dim))  # many ties and equal entries
    at, best = exponion.Entries(book).nearest(x, r.integers(0, k, len(x)))
    d = ((x[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    assert at.tolist() == d.argmin(axis=1).tolist() and best.tolist() == d.min(axis=1).tolist()


def test_long_arithmetic_beyond_doubles():
    r = np.random.default_rng(4)
    book, x = r.integers(-(1 << 28), 1 << 28, (20, 4)), r.integers(-(1 << 28), 1 << 28, (50, 4))
    at, best = exponion.Entries(book).nearest(x, np.zeros(50, np.int64))
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, e, strict=True)) for e in book] for v in x]
    assert best.tolist() == [min(d) for d in exact] and at.tolist() == [d.index(min(d)) for d in exact]


def test_radius_saves_distances():
    r = np.random.default_rng(5)
    book = r.integers(-1000, 1000, (256, 8))
    true = r.integers(0, 256, 5000)
    search = exponion.Entries(book)
    at, _ = search.nearest(book[true] + r.integers(-20, 21, (5000, 8)), true)
    assert (at == true).all() and search.scanned < 0.2 * 5000 * 256


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    got, books = exponion.compress(spark.createDataFrame([], schema), keep=("label",))
    assert got.collect() == [] and got.columns == ["vec_id", "label", "code", "error"] and [b.size for b in books] == [0] * 4
    none = spark.createDataFrame([(1, None, 1), (2, [], 1), (3, [1.0, 2.0], 1)], schema)
    assert exponion.compress(none)[0].collect() == []
    mixed = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0] * 4, 1), (3, [2.0] * 4, 1), (4, [2.0] * 8, 1)], schema)
    assert sorted(r.vec_id for r in exponion.compress(mixed)[0].collect()) == [2, 3]
    with pytest.raises(ValueError, match="too large"):
        exponion.compress(spark.createDataFrame([(1, [3e38] * 4, 1)], schema))


@pytest.mark.parametrize("heavy", [1, 4096])
def test_query(spark, sf_dir, monkeypatch, heavy):
    monkeypatch.setattr(common, "HEAVY_KEYS", heavy)
    rows = sorted((r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect())
    want, books = brute(rows)
    of = {}
    for _, _, e, lab in want:
        of[lab] = of.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for v in b for x in v).encode()).hexdigest()
    got = {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in exponion.op13_codes(spark, sf_dir).collect()}
    assert got == {i: ("".join(f"{k:02x}" for k in code), e, of[lab], sha) for i, code, e, lab in want}
