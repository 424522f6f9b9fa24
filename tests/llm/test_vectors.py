"""Product quantisation and the vector-approximation file against brute force."""

from __future__ import annotations

import math

import numpy as np

from gleanworks.llm import quantised, vafile

CLASH = "vec_id long, embedding array<float>, label int, gid string, row string, v string"


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b))


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def brute_links(rows, threshold=0.93):
    n = len(rows)
    ok = [good(v) and any(v) and lab is not None for _, v, lab in rows]
    links = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and cosine(rows[i][1], rows[j][1]) >= threshold:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        comp = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), comp, rows[i][0] is not None and rows[i][0] == comp))
    return out


def near_rows(dim=12, n=60):
    r = np.random.default_rng(5)
    rows, k = [], 0
    for _ in range(n):
        base = r.normal(size=dim)
        for _ in range(int(r.integers(1, 5))):
            rows.append((k, (base * r.uniform(0.1, 9) + r.normal(size=dim) * 0.3).astype(np.float32).tolist(), int(r.integers(0, 2))))
            k += 1
    clump = r.normal(size=dim)
    rows += [(k + j, (clump + r.normal(size=dim) * 0.05).astype(np.float32).tolist(), 1) for j in range(60)]
    same = rows[3][1]
    rows += [(1000, same, rows[3][2]), (1000, same, rows[3][2]), (1001, same, None), (None, same, rows[3][2]), (1002, same[:5], 0), (1003, same[:5], 0)]
    rows += [(1004, None, 0), (1005, [0.0] * dim, 0), (1006, [float("nan"), *same[1:]], 0), (1007, [None, *same[1:]], 0), (1008, [], 0), (1009, [float("inf"), *same[1:]], 1)]
    return [*rows, (1010, [3e38] * dim, 0), (1011, [1e38] * dim, 0)]


def test_near_duplicates_against_brute_force(spark):
    rows = near_rows()
    df = spark.createDataFrame([(*x, "a", "b", "c") for x in rows], CLASH)
    want = sorted(brute_links(rows), key=repr)
    for settings in ({}, {"list_rows": 20, "block_rows": 16, "sample_rows": 40}):
        got = sorted((tuple(r) for r in quantised.near_duplicate_vectors(df, **settings).collect()), key=repr)
        assert got == want


def test_near_duplicates_of_nothing(spark):
    assert quantised.near_duplicate_vectors(spark.createDataFrame([], CLASH)).count() == 0
    df = spark.createDataFrame([(1, None, 1, "", "", ""), (None, [0.0], 1, "", "", "")], CLASH)
    assert sorted(map(repr, map(tuple, quantised.near_duplicate_vectors(df).collect()))) == sorted(map(repr, [(1, 0, 1, True), (None, 0, None, False)]))


def test_recall_of_probes_and_table_distances():
    r = np.random.default_rng(1)
    x = quantised.unit(r.normal(size=(600, 16)))
    model = quantised.Quantiser.fit(x[:100], 12)
    own, codes, lost = model.encode(x)
    radius = math.sqrt(2 - 2 * 0.7)
    probes = model.probes(x, own, radius)
    assert sum(map(len, probes)) < 600 * len(model.coarse)
    for i, j in zip(*np.nonzero(x @ x.T >= 0.7), strict=True):
        assert own[j] in probes[i]
        d = sum(t[0, c] for t, c in zip(model.tables(x[i : i + 1], own[j]), codes[j], strict=True))
        assert math.sqrt(max(0, d)) <= radius + lost[j] + 1e-4


def brute_top(rows, step, k=5):
    out = []
    ints = [(i, [math.floor(256 * x) for x in v]) if good(v) and i is not None else None for i, v, _ in rows]
    for a, q in enumerate(ints):
        if q is None or q[0] % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q[1], c[1], strict=True)), c[0]) for b, c in enumerate(ints) if c and b != a and len(c[1]) == len(q[1]))
        out += [(q[0], n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_search_against_brute_force(spark):
    rows = [x for x in near_rows() if not x[1] or max(abs(v or 0) for v in x[1]) < 1e6]
    rows += [(2000 + k, rows[0][1], 0) for k in range(9)]
    df = spark.createDataFrame([(*x, "a", "b", "c") for x in rows], CLASH)
    for block in (2048, 17):
        got = sorted(tuple(r) for r in vafile.top_k(df, lambda i: i % 4 == 0, block_rows=block).collect())
        assert got == brute_top(rows, 4)


def test_search_with_large_values_few_rows_and_none(spark):
    rows = [(0, [1e15, -1.0], 0), (1, [3.0, 1e12], 0), (2, [float("inf"), 0.0], 0), (None, [1.0, 1.0], 0)]
    df = spark.createDataFrame([(*x, "", "", "") for x in rows], "vec_id long, embedding array<double>, label int, a string, b string, c string")
    assert sorted(tuple(r) for r in vafile.top_k(df, lambda i: i % 2 == 0).collect()) == [(i, n, j, min(s, (1 << 63) - 1)) for i, n, j, s in brute_top(rows, 2)]
    assert vafile.top_k(df.limit(0), lambda i: i % 2 == 0).count() == 0


def test_scores_of_many_large_components_are_exact(spark):
    r = np.random.default_rng(4)
    top = (1 << 22) - 1
    v = r.integers(top - 3, top, size=(12, 2048))
    rows = [(k, [float(x) / 256 for x in row], 0) for k, row in enumerate(v)]
    df = spark.createDataFrame([(*x, "", "", "") for x in rows], "vec_id long, embedding array<double>, label int, a string, b string, c string")
    assert sorted(tuple(x) for x in vafile.top_k(df, lambda i: i % 4 == 0).collect()) == brute_top(rows, 4)


def test_queries_against_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(map(tuple, quantised.op4_vectors(spark, sf_dir).collect())) == sorted(brute_links(rows))
    assert sorted(map(tuple, vafile.op8_search(spark, sf_dir).collect())) == brute_top(rows, 50)
