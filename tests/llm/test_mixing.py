"""Mixing: classifier, rates against a plain solver, targets met."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanworks.llm import mixing


def test_rates_match_a_plain_projected_gradient(spark):
    r = np.random.default_rng(2)
    p = r.dirichlet([0.4, 0.4, 0.4], size=400)
    t = r.integers(0, 500, size=400)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p, strict=True)], "t long, p array<double>").repartition(3)
    totals = (t[:, None] * p).sum(axis=0)
    targets = np.array([0.7, 0.25, 0.05]) * totals.sum()
    results = [mixing.fit_rates(df, "t", "p", targets, "r", tolerance=1e-7, replay=n) for n in (3, 1000)]
    for rated, residual, _, met in results:
        assert met and np.abs(residual).max() <= 1e-7 * targets.sum()
    by_row = [{(x.t, *x.p): x.r for x in rated.collect()} for rated, _, _, _ in results]
    rates = np.array([by_row[0][int(a), *b] for a, b in zip(t, p.tolist(), strict=True)])
    assert (rates >= 0).all() and np.allclose(rates, [by_row[1][int(a), *b] for a, b in zip(t, p.tolist(), strict=True)])
    plain, rate_step = np.ones(400), 1 / np.linalg.eigvalsh((p * t[:, None]).T @ p)[-1]
    for _ in range(20_000):
        plain = np.maximum(0, plain - rate_step * (p @ ((plain * t) @ p - targets)))
    assert np.abs((plain * t) @ p - (rates * t) @ p).max() < 1e-4 * targets.sum()


def test_targets_out_of_reach_settle_and_too_few_passes_are_an_error(spark):
    df = spark.createDataFrame([(10, [0.9, 0.1]), (10, [0.8, 0.2])], "t long, p array<double>")
    rated, residual, _, met = mixing.fit_rates(df, "t", "p", np.array([0.0, 20.0]), "r")
    p, targets = np.array([[0.9, 0.1], [0.8, 0.2]]), np.array([0.0, 20.0])
    gram = 10 * p.T @ p
    metric = np.linalg.inv(gram + 1e-3 * np.linalg.eigvalsh(gram)[-1] * np.eye(2))
    loss = lambda r: (10 * r @ p - targets) @ metric @ (10 * r @ p - targets)
    best = min(loss(np.array([a, b])) for a in np.linspace(0, 12, 241) for b in np.linspace(0, 12, 241))
    got = np.array([x.r for x in sorted(rated.collect(), key=lambda x: -x.p[0])])
    assert not met and np.allclose(10 * got @ p - targets, residual) and loss(got) <= 1.01 * best
    with pytest.raises(RuntimeError):
        mixing.fit_rates(df, "t", "p", np.array([0.0, 20.0]), "r", passes=3)


def plain_posterior(model, text):
    """The classifier's posterior by loops over words."""
    found = (text or "").encode().lower().split()
    k, sums, top = len(model.names), [0.0] * len(model.names), [None] * len(model.names)
    for w in found:
        if w in model.weights:
            for d in range(k):
                sums[d] += model.weights[w][d] / len(found)
                top[d] = model.weights[w][d] if top[d] is None else max(top[d], model.weights[w][d])
    x = [*sums, *[v or 0.0 for v in top]]
    z = [sum((x[i] - model.centre[i]) / model.scale[i] * model.curve[i][d] for i in range(2 * k)) + model.curve[-1][d] for d in range(k)]
    e = [math.exp(v - max(z)) for v in z]
    return len(found), [v / sum(e) for v in e]


def test_whole_query_against_plain_code(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    names = ["q0t0", "q0t1", "q1t0", "q1t1"]
    model = mixing.learn_domains(docs, labels, mixing.domain_of_labels(), names)
    got = {r.doc_id: r for r in mixing.op7_mixing(spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(got) == set(texts)
    totals, at_rates = np.zeros(4), np.zeros(4)
    for i, t in texts.items():
        n, p = plain_posterior(model, t)
        assert got[i].tokens == n and np.allclose([got[i][f"p_{x}"] for x in names], p, atol=1e-9)
        assert got[i].rate >= 0 and got[i].copies in (math.floor(got[i].rate), math.floor(got[i].rate) + 1)
        totals += n * np.array(p)
        at_rates += got[i].rate * n * np.array(p)
    want = np.array([mixing.TARGETS[x] for x in names]) / sum(mixing.TARGETS.values())
    targets = np.minimum(want * totals[2] / want[2], totals)
    any_row = next(iter(got.values()))
    assert np.allclose([any_row[f"target_{x}"] for x in names], targets, rtol=1e-9)
    assert np.allclose([any_row[f"residual_{x}"] for x in names], at_rates - targets, atol=1e-6 * targets.sum())
    assert np.abs(at_rates - targets).max() <= mixing.TOLERANCE * targets.sum()


def test_mixed_rows_are_repeated_as_told(spark):
    r = np.random.default_rng(9)
    rows = [(k % 90 if k else None, " ".join(f"{'bad' if k % 3 == 0 else 'w'}{x}" for x in r.integers(0, 60, 20)), k, "c") for k in range(300)] + [(5, None, 1, "d"), (5, None, 2, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, copies_ int, col string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(90)], "doc_id long, toxic int")
    told, _ = mixing.mix(docs, labels, F.col("toxic").cast("string"), {"0": 0.95, "1": 0.05})
    want = sorted(repr((x.doc_id, x.copies_, x.col)) for x in told.collect() for _ in range(x.copies__))
    got = mixing.mixed(docs, labels, F.col("toxic").cast("string"), {"0": 0.95, "1": 0.05})
    assert got.columns == docs.columns and sorted(repr((x.doc_id, x.copies_, x.col)) for x in got.collect()) == want
    upper = docs.withColumnRenamed("copies_", "COPIES_")
    again = mixing.mixed(upper, labels, F.col("toxic").cast("string"), {"0": 0.95, "1": 0.05})
    assert again.columns == upper.columns and again.count() == len(want)
    assert mixing.mixed(docs.limit(0), labels, F.col("toxic").cast("string"), {"0": 0.95, "1": 0.05}).count() == 0


def test_query_meets_targets_and_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rated, told = mixing.mix(docs, labels, mixing.domain_of_labels(), mixing.TARGETS)
    c = told["columns"]
    rows = rated.collect()
    assert len(rows) == docs.count()
    p, rate, t = (np.array([r[c[k]] for r in rows], float) for k in ("posterior", "rate", "tokens"))
    assert np.allclose((rate * t) @ p, told["targets"], atol=2 * mixing.TOLERANCE * told["targets"].sum()) and (rate >= 0).all()
    truth = {r.doc_id: f"q{r.quality}t{r.toxic}" for r in labels.collect()}
    hits = [told["domains"][int(np.argmax(x))] == truth[r.doc_id] for r, x in zip(rows, p, strict=True) if r.doc_id in truth]
    assert np.mean(hits) > 0.9
    copies = sum(r[c["copies"]] * r[c["tokens"]] for r in rows)
    assert abs(copies / told["targets"].sum() - 1) < 0.1


def test_a_rare_domain_drops_nothing_of_the_others(spark):
    shares = np.array([0.95, 0.05])
    for rare in (0, 0.0005, 0.0009, 0.0011, 0.005, 0.02, 0.05, 0.12, 0.5):
        totals = np.array([1 - rare, rare]) * 1e6
        targets = mixing.targets_for(totals, shares)
        assert np.allclose(targets, [totals[0], min(totals[1], totals[0] / 19)])
    assert np.allclose(mixing.targets_for(totals, shares, 1000.0), [950, 50])
    r = np.random.default_rng(5)
    for toxic in (1, 10, 40):  # 0.05, 0.5 and 2 % of 2,000 documents
        text = lambda k: " ".join(f"{'bad' if k < toxic else 'w'}{x}" for x in r.integers(0, 200, 40))  # noqa: B023, E731
        docs = spark.createDataFrame([(k, text(k)) for k in range(2000)], "doc_id long, text string")
        labels = spark.createDataFrame([(k, int(k < toxic)) for k in range(2000)], "doc_id long, toxic int")
        rated, told = mixing.mix(docs, labels, F.col("toxic").cast("string"), {"0": 0.95, "1": 0.05})
        clean = [x[told["columns"]["copies"]] for x in rated.where(f"doc_id >= {toxic}").collect()]
        assert np.mean(clean) > 0.99 and told["unfilled"][0] == 0 < told["unfilled"][1]


def test_every_domain_of_labels_is_told_apart(spark):
    r = np.random.default_rng(6)
    truth = ["q1t0"] * 400 + ["q0t0"] * 60 + ["q1t1"] * 60 + ["q0t1"] * 60
    docs = spark.createDataFrame([(k, " ".join(f"{n}{x}" for x in r.integers(0, 100, 30))) for k, n in enumerate(truth)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(n[1]), int(n[3])) for k, n in enumerate(truth)], "doc_id long, quality int, toxic int")
    for shares in (mixing.TARGETS, {"q0t0": 0.04, "q1t0": 0.92, "q1t1": 0.04}):
        rated, told = mixing.mix(docs, labels, mixing.domain_of_labels(), shares)
        assert told["domains"] == ["q0t0", "q0t1", "q1t0", "q1t1"]
        assert np.allclose(told["totals"], [1800, 1800, 12000, 1800], atol=150)
        odd = np.mean([x["rate_"] for x in rated.where("doc_id >= 520").collect()])
        assert abs(odd - told["targets"][1] / told["totals"][1]) < 0.02
    assert "q0t1" in mixing.TARGETS


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "a b", 1), (3, "bad " * 50_000, 1), (4, "fine text", 1), (4, "fine text", 1)], "doc_id long, text string, rate_ int")
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, 0), (None, 1), (1, None)], "doc_id long, toxic int")
    rated, told = mixing.mix(docs, labels, F.col("toxic").cast("string"), {"0": 0.5, "1": 0.5})
    rows = rated.collect()
    assert len(rows) == 6 and told["columns"]["rate"] == "rate__" and all(r["rate_"] == 1 for r in rows)
    none, told = mixing.mix(docs, labels.limit(0), F.col("toxic").cast("string"), {"0": 0.5, "1": 0.5})
    assert {round(r["posterior_"][0], 9) for r in none.collect()} == {0.5}
    assert mixing.mix(docs.limit(0), labels, F.col("toxic").cast("string"), {"0": 1.0, "1": 0.0})[0].count() == 0
