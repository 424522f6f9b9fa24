"""Compression classifier: held-out accuracy, independence of labels, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
import zstandard

from gleanworks.llm import quality


def test_query_scores_all_and_separates_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in quality.op5_quality(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    held = [(got[i].predicted, q) for i, q in labels if i in got and got[i].held_out]
    good = [p for p, q in held if q == 1]
    bad = [p for p, q in held if q == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.05


def test_held_out_labels_do_not_matter(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    a = quality.fit(docs, labels.where(quality.learnable()))
    flipped = labels.selectExpr("doc_id", "case when pmod(crc32(cast(doc_id as string)), 4) = 2 then 1 - quality else quality end as quality")
    b = quality.fit(docs, flipped.where(quality.learnable()))
    assert (a.good, a.bad, a.weight, a.intercept) == (b.good, b.bad, b.weight, b.intercept)


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (None, "a b", 9.0), (3, "word " * 60_000, 9.0), (3, "word " * 60_000, 9.0)], "doc_id long, text string, score double")
    none = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r.s for r in quality.score(docs, none, score_col="s").collect()] == [0.5] * 5
    odd = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (3, 1), (3, 0)], "doc_id long, quality int")
    model = quality.fit(docs, odd)
    rows = quality.score(docs, model, score_col="s").collect()
    assert rows[0].s == rows[1].s and rows[3].s == rows[4].s and all(0 <= r.s <= 1 for r in rows)
    assert quality.score(docs.limit(0), model, score_col="s").count() == 0
    for taken in ("score", "Score"):
        with pytest.raises(ValueError, match="already"):
            quality.score(docs, model, score_col=taken)


def test_query_against_plain_code(spark, sf_dir):
    """Samples, dictionaries, calibration and scores of the whole query, worked out again without Spark."""
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    hashes = {r.id: (r.h, r.part) for r in spark.createDataFrame([(i,) for i in labels], "id long").selectExpr("id", "xxhash64(id) h", "pmod(xxhash64(id, 'part'), 2) part").collect()}
    group = lambda p, q: [docs[i] for i in sorted((i for i in labels if i in docs and labels[i] == q and hashes[i][1] == p), key=lambda i: (hashes[i][0], i))]
    assert all(len(t) <= quality.SAMPLE_BYTES // 8 for t in docs.values()) and sum(map(len, docs.values())) < quality.SAMPLE_BYTES  # so nothing is left out here

    def coder(texts):
        content = zstandard.ZstdCompressionDict(quality._dictionary(list(dict.fromkeys(texts))))
        return lambda block: len(zstandard.ZstdCompressor(level=3, dict_data=content, write_content_size=False, write_dict_id=False).compress(block))

    by_good, by_bad = coder(group(0, 1)), coder(group(0, 0))

    def difference(t):
        blocks = [t[k : k + 512] for k in range(0, len(t), 512)]
        return (sum(by_bad(b) - by_good(b) for b in blocks) + 4.0) / (len(t) + 24.0)

    good, bad = group(1, 1) or group(0, 1), group(1, 0) or group(0, 0)
    x, y = np.array([difference(t) for t in good + bad]), np.array([1.0] * len(good) + [0.0] * len(bad))
    target = np.where(y == 1, (len(good) + 1) / (len(good) + 2), 1 / (len(bad) + 2))
    mean, scale, w = x.mean(), x.std() or 1.0, np.zeros(2)
    for _ in range(20_000):  # plain gradient descent on the penalised loss
        z = w[0] * (x - mean) / scale + w[1]
        gap = 1 / (1 + np.exp(-z)) - target
        w = w - 2.0 / len(x) * (np.array([(gap * (x - mean) / scale).sum(), gap.sum()]) + 1e-3 * w)
    n1, n0 = sum(q == 1 for q in labels.values()), sum(q == 0 for q in labels.values())
    lift = np.log((n1 + 1) / (n0 + 1) * len(bad) / len(good))
    for r in quality.op5_quality(spark, sf_dir).collect():
        z = w[0] * (difference(docs[r.doc_id]) - mean) / scale + w[1] + lift
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 2e-3 and r.predicted == int(r.score >= 0.7), r
