"""The pipeline: stages in order, each stage's decisions, the packed result."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from gleanworks.llm import packing, quality, secrets
from gleanworks.llm.common import scratch_path
from tests.llm.test_secrets import brute_base
from tests.llm.test_similar import brute_survivors


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, held[-1], sf_dir).write.parquet(path)
        held.append(spark.read.parquet(path))
    assert all(h.columns == docs.columns for h in held[:-1])
    rows = [h.collect() for h in held]
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(quality.learnable()))
    assert {r.doc_id for r in rows[1]} == {r.doc_id for r in rows[0] if model.score(r.text.encode()) >= 0.7}
    near = [(r.doc_id, r.text) for r in rows[1]]
    assert sorted(r.doc_id for r in rows[2]) == brute_survivors(near)
    clean = {r.doc_id: r for r in rows[3]}
    for r in rows[2]:
        assert not brute_base(clean[r.doc_id].text.replace(secrets.MARK, "\x01")) and clean[r.doc_id].n_chars == len(clean[r.doc_id].text)
    copies = Counter(r.doc_id for r in rows[4])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = lambda toxic: [copies[r.doc_id] for r in rows[3] if labels.get(r.doc_id) == toxic]
    assert sum(kept(0)) / len(kept(0)) > 0.9 > sum(kept(1)) / len(kept(1))
    words = Counter()
    for r in rows[4]:
        words[r.doc_id] += len([w for w in re.split(r"[\x20\x09-\x0D]+", r.text) if w])
    packed = Counter()
    for r in rows[5]:
        packed[r.doc_id] += r.length
    assert +packed == +words
    bins = Counter()
    for r in rows[5]:
        bins[r.bin_id] += r.length
    assert max(bins.values()) <= packing.CAPACITY


def test_run_on_the_smallest_tables(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_odd_documents_pass_all_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("score_", F.lit(7)).withColumn("copies_", F.lit("x")).withColumn("k1_", F.lit(1)).withColumn("gid", F.lit(2))
    odd = [(None, None, None, None, None), (None, "", "en", "s", 0), (-1, "word " * 40_000, "en", None, 3), (-1, "word " * 40_000, "en", None, 3)]
    odd = spark.createDataFrame([(*x, 7, "x", 1, 2) for x in odd], docs.schema)
    for some in (docs.unionByName(odd), odd, docs.limit(0)):
        held, path = some, None
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = f"{tmp_path}/{some.count()}-{name.replace(' ', '-')}"
            stage(spark, held, sf_dir).write.parquet(path)
            held = spark.read.parquet(path)
            assert held.columns == docs.columns
        assert held.where("score_ <> 7 or copies_ <> 'x' or k1_ <> 1 or gid <> 2").count() == 0
        corpus_pipeline.STAGES[-1][1](spark, held, sf_dir).count()


def test_quality_stage_needs_both_classes(spark, tmp_path):
    docs = spark.createDataFrame([(1, "good text"), (2, None)], "doc_id long, text string")
    for name, rows in (("none", []), ("one", [(k, 1, 0) for k in range(1, 9)])):
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        assert corpus_pipeline.quality_stage(spark, docs, f"{tmp_path}/{name}").count() == 2
