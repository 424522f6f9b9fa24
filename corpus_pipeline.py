"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that its predecessor kept and, but for the last, returns the columns
of ``documents``, whatever others there are. A stage's result is written as Parquet in the shared folder and read again by
the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.llm import mixing, packing, quality, secrets, similar
from gleanworks.llm.common import free_name, remove, scratch, scratch_path

#: Shares of the tokens by predicted toxicity.
TARGETS = {"0": 0.95, "1": 0.05}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go; none if labels don't show both classes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(quality.learnable())
    model = quality.fit(docs, labels)
    if not model.informed:
        return docs
    score = free_name(docs, "score_")
    return quality.score(docs, model, score_col=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: shingles of five words, similarity 0.8 or more."""
    return similar.near_duplicate_survivors(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; n_chars, if there is one, follows."""
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are kept, dropped or repeated at the rates that give the target shares."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixed(docs, labels, F.col("toxic").cast("string"), TARGETS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in bins of fixed length; copies never share a bin."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("secret scans", secrets_stage),
    ("mixing to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: The classifiers and the packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; a stage's result goes once the next one's is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: str | None = None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
