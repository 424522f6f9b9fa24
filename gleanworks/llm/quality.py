"""Quality classifier by compression.

One zstandard dictionary is trained from good and one from bad labelled text. A text is compressed
with each, block by block so that the dictionaries matter throughout, over its whole length. The
difference of the two sizes over the text's length, with a small prior for short texts, is turned
into a probability by a logistic curve fitted on other labelled rows and set to the classes' shares
of all labelled rows. Dictionaries are trained from distinct texts, so that groups of copies in the
sample don't crowd out others. The dictionaries are the only
model: labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.llm.common import labelled_texts, small_batches

BLOCK_BYTES = 512
DICT_BYTES = 64 * 1024
LEVEL = 3
THRESHOLD = 0.7
#: Bounds of the labelled sample, for each class and part (dictionary, calibration).
SAMPLE_DOCS = 3000
SAMPLE_BYTES = 12 << 20
_PRIOR_GAIN, _PRIOR_BYTES = 4.0, 24.0
_CODERS: dict[int, tuple] = {}


class Model:
    """Two dictionaries and the calibration curve's weight and intercept."""

    def __init__(self, good: bytes, bad: bytes, weight: float = 1.0, intercept: float = 0.0) -> None:
        self.good, self.bad, self.weight, self.intercept = good, bad, weight, intercept

    def _coders(self) -> tuple:
        key = hash((self.good, self.bad))
        if key not in _CODERS:
            coders = []
            for content in (self.good, self.bad):
                held = zstandard.ZstdCompressionDict(content)
                held.precompute_compress(level=LEVEL)
                coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False))
            _CODERS[key] = tuple(coders)
        return _CODERS[key]

    @property
    def informed(self) -> bool:
        """Whether rows of both classes were learned from; if not, every score is 0.5."""
        return self.weight != 0 or self.intercept != 0

    def difference(self, text: bytes) -> float:
        """Bytes that the good dictionary saves over the bad one, by byte of text."""
        by_good, by_bad = self._coders()
        gain = 0
        for k in range(0, len(text), BLOCK_BYTES):
            block = text[k : k + BLOCK_BYTES]
            gain += len(by_bad.compress(block)) - len(by_good.compress(block))
        return (gain + _PRIOR_GAIN) / (len(text) + _PRIOR_BYTES)

    def score(self, text: bytes | None) -> float:
        """The calibrated probability of label 1; null texts count as empty."""
        z = self.weight * self.difference(text or b"") + self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Weight and intercept by Newton's method, with targets drawn in a little from 0 and 1."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = x.std() or 1.0
    a = np.stack([(x - x.mean()) / scale, np.ones_like(x)], axis=1)
    w = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    loss = lambda v: float(np.sum(np.logaddexp(0, a @ v) - t * (a @ v)) + 0.5e-3 * v @ v)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        grad = a.T @ (p - t) + 1e-3 * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        step, size, now = np.linalg.solve(hess, grad), 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(step).max() * size < 1e-9:
            break
    return float(w[0] / scale), float(w[1] - w[0] * x.mean() / scale)


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; from too little text for training, the text itself."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return (b"\n".join(samples) or b"\n" * 16)[:DICT_BYTES].ljust(16, b"\n")


def sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, limit: int, max_bytes: int) -> dict[tuple[int, int], list[bytes]]:
    """Texts by (part, label), each of at most ``limit`` labelled rows and ``max_bytes`` bytes, in the order of a hash of the id.

    Part 0 makes dictionaries, part 1 the calibration. Texts of more than an eighth of the bytes are
    not learned from; a part ends before the first text that would exceed the bytes.
    """
    part = F.pmod(F.xxhash64(id_col, F.lit("part")), F.lit(2))
    chosen = None
    for p in (0, 1):
        for label in (0, 1):
            some = labels.where((F.col(label_col) == label) & (part == p)).select(F.lit(2 * p + label).alias("group_"), F.xxhash64(F.col(id_col)).alias("at_"), F.col(id_col).alias("id_"))
            some = some.orderBy("at_", "id_").limit(limit)
            chosen = some if chosen is None else chosen.unionAll(some)
    found = labelled_texts(docs, chosen, id_col, text_col, max_bytes)
    return {(p, label): found.get(2 * p + label, []) for p in (0, 1) for label in (0, 1)}


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Learn from a bounded sample: ``sample_docs`` rows and ``sample_bytes`` bytes for each class and part.

    Rows of ``labels`` with a null id or label are not used; a doc_id with both labels counts as 0.
    With no row of one class the score is 0.5 for every text.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias(label_col))
    found = sample(docs, known, label_col, id_col, text_col, sample_docs, sample_bytes)
    good, bad = (list(dict.fromkeys(found[0, label])) for label in (1, 0))
    model = Model(_dictionary(good), _dictionary(bad))
    held_good, held_bad = found[1, 1] or good, found[1, 0] or bad
    if not held_good or not held_bad:
        model.weight = 0.0
        return model
    x = np.array([model.difference(t) for t in held_good + held_bad])
    y = np.array([1] * len(held_good) + [0] * len(held_bad))
    model.weight, model.intercept = _logistic(x, y)
    shares = {r[label_col]: r["count"] for r in known.groupBy(label_col).count().collect()}  # a row for each label
    odds = (shares.get(1, 0) + 1) / (shares.get(0, 0) + 1)
    model.intercept += float(np.log(odds * len(held_bad) / len(held_good)))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``; null and empty texts get the score of an empty text. Rows keep their order.

    A column of the name ``score_col``, in either case, is an error: choose a free name.
    """
    if score_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"a column {score_col} is there already")
    from pyspark.sql.functions import pandas_udf

    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def scored(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: held.value.score(bytes(t) if t is not None else None)).astype("float64")

    return docs.withColumn(score_col, scored(F.col(text_col).cast("binary")))


def learnable(id_col: str = "doc_id") -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) != 2


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels.where(learnable()))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(~learnable(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
