"""Vector code compression: product codebooks trained and applied by Exponion search.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook of
entries, trained by rounds of assignment and averaging. All arithmetic is exact.

Exponion search. A part x starts at the entry a it was assigned to before, at the distance
d = |x - a|. An entry c that is no farther from x than a has |c - a| <= |c - x| + |x - a| <= 2 d. So only
the beginning of a's list of entries sorted by their distance to a, up to 2 d, is scanned; on
squared whole numbers that is D(a, c) <= 4 D(x, a), with nothing to round. Among entries equally near
the one of the lowest index is taken; all of them are inside the radius.

How it scales. A round is a pass over a written table of vectors with their codes of the round
before, without a shuffle of vectors, and a sum of each task's count and component sums for each
entry: ``parts * entries`` rows a task, whatever its number of vectors. Those are summed by Spark and
the codebooks, ``entries * dimension`` numbers, are all that the driver holds. A round's table is
removed when the next is written; a lost executor costs its tasks of one round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanworks.llm.common import join_weighted, materialise, matrix, remove, written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
_STEP = 32
_EXACT = 1 << 53
_LONG = 1 << 62
_CODE = T.ArrayType(T.IntegerType())


class Entries:
    """One codebook with each entry's neighbours in the order of their distance to it."""

    def __init__(self, book: np.ndarray) -> None:
        self.book = np.asarray(book, np.int64)
        self.square = (self.book * self.book).sum(axis=1)
        apart = self._between(self.book, self.square, self.book, self.square)
        self.near = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.near, axis=1)
        self.scanned = 0

    @staticmethod
    def _between(x: np.ndarray, xx: np.ndarray, c: np.ndarray, cc: np.ndarray) -> np.ndarray:
        """Exact squared distances: in doubles where no sum of products reaches 2**53, else in longs."""
        most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
        if most * most * x.shape[1] < _EXACT:
            dot = (x.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
        else:
            dot = np.einsum("ij,kj->ik", x, c)
        return xx[:, None] - 2 * dot + cc[None, :]

    def nearest(self, x: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest entry, the lower index of equals, and its squared distance; ``before`` is where rows start."""
        square = (x * x).sum(axis=1)
        gap = x - self.book[before]
        from_before = (gap * gap).sum(axis=1)
        best, at = from_before.copy(), before.astype(np.int64)
        for a in np.unique(before):
            rows = np.flatnonzero(before == a)
            reach = np.searchsorted(self.apart[a], 4 * from_before[rows], side="right")
            order = np.argsort(-reach, kind="stable")
            rows, reach = rows[order], reach[order]
            for k in range(0, int(reach[0]), _STEP):
                some = rows[: np.searchsorted(-reach, -k, side="left")]  # rows whose radius goes beyond the first k
                cand = np.sort(self.near[a, k : min(k + _STEP, int(reach[0]))])
                self.scanned += len(some) * len(cand)
                d = self._between(x[some], square[some], self.book[cand], self.square[cand])
                pick = d.argmin(axis=1)  # the first of equals, which has the lowest index
                near, entry = d[np.arange(len(some)), pick], cand[pick]
                better = (near < best[some]) | ((near == best[some]) & (entry < at[some]))
                best[some], at[some] = np.where(better, near, best[some]), np.where(better, entry, at[some])
        return at, best


def whole(vectors: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """Rows whose vector is not null and has finite components only; ``v`` holds floor(scale * x) of each component x."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(v.isNotNull() & finite, F.lit(False))
    return vectors.where(good).withColumn("v", F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double")))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple[str, ...] = (), parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """``id_col``, ``keep``, ``code`` (array of ``parts`` entry numbers) and ``error`` of each usable vector; and the codebooks.

    A part's codebook starts as that part of the ``entries`` vectors with the smallest ids (fewer, if
    there are fewer; rows without an id last, rows of one id by their components). Each round assigns
    parts to the nearest entries and then moves every entry that is used to floor(sum / count) of its
    parts; a last assignment follows. ``error`` sums up squared distances.

    Rows whose vector is null or holds null or non-finite components are dropped. All vectors must have
    one length, a multiple of ``parts``: rows that differ from the vector of the smallest id that
    has such a length are dropped as well. Repeated rows are coded each and weigh each. An empty table
    gives an empty table and empty codebooks. Components so large that a squared distance or a sum
    would not fit a long are an error, since there is no right result to return. Other columns than
    ``keep`` are not read; names are free, so no column clashes.
    """
    spark = vectors.sparkSession
    used = whole(vectors.select(F.col(id_col).alias("id"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(vector_col).alias("vector")), "vector", scale)
    kept = [f"k{i}" for i in range(len(keep))]
    names = dict(zip(kept, keep, strict=True))

    def result(df: DataFrame) -> DataFrame:
        return df.select(F.col("id").alias(id_col), *[F.col(c).alias(names[c]) for c in kept], F.col("code"), F.col("error"))

    fits = used.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    head = fits.select("id", "v").orderBy(*order).limit(1).collect()
    if not head:
        empty = T.StructType([used.schema[c] for c in ("id", *kept)]).add("code", _CODE).add("error", T.LongType())
        return result(spark.createDataFrame([], empty)), [np.zeros((0, 0), np.int64)] * parts
    dim = len(head[0]["v"])
    width = dim // parts
    rows = fits.where(F.size("v") == dim)
    limits = rows.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("m"), F.count(F.lit(1)).alias("n")).first()
    most = int(limits["m"]) + 1
    if 4 * most * most * dim >= _LONG or most * limits["n"] >= _LONG:
        raise ValueError(f"components of up to {most} are too large for exact sums in a long")
    first = rows.select("id", "v").orderBy(*order).limit(entries).collect()
    start = np.array([r["v"] for r in first], np.float64).astype(np.int64).reshape(len(first), parts, width)
    books = [start[:, p].copy() for p in range(parts)]

    table = T.StructType([rows.schema[c] for c in ("id", *kept)]).add("v", T.ArrayType(T.LongType())).add("code", _CODE).add("error", T.LongType())

    def assign(books: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searches = [Entries(b) for b in books]
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, before = matrix(batch.column("v")), matrix(batch.column("code"))
                found = [s.nearest(x[:, p * width : (p + 1) * width], before[:, p]) for p, s in enumerate(searches)]
                code = np.stack([f[0] for f in found], axis=1).astype(np.int32)
                ends = pa.array(np.arange(0, code.size + 1, parts, dtype=np.int32))
                cols = [batch.column(c) for c in ("id", *kept, "v")]
                cols += [pa.ListArray.from_arrays(ends, pa.array(code.ravel())), pa.array(sum(f[1] for f in found))]
                yield pa.RecordBatch.from_arrays(cols, table.fieldNames())

        return run

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            if batch.num_rows:
                x, code = matrix(batch.column(0)), matrix(batch.column(1))
                for p in range(parts):
                    n[p] += np.bincount(code[:, p], minlength=entries)
                    np.add.at(total[p], code[:, p], x[:, p * width : (p + 1) * width])
        p, e = np.nonzero(n)
        ends = pa.array(np.arange(0, len(p) * width + 1, width, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(n[p, e]), pa.ListArray.from_arrays(ends, pa.array(total[p, e].ravel()))], ["part", "entry", "n", "total"])

    start_at = F.array_repeat(F.lit(0), parts)
    now = rows.select("id", *kept, F.transform("v", lambda x: x.cast("long")).alias("v"), start_at.alias("code"), F.lit(0).cast("long").alias("error"))
    before = None
    for turn in range(rounds + 1):
        now, path = written(now.mapInArrow(assign(books), table), "codes")
        if before:
            remove(spark, before)
        before = path
        if turn == rounds:
            break
        parted = now.select("v", "code").mapInArrow(sums, "part long, entry long, n long, total array<long>")
        spread = parted.select("part", "entry", "n", F.posexplode("total").alias("pos", "x"))
        means = spread.groupBy("part", "entry", "pos").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
        for r in means.collect():  # at most entries * dimension rows
            books[r["part"]][r["entry"], r["pos"]] = r["x"] // r["n"]
    return result(now), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's code with its error, its label's error and the digest of the codebooks."""
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), keep=("label",))
    no_label = F.struct(F.col("label").isNull().alias("none"), F.coalesce("label", F.lit(0)).alias("label"))
    coded = coded.withColumn("of", no_label)
    labels = materialise(coded.groupBy("of").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    code = F.array_join(F.transform("code", lambda x: F.lpad(F.lower(F.hex(x)), 2, "0")), "")
    joined = join_weighted(coded, labels, ["of"], "n", F.xxhash64("vec_id"))
    return joined.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


OP13_SQL = """
WITH RECURSIVE x AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0),
p AS MATERIALIZED (
  SELECT r, part, list_slice(v, part * len(v) // 4 + 1, (part + 1) * len(v) // 4) AS y FROM x, range(4) AS q(part)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, y FROM p WHERE r <= 256),
""" + "".join(
    f"""a{k} AS MATERIALIZED (
  SELECT r, part, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(p.y, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), entry := entry)) AS best
  FROM p JOIN b{k} AS b USING (part) GROUP BY r, part),
"""
    + (
        f"""m{k} AS (
  SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY pos) AS y
  FROM (SELECT p.part, a.best.entry AS entry, pos, CAST(sum(p.y[pos]) AS DOUBLE) AS s, count(*) AS n
        FROM a{k} AS a JOIN p USING (r, part), range(1, 1025) AS q(pos) WHERE pos <= len(p.y) GROUP BY ALL) GROUP BY part, entry),
b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{k}.y, b{k}.y) AS y FROM b{k} LEFT JOIN m{k} USING (part, entry)),
"""
        if k < ROUNDS
        else ""
    )
    for k in range(ROUNDS + 1)
) + """e AS (SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a4 GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b4)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM x JOIN e USING (r), h
"""
