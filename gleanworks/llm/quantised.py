"""Near-duplicate vectors by product quantisation over inverted lists.

Vectors are scaled to unit length, where cosine >= c means a distance of at most
r = sqrt(2 - 2c). A coarse quantiser, fitted on a bounded sample, puts each distinct vector in the
inverted list of its nearest centroid; its residual is coded by the nearest of 256 codewords in
each subspace, and the length of what the code leaves out is kept beside it.

Sufficient probes. A vector y of list b and a query x of list a with |x - y| <= r have
d(x,b)^2 - d(x,a)^2 <= 2 r |a - b|, since the left side is linear in x and not above 0 at y. A
query probes exactly the lists that pass, so no link is missed whatever the sample was.

Sufficient candidates. In a list a query's asymmetric distances are sums of table entries. By the
triangle inequality a link has a table distance of at most r plus what y's code leaves out, and
only those pairs are ranked by exact cosine in double precision.

How it scales. Vectors equal in label and components are one row with a count. Lists are cut into
blocks of ``block_rows`` index rows and of as many queries; a task holds one block of each and
returns a count of links for each query and stars that connect the block's components, never
pairs. The model is broadcast; its size is bounded by ``max_lists`` and 256 codewords.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.llm.common import connected_components, materialise, matrix, sorted_runs

THRESHOLD = 0.93
SAMPLE_ROWS = 8192
LIST_ROWS = 2048
MAX_LISTS = 256
BLOCK_ROWS = 4096
SUBSPACES = 8
_SLACK = 1e-4  # for 32-bit table sums


def usable(column: str) -> Column:
    """Whether a vector has components, all finite, and one that is not zero."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * (x @ centres.T), axis=1)


def _k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most ``k`` centres of the rows of ``x``; the start is spread over the rows' order."""
    rows = np.unique(x, axis=0)
    k = min(k, len(rows))
    centres = rows[np.random.default_rng(7).choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        own = _nearest(x, centres)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


class Quantiser:
    """Coarse centroids and, for each subspace, codewords of the residuals."""

    def __init__(self, dim: int, coarse: np.ndarray, words: list[np.ndarray]) -> None:
        self.dim, self.coarse, self.words = dim, coarse, words
        cuts = np.array_split(np.arange(dim), len(words))
        self.spans = [(int(c[0]), int(c[-1]) + 1) for c in cuts]
        gap = coarse[:, None, :] - coarse[None, :, :]
        self.apart = np.sqrt((gap * gap).sum(axis=2))

    @classmethod
    def fit(cls, x: np.ndarray, lists: int, subspaces: int = SUBSPACES) -> Quantiser:
        dim = x.shape[1]
        coarse = _k_means(x, lists)
        rest = x - coarse[_nearest(x, coarse)]
        spans = np.array_split(np.arange(dim), min(subspaces, dim))
        return cls(dim, coarse, [_k_means(rest[:, s], 256) for s in spans])

    @classmethod
    def plain(cls, dim: int) -> Quantiser:
        """For a length that the sample lacks: one list, one codeword; everything is a candidate."""
        return cls(dim, np.zeros((1, dim)), [np.zeros((1, dim))])

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row's list, codes and the length of what the codes leave out."""
        own = _nearest(x, self.coarse)
        rest = x - self.coarse[own]
        codes, lost = np.empty((len(x), len(self.words)), np.uint8), np.zeros(len(x))
        for m, ((a, b), w) in enumerate(zip(self.spans, self.words, strict=True)):
            codes[:, m] = _nearest(rest[:, a:b], w)
            gap = rest[:, a:b] - w[codes[:, m]]
            lost += (gap * gap).sum(axis=1)
        return own, codes, np.sqrt(lost)

    def probes(self, x: np.ndarray, own: np.ndarray, radius: float) -> list[np.ndarray]:
        """The lists that may hold a row within ``radius`` of each row of ``x``."""
        d2 = (self.coarse * self.coarse).sum(axis=1) - 2 * (x @ self.coarse.T)
        ok = d2 - d2[np.arange(len(x)), own][:, None] <= 2 * radius * self.apart[own] + 1e-9
        return [np.flatnonzero(row) for row in ok]

    def tables(self, x: np.ndarray, at: int) -> list[np.ndarray]:
        """Squared distances of each row's residual in list ``at`` to the codewords, by subspace."""
        rest = x - self.coarse[at]
        out = []
        for (a, b), w in zip(self.spans, self.words, strict=True):
            q = rest[:, a:b]
            out.append(((q * q).sum(axis=1)[:, None] + (w * w).sum(axis=1) - 2 * (q @ w.T)).astype(np.float32))
        return out


def match_block(model: Quantiser, at: int, radius: float, threshold: float, index: tuple, queries: tuple, step: int = 256) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links between one block of index rows and one of queries, all of list ``at``'s probes.

    index: ids, unit vectors, codes, lost lengths, counts; queries: ids, unit vectors. Returns the
    number of other vectors that each query links with here, and stars that connect the block.
    """
    ids, vectors, codes, lost, copies = index
    q_ids, q_vectors = queries
    counts = np.zeros(len(q_ids), np.int64)
    group = np.arange(len(ids))  # of each index row, by the links seen so far
    stars: list[tuple[int, int]] = []
    bound = (radius + lost + _SLACK).astype(np.float32) ** 2
    for k in range(0, len(q_ids), step):
        x = q_vectors[k : k + step]
        total = np.zeros((len(x), len(ids)), np.float32)
        for m, table in enumerate(model.tables(x, at)):
            total += table[:, codes[:, m]]
        qi, yi = np.nonzero(total <= bound)
        other = q_ids[k + qi] != ids[yi]
        qi, yi = qi[other], yi[other]
        for c in range(0, len(qi), 1 << 18):
            a, b = qi[c : c + (1 << 18)], yi[c : c + (1 << 18)]
            near = np.einsum("ij,ij->i", x[a], vectors[b]) >= threshold
            a, b = a[near], b[near]
            np.add.at(counts, k + a, copies[b])
            firsts = np.flatnonzero(np.r_[len(a) > 0, a[1:] != a[:-1]])
            for s, e in zip(firsts, np.r_[firsts[1:], len(a)], strict=len(a) > 0):
                mine = np.unique(group[b[s:e]])
                if len(mine) > 1:
                    group[np.isin(group, mine[1:])] = mine[0]
                stars.append((int(q_ids[k + a[s]]), int(ids[b[s]])))
    linked = np.flatnonzero(group != np.arange(len(ids)))
    stars += [(int(ids[y]), int(ids[group[y]])) for y in linked]
    return counts, stars


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
    list_rows: int = LIST_ROWS,
    max_lists: int = MAX_LISTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """A row for each row of ``vectors``: id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null, they have equally many components and
    their cosine is at least ``threshold``. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. Rows with equal vectors, and repeated rows, are
    vectors of their own that link with each other. A null id takes part in links but is never a
    component's id. kept is false where the id is null. The quantiser is fitted on at most
    ``sample_rows`` distinct vectors, chosen by a hash; every vector is indexed.
    """
    spark = vectors.sparkSession
    v, label = F.col(vector_col), F.col(label_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec"), label.alias("label"), F.when(usable(vector_col) & label.isNotNull(), v).alias("v"))
    keyed = rows.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit("second"), "v"))
    alone = rows.where(F.col("v").isNull()).select(F.col("vec").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"), F.col("vec").isNotNull().alias("kept"))
    valid = keyed.where(F.col("v").isNotNull())
    distinct = valid.groupBy("label", "k1", "k2").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("vec").alias("least"))
    distinct = materialise(distinct.withColumn("gid", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "vectors")
    stats = distinct.groupBy("dim", "label").count().groupBy("dim").agg(F.sum("count").alias("n"), F.max("count").alias("most")).orderBy("dim").limit(64).collect()
    models: dict[int, Quantiser] = {}
    total = sum(r["n"] for r in stats)
    for r in stats:  # one model for each length of vector, the sample shared out by their counts
        n = min(r["n"], max(256, sample_rows * r["n"] // max(1, total)))
        share = F.pmod("k1", F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * n / r["n"]) + 64)
        drawn = distinct.where((F.col("dim") == r["dim"]) & share).select("v", "k1").orderBy("k1").limit(n).select("v").toArrow()
        if drawn.num_rows:
            lists = max(1, min(max_lists, math.ceil(r["most"] / list_rows)))
            models[r["dim"]] = Quantiser.fit(unit(matrix(drawn["v"])), lists)
    radius = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    held = spark.sparkContext.broadcast(models)

    def model_of(dim: int) -> Quantiser:
        return held.value.get(dim) or Quantiser.plain(dim)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x, model = unit(matrix(part.column(2))), model_of(int(dim))
                own, codes, lost = model.encode(x)
                probes = [p.tolist() for p in model.probes(x, own, radius)]
                cols = [part.column(0), pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(lost), pa.array(probes, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(cols, ["gid", "list", "codes", "lost", "probes"])

    coded = distinct.select("gid", "dim", "v").mapInArrow(encode, "gid long, list int, codes binary, lost double, probes array<int>")
    coded = materialise(coded.join(distinct, "gid"), "codes")
    home = ["label", "dim", "list"]
    asked = coded.select("label", "dim", F.explode("probes").alias("list"), "gid", "v")
    blocks = lambda n: F.ceil(F.col(n) / F.lit(block_rows)).cast("int")
    sizes = coded.groupBy(*home).agg(F.count(F.lit(1)).alias("n")).join(asked.groupBy(*home).agg(F.count(F.lit(1)).alias("q")), home)
    sizes = materialise(sizes.select(*home, blocks("n").alias("nb"), blocks("q").alias("qb")), "lists")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("gid"), F.col(n)).cast("int")
    index = coded.join(sizes, home).withColumn("ib", mine("nb")).withColumn("jb", spread("qb"))
    index = index.select(*home, "ib", "jb", F.lit(0).alias("role"), "gid", "v", "codes", "lost", "copies")
    query = asked.join(sizes, home).withColumn("jb", mine("qb")).withColumn("ib", spread("nb"))
    query = query.select(*home, "ib", "jb", F.lit(1).alias("role"), "gid", "v", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("lost"), F.lit(None).cast("long").alias("copies"))
    key = [*home, "ib", "jb"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in sorted_runs(batches, key):
            role = run["role"].to_numpy()
            i, q = run.filter(pa.array(role == 0)), run.filter(pa.array(role == 1))
            if not i.num_rows or not q.num_rows:
                continue
            dim, at = run["dim"][0].as_py(), run["list"][0].as_py()
            codes = np.frombuffer(b"".join(i["codes"].to_pylist()), np.uint8).reshape(i.num_rows, -1)
            index_ = (i["gid"].to_numpy(), unit(matrix(i["v"])), codes, i["lost"].to_numpy(), i["copies"].to_numpy())
            queries = (q["gid"].to_numpy(), unit(matrix(q["v"])))
            counts, stars = match_block(model_of(dim), at, radius, threshold, index_, queries)
            some = np.flatnonzero(counts)
            a = np.r_[queries[0][some], np.array([s[0] for s in stars], np.int64)]
            b = np.r_[np.full(len(some), -1), np.array([s[1] for s in stars], np.int64)]
            n = np.r_[counts[some], np.zeros(len(stars), np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a, b, n)], ["a", "b", "n"])

    dealt = index.unionByName(query).repartition(*key).sortWithinPartitions(*key, "role", "gid")
    found = materialise(dealt.mapInArrow(match, "a long, b long, n long"), "links")
    counts = found.where(F.col("n") > 0).groupBy(F.col("a").alias("gid")).agg(F.sum("n").alias("n"))
    labels = connected_components(found.where(F.col("b") >= 0))
    known = distinct.select("gid", "label", "k1", "k2", "copies", "least").join(counts, "gid", "left")
    known = known.join(labels.select(F.col("node").alias("gid"), F.col("label").alias("root")), "gid", "left")
    known = materialise(known.withColumn("root", F.coalesce("root", "gid")), "known")
    least = materialise(known.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    links = (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    known = materialise(known.join(least, "root").select("label", "k1", "k2", links, "component_id"), "linked")
    linked = valid.select("vec", "label", "k1", "k2").join(known, ["label", "k1", "k2"])
    linked = linked.select(F.col("vec").alias(id_col), "n_links", "component_id", F.coalesce(F.col("vec") == F.col("component_id"), F.lit(False)).alias("kept"))
    return linked.unionAll(alone)


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
    label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
l AS (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b
    ON a.ok AND b.ok AND a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT reach.a, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.b = v.r GROUP BY reach.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.a = v.r LEFT JOIN n ON n.a = v.r
"""
