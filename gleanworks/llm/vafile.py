"""Exact top-k search by inner product with a vector-approximation file.

Every component is cut into cells of equal whole-number width; a vector's approximation is its
cells' numbers. A task holds one block of candidates and one of queries. It first scans the
approximations: the sum over components of the larger product of the query with a cell's two ends
bounds the score from above. Then it reads exact vectors in the order of that bound and stops when
the kth exact score is above every bound left, so that no better one can remain. Blocks return
their own k best and these meet in one final ranking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanworks.llm.common import materialise, matrix, sorted_runs

K = 5
SCALE = 256
CELLS = 256
BLOCK_ROWS = 2048
_READ = 32
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def search_block(ids: np.ndarray, codes: np.ndarray, exact: np.ndarray, low: float, width: float, q_own: np.ndarray, own: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query's place, candidate's id, score) of each query's ``k`` best in a block.

    own and q_own number the rows, so that a query passes over its own row. Ties go to the smaller
    id. Values are whole. Where no sum of products can reach 2**53 doubles are exact; else the
    rows that are read are scored in exact integers, bounds are widened by more than their rounding,
    and a score outside the range of a long is set to its nearest end.
    """
    most = float(np.abs(exact).max(initial=0)) * float(np.abs(queries).max(initial=0)) * exact.shape[1]
    large = not most < _EXACT
    floor_ = low + codes * width
    with np.errstate(over="ignore", invalid="ignore"):
        bound = np.maximum(queries, 0) @ (floor_ + width - 1).T + np.minimum(queries, 0) @ floor_.T
        if large:
            bound = bound + 1e-9 * (np.abs(queries) @ (np.abs(floor_) + width).T)
            bound[np.isnan(bound)] = np.inf
    out = []
    for j in range(len(queries)):
        b = bound[j]
        b[own == q_own[j]] = -np.inf
        whole = [int(x) for x in queries[j]] if large else []
        best: list[tuple] = []
        done, size = own == q_own[j], min(_READ, len(b))
        while True:
            floor = -best[k - 1][0] if len(best) >= k else -np.inf
            rest = np.flatnonzero(~done & (b >= float(floor)))
            if not len(rest):
                break
            if len(rest) > size:
                rest = rest[np.argpartition(-b[rest], size - 1)[:size]]
            done[rest] = True
            scores = [sum(x * int(y) for x, y in zip(whole, exact[r], strict=True)) for r in rest] if large else (exact[rest] @ queries[j]).tolist()
            best = sorted([*best, *zip((-s for s in scores), ids[rest].tolist(), strict=True)])[:k]
            size *= 2
        out += [(j, i, max(-_LONG - 1, min(_LONG, int(-s)))) for s, i in best]
    return out


def top_k(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, id, score: each query's ``k`` best among all other rows, by inner product.

    Components become floor(scale * x). is_query is a condition on the id. Vectors that are null
    or empty or hold null or non-finite components take no part, nor do rows without an id; only
    vectors with equally many components are compared. Repeated rows are rows of their own: a
    query passes over its own row only, and each repeated query has its own result. A query with
    fewer candidates has all of them.
    """
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite, F.lit(False)) & F.col(id_col).isNotNull()
    rows = vectors.where(good).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("q", F.coalesce(is_query(F.col("id")), F.lit(False))).withColumn("dim", F.size("v"))
    rows = materialise(rows, "vectors")
    # The file's cells: equal widths over the range of all components.
    seen = rows.agg(F.min(F.array_min("v")).alias("a"), F.max(F.array_max("v")).alias("b"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("q").cast("int")), F.lit(0)).alias("q")).first()
    low = float(seen["a"] or 0)
    width = float(math.ceil(max(1.0, (float(seen["b"] or 0) - low + 1) / CELLS)))
    n_blocks, q_blocks = max(1, -(-seen["n"] // block_rows)), max(1, -(-seen["q"] // block_rows))

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(4).flatten().to_numpy()
            cells = np.clip(np.floor((flat - low) / width), 0, CELLS - 1).astype(np.uint8).tobytes()
            ends = np.cumsum(batch.column(3).to_numpy()).tolist()
            codes = [cells[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())], [*batch.schema.names, "codes"])

    filed = materialise(rows.select("id", "row", "q", "dim", "v").mapInArrow(approximate, "id long, row long, q boolean, dim int, v array<double>, codes binary"), "va-file")
    lot = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    names = ["dim", "cb", "qb"]
    cands = filed.withColumn("cb", lot(n_blocks)).withColumn("qb", every(q_blocks)).select(*names, F.lit(0).alias("role"), "id", "row", "v", "codes")
    asked = filed.where("q").withColumn("qb", lot(q_blocks)).withColumn("cb", every(n_blocks)).select(*names, F.lit(1).alias("role"), "id", "row", "v", F.lit(None).cast("binary").alias("codes"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in sorted_runs(batches, names):
            role = run["role"].to_numpy()
            c, q = run.filter(pa.array(role == 0)), run.filter(pa.array(role == 1))
            if not c.num_rows or not q.num_rows:
                continue
            codes = np.frombuffer(b"".join(c["codes"].to_pylist()), np.uint8).reshape(c.num_rows, -1)
            q_rows, q_ids, q_vectors = q["row"].to_numpy(), q["id"].to_numpy(), matrix(q["v"])
            ids, own, exact = c["id"].to_numpy(), c["row"].to_numpy(), matrix(c["v"])
            for k0 in range(0, len(q_rows), 512):
                part = slice(k0, k0 + 512)
                found = search_block(ids, codes, exact, low, width, q_rows[part], own, q_vectors[part], k)
                j = np.array([f[0] for f in found], np.int64) + k0
                cols = [pa.array(q_rows[j]), pa.array(q_ids[j]), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["row", "query_id", "id", "score"])

    dealt = cands.unionByName(asked).repartition(*names).sortWithinPartitions(*names, "role", "row")
    found = dealt.mapInArrow(search, "row long, query_id long, id long, score long")
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def op8_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best for every fiftieth embedding."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 50 == 0)


OP8_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.e) = len(c.e)),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 5
"""
