"""Conflict-constrained best-fit packing.

Pieces go into bins of fixed capacity, longest first. Bins are ordered by residual capacity and
each carries two bitmaps: the sources and the duplicate clusters that it holds. For a piece the
search starts at the smallest residual that holds it and goes on to the next larger one until a
bin is found in whose bitmaps the piece's bits are clear: the tightest compatible bin. If there is
none, a bin is opened.

How it scales. Rows (lengths, not texts) are dealt evenly over packs of about ``pack_rows``, which
are packed apart; a hot source or cluster is dealt like any other row, and none is dropped: each
row of a group that conflicts with itself gets a bin of its own. Work and memory of a pack are
bounded by its rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.llm.common import materialise

CAPACITY = 2048
PACK_ROWS = 4096
SOURCE_LIMIT = 4


def best_fit(items: list[tuple[int, int | None, int | None]], capacity: int, source_limit: int) -> tuple[list[tuple[int, int]], int]:
    """(bin, offset) for each item and the number of bins.

    items: (length up to ``capacity``, source, cluster), in the order in which they are placed. A
    bin holds at most ``source_limit`` items of a source and one of a cluster; None conflicts with
    nothing. Of bins with equal residuals the one opened first is taken.
    """
    residual: list[tuple[int, int]] = []  # (residual, bin), ascending
    full_sources: list[int] = []  # bitmap of the sources that a bin takes no more of
    clusters: list[int] = []
    counts: list[dict[int, int]] = []
    source_bit: dict[int, int] = {}
    shared = {c for c, n in Counter(c for _, _, c in items).items() if c is not None and n > 1}
    cluster_bit: dict[int, int] = {}  # a cluster with one item here needs none
    out: list[tuple[int, int]] = []
    for length, source, cluster in items:
        s = 0 if source is None else source_bit.setdefault(source, 1 << len(source_bit))
        c = cluster_bit.setdefault(cluster, 1 << len(cluster_bit)) if cluster in shared else 0
        at = bisect_left(residual, (length, -1))
        while at < len(residual):
            b = residual[at][1]
            if not (full_sources[b] & s or clusters[b] & c):
                break
            at += 1
        if at < len(residual):
            left, b = residual.pop(at)
        else:
            left, b = capacity, len(counts)
            full_sources.append(0)
            clusters.append(0)
            counts.append({})
        out.append((b, capacity - left))
        clusters[b] |= c
        if s:
            counts[b][s] = counts[b].get(s, 0) + 1
            if counts[b][s] >= source_limit:
                full_sources[b] |= s
        insort(residual, (left - length, b))  # a full bin still takes pieces of length 0
    return out, len(counts)


def pack(
    docs: DataFrame,
    length_col: str,
    id_col: str = "doc_id",
    source_col: str = "source",
    cluster_col: str | None = None,
    capacity: int = CAPACITY,
    source_limit: int = SOURCE_LIMIT,
    pack_rows: int = PACK_ROWS,
) -> DataFrame:
    """Pieces of all rows in bins: id, piece, start, length, bin_id, bin_offset, source, cluster.

    A row longer than ``capacity`` is cut: each full piece fills a bin and the rest is packed like
    other rows. Null and negative lengths count as 0; an empty row is one piece of length 0. Null
    sources and clusters conflict with nothing. Repeated rows are packed each on its own. bin_id is
    unique over the result; an empty table gives no rows. Columns are read by name only.
    """
    col = lambda name: F.col(name) if name and name in docs.columns else F.lit(None)
    length = F.greatest(F.coalesce(F.col(length_col).cast("long"), F.lit(0)), F.lit(0)).cast("long")
    cluster = col(cluster_col).cast("long") if cluster_col else F.lit(None).cast("long")
    rows = materialise(docs.select(F.col(id_col).cast("long").alias("id"), length.alias("length"), col(source_col).cast("string").alias("source"), cluster.alias("cluster")), "lengths")
    return _pack_rows(rows, capacity, source_limit, pack_rows).withColumnRenamed("id", id_col)


def _pack_rows(rows: DataFrame, capacity: int, source_limit: int, pack_rows: int) -> DataFrame:
    parts = max(1, min(2000, -(-rows.count() // pack_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        where = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        opened = 0

        def close() -> pa.RecordBatch:
            nonlocal opened
            rows_ = sorted(held, key=lambda r: (-(r[1] % capacity or (capacity if r[1] else 0)), -r[1], r[0] is None, r[0] or 0, r[2] or "", r[3] is None, r[3] or 0))
            held.clear()
            rests = [(n % capacity or (capacity if n else 0), None if s is None else s, c) for _, n, s, c in rows_]
            names: dict[str, int] = {}
            placed, bins = best_fit([(n, None if s is None else names.setdefault(s, len(names)), c) for n, s, c in rests], capacity, source_limit)
            out = []
            for (i, n, s, c), (rest, _, _), (b, offset) in zip(rows_, rests, placed, strict=True):
                whole = (n - rest) // capacity
                for k in range(whole):
                    out.append((i, k, k * capacity, capacity, where + opened + bins, 0, s, c))
                    bins += 1
                out.append((i, whole, whole * capacity, rest, where + opened + b, offset, s, c))
            opened += bins
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            named = ["id", "piece", "start", "length", "bin_id", "bin_offset", "source", "cluster"]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], named)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                if len(held) >= pack_rows:
                    yield close()
        if held:
            yield close()

    schema = "id long, piece int, start long, length long, bin_id long, bin_offset long, source string, cluster long"
    return rows.repartition(parts).mapInArrow(run, schema)  # dealt in turn, after a local sort: a lost task deals alike


def word_count(text: str) -> Column:
    """Words between ASCII white space; 0 for null and blank texts."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``pack`` with a document's words as its length and documents of equal text as clusters."""
    text = F.col(text_col)
    body = docs.select(F.col(id_col).alias("id"), word_count(text_col).alias("words"), (F.col(source_col) if source_col in docs.columns else F.lit(None)).alias("src"), F.when(F.length(text) > 0, F.xxhash64(text)).alias("same"))
    return pack(body, "words", "id", "src", "same", capacity).withColumnRenamed("id", id_col)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into bins of 2048 words."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
