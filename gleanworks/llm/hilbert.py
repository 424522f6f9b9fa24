"""Hilbert-curve ordering and sharding.

Several metadata dimensions are quantised at equal-depth cut points, a row's cells become its index
on the Hilbert curve, rows are ordered by that index (ties by text, then id) and runs of the order
become shards. Each shard is then narrow in every dimension, so that file statistics prune reads
on any of them. Only metadata is moved; the order is one range partitioning.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, NumericType

from gleanworks.llm.common import free_name, materialise, with_rank

SHARDS = 40
BITS = 5
DIMENSIONS = ("lang", "source", "n_chars")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of ``cells`` (rows by dimensions, ``bits`` bits each).

    Skilling's transposition: undo the excess work of the axes' rotations from the highest bit
    down, Gray-encode, then interleave the bits. dimensions * bits is at most 62.
    """
    x = np.array(cells, dtype=np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | (x[i] >> b & 1)
    return out


def _cuts(df: DataFrame, name: str, bits: int) -> list[str] | list[float]:
    """At most 2**bits cut points of equal depth, whole values of the column; NaN and nulls apart.

    A common value is several cut points, so that a value's cell tells the share of rows below it.

    Numbers are cut at approximate quantiles. Others are counted by value, which combines hot
    values before the shuffle, and the distinct values, in order, are cut where their running count
    passes a share of the rows: sums by range partition, of which the driver reads one each and the
    values at the cuts.
    """
    share = [k / 2**bits for k in range(1, 2**bits)]
    if isinstance(df.schema[name].dataType, NumericType):
        v = F.col(name).cast("double")
        return sorted(df.agg(F.percentile_approx(F.when(~F.isnan(v), v), share, 1000).alias("c")).first()["c"] or [])
    counts = df.where(F.col(name).isNotNull()).groupBy(_key(df, name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    placed = materialise(counts.repartitionByRange("v").sortWithinPartitions("v").withColumn("part", F.spark_partition_id()), "values")
    parts = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.sum("n").alias("n")).collect())  # a row for each partition
    total, low, before = sum(n for _, n in parts), 0, []
    for part, n in parts:
        before.append((part, low))
        low += n
    if not total:
        return []
    start = F.create_map(*[F.lit(x) for pair in before for x in pair])[F.col("part")]
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) + start
    # A value is a cut for each share of the rows that ends in it, and values after it are over it.
    cell = lambda rows: F.floor(rows * float(2**bits) / total).cast("int")
    ends = placed.withColumn("upto", upto).select("v", (cell(F.col("upto")) - cell(F.col("upto") - F.col("n"))).alias("times")).where("times > 0")
    return sorted(v for r in ends.collect() for v in [r["v"]] * r["times"])  # 2**bits at most


def _key(df: DataFrame, name: str) -> Column:
    """A string that keeps the order of the column's bytes."""
    return F.hex(F.col(name) if isinstance(df.schema[name].dataType, BinaryType) else F.col(name).cast("string").cast("binary"))


def with_hilbert(df: DataFrame, dims: list[str], index: str, bits: int = BITS) -> DataFrame:
    """``df`` with its place on the Hilbert curve over ``dims``; nulls and NaN are in the lowest cell.

    Cut points are of equal depth over all rows and whole values, at most 2**bits for each
    dimension; a value has one cell however common it is, and strings with a long common prefix
    are told apart. A dimension that isn't a column of ``df``, or one without values, has a single cell.
    """
    dims = [d for d in dims if d in df.columns] or [df.columns[0]]
    bits = min(bits, 62 // len(dims))
    cells = []
    for d in dims:
        cuts = _cuts(df, d, bits)
        if isinstance(df.schema[d].dataType, NumericType):
            v, above = F.col(d).cast("double"), [F.lit(float(c)) for c in cuts]
            cells.append(_passed(v, above, bits, lambda x, c: x >= c, F.isnan(v) | v.isNull()))
        else:
            cells.append(_passed(_key(df, d), [F.lit(c) for c in cuts], bits, lambda x, c: x > c, F.col(d).isNull()))
    return df.withColumn(index, _curve_udf(bits)(*cells))


def _passed(value: Column, cuts: list[Column], bits: int, over, none: Column) -> Column:  # noqa: ANN001
    """The number of ``cuts`` that the value is over, at most 2**bits - 1; 0 where ``none``."""
    if not cuts:
        return F.lit(0).cast("long")
    n = F.size(F.filter(F.array(*cuts), lambda c: over(value, c)))  # at most 2**bits comparisons
    return F.when(none, 0).otherwise(F.least(n, F.lit(2**bits - 1))).cast("long")


def _curve_udf(bits: int):
    @F.pandas_udf("long")
    def curve(*cells: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy(dtype=np.int64) for c in cells], axis=1), bits))

    return curve


def hilbert_shards(
    docs: DataFrame, shards: int = SHARDS, dims: tuple[str, ...] = DIMENSIONS, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS
) -> DataFrame:
    """A row for each row of ``docs``: id, size, text_crc32, curve (the index), shard, slot.

    Shards are runs of equal length in the curve's order, so counts are at most one apart; slot is
    a row's place in its shard, from 0. Rows of one cell are ordered by checksum and id, so equal
    texts of one cell stand together; repeated rows keep apart places. Null texts have no bytes and
    checksum 0. With fewer rows than shards some shards are empty; an empty table gives no rows.
    """
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + 16
    crc = F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long")
    used = [d for d in dims if d in docs.columns and d != id_col]
    meta = docs.select(F.col(id_col).alias("id_"), size.alias("size"), crc.alias("text_crc32"), *[F.col(d).alias(f"d_{d}") for d in used], F.monotonically_increasing_id().alias("tie"))
    meta = materialise(meta, "metadata")
    placed = with_hilbert(meta, [f"d_{d}" for d in used], "curve", bits)
    ranked, total = with_rank(placed.select("id_", "size", "text_crc32", "curve", "tie"), [F.col(c) for c in ("curve", "text_crc32", "id_", "tie")], "rank")
    # The first ``over`` shards have one row more.
    base, over = divmod(total, shards)
    wide = over * (base + 1)
    shard = F.when(F.col("rank") < wide, F.floor(F.col("rank") / F.lit(base + 1))).otherwise(over + F.floor((F.col("rank") - wide) / F.lit(max(base, 1))))
    start = F.when(F.col("shard") <= over, F.col("shard") * (base + 1)).otherwise(wide + (F.col("shard") - over) * base)
    out = ranked.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("rank") - start).cast("long"))
    return out.select(F.col("id_").alias(id_col), "size", "text_crc32", "curve", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, dims: tuple[str, ...] = DIMENSIONS, id_col: str = "doc_id", bits: int = BITS, salts: int = 64) -> None:
    """Write whole rows in curve order, a folder for each run, for pruning by file statistics.

    Here the text moves with the row: one range partitioning by curve index and, as very many rows
    may have one index, by a hash of the row in ``salts`` values, cut where runs begin. Nulls of a
    dimension have a place of their own on its axis; rows are written as they are, null texts and repeated rows too. An empty
    table writes a folder without rows. Columns of any name are kept; the run's number is in the folders' names only.
    """
    index, run, salt = free_name(docs, "curve_"), free_name(docs, "shard_"), free_name(docs, "salt_")
    placed = with_hilbert(docs, [d for d in dims if d != id_col], index, bits)
    place = F.col(index) * salts + F.col(salt)
    placed = placed.withColumn(salt, F.pmod(F.xxhash64(*docs.columns), F.lit(salts)))
    share = [k / shards for k in range(1, shards)]
    starts = sorted(set(placed.agg(F.percentile_approx(place, share, 10000).alias("c")).first()["c"] or []))
    number = F.size(F.filter(F.array(*[F.lit(x) for x in starts]), lambda c: place >= c)) if starts else F.lit(0)
    marked = placed.withColumn(run, number.cast("int"))
    marked.repartitionByRange(shards, run, index, salt).sortWithinPartitions(run, index, salt).drop(index, salt).write.partitionBy(run).parquet(path)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards along the curve, by the law ``rows``."""
    found = hilbert_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
