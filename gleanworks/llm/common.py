"""Plumbing that the corpus operators share: shared storage, sorted runs, components, global ranks."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``. Only where that is unset, as in tests on a
    local master, a temporary folder of this machine stands in; on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="gleanworks-")
    return _OWN[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/gleanworks/{label}-{uuid.uuid4().hex}"


_WRITTEN: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what ``materialise`` has written meanwhile; results must have been written by then."""
    _WRITTEN.append([])
    try:
        yield
    finally:
        for path in _WRITTEN.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """What ``materialise`` gives, and the path, so that the caller can remove it early."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    It cuts the lineage: what reads the result does not depend on the executors that made it,
    and values such as ``monotonically_increasing_id()`` are fixed from here on.
    """
    return written(df, label)[0]


#: Rows of one Arrow batch that holds whole texts; Spark's default is 10,000.
TEXT_BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Bound the texts that a Python worker holds at once, for the rest of the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= TEXT_BATCH_ROWS:
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


#: Up to so many rows of a few numbers (about 60 MB as a hash table) one side of a join is broadcast; beyond, both are shuffled.
BROADCAST_IDS = 500_000


def having(df: DataFrame, ids: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose numbers ``on`` are in ``ids``, a written table in which they are distinct."""
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids.hint("merge"), on, how)


def labelled_texts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, max_bytes: int) -> dict[object, list[bytes]]:
    """Whole texts by ``group_`` for the bounded table ``chosen`` (group_, at_, id_), in the order of at_.

    ``docs`` is scanned once. Texts of more than an eighth of ``max_bytes`` are passed over. Of each
    group texts are taken in order while they sum up to at most ``max_bytes``; the sum is formed by
    Spark and only those reach the driver. A repeated id gives each of its rows.
    """
    body = docs.select(F.col(id_col).alias("id_"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"").cast("binary")).alias("body_"))
    found = F.broadcast(chosen).join(body.where(F.octet_length("body_") <= max_bytes // 8), "id_")  # chosen is bounded
    found = materialise(found.select("group_", "at_", "id_", "body_"), "labelled")
    order = [F.col(c) for c in ("at_", "id_")] + [F.octet_length("body_"), F.xxhash64("body_")]
    upto = F.sum(F.octet_length("body_").cast("long")).over(Window.partitionBy("group_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    sized = found.select("group_", "at_", "id_", "body_", upto.alias("upto_")).where(F.col("upto_") <= max_bytes)
    out: dict[object, list[bytes]] = {}
    for row in sized.orderBy("group_", "upto_", "at_", "id_").toLocalIterator():
        out.setdefault(row["group_"], []).append(bytes(row["body_"]))
    return out


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, made longer until no column of ``df`` has it in either case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def sorted_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole runs of equal ``keys`` from batches that arrive sorted by ``keys``, one table each.

    A run is held in memory; callers bound its size by the way they make their keys.
    """
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows - 1, dtype=bool)
        for k in keys:
            column = table[k].combine_chunks()
            change |= np.asarray(pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False), dtype=bool)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(table[k][a].as_py() for k in keys)
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(a, b - a))
            last = key
    if held:
        yield pa.concat_tables(held)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column whose rows have one length, as a 2-D array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def least_of_links(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for each node of the links but the least ones themselves."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    up = np.arange(len(nodes))
    while True:
        x, y = up[a], up[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while True:
            higher = up[up]
            if (higher == up).all():
                break
            up = higher
    some = np.flatnonzero(up != np.arange(len(up)))
    return nodes[some], nodes[up[some]]


def _forests(limit: int):
    """Links to ``u, v, lot``: each lot's nodes with its least node, a lot holding at most ``limit`` links of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lot, held, size = TaskContext.get().partitionId() << 20, [], 0

        def close(u: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(u), 1 << 16):
                part = u[k : k + (1 << 16)], v[k : k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, part), pa.array(np.full(len(part[0]), lot))], ["u", "v", "lot"])

        def reduced() -> tuple[np.ndarray, np.ndarray]:
            return least_of_links(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= limit:
                u, v = reduced()
                if len(u) > limit // 2:
                    yield from close(u, v)
                    lot, held, size = lot + 1, [], 0
                else:
                    held, size = [(u, v)], len(u)
        if held:
            yield from close(*reduced())

    return run


#: Links that a task joins at once; some 200 bytes each.
LOT_LINKS = 1 << 21


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", lot_links: int = LOT_LINKS, rounds: list | None = None) -> DataFrame:
    """``node, label`` for every node that ``edges`` join to another; label: the smallest node reachable.

    Randomised contraction. In a round each task first reduces its links to stars. Then every node
    takes the neighbour that is first in an order drawn anew for the round (itself, if it is first),
    links are set between those, and those within one are dropped. In a random order a node that has
    neighbours is not chosen by any with a fixed chance, so whatever the shape of a component and
    the numbers of its nodes, about half of the nodes or fewer go on to the next round: rounds grow
    with the logarithm of the number of nodes, and the tables shrink geometrically. Only the first
    round orders by number, which finishes stars around a least node. Where one task holds all links
    that are left, its stars are the answer. Tables are written; the driver sees two numbers a round.
    Rows with a null end are ignored. ``rounds``, if given, collects each round's number of links.
    """
    ends = [F.least(a, b).cast("long").alias("u"), F.greatest(a, b).cast("long").alias("v")]
    left = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(*ends).distinct()
    chosen: list[DataFrame] = []
    while True:
        turn = len(chosen)
        stars = materialise(left.mapInArrow(_forests(lot_links), "u long, v long, lot long"), "stars")
        seen = stars.agg(F.min("lot").alias("a"), F.max("lot").alias("b"), F.count(F.lit(1)).alias("n")).first()
        if rounds is not None and seen["n"]:
            rounds.append(seen["n"])
        if not seen["n"]:
            break
        if seen["a"] == seen["b"]:
            centres = stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            chosen.append(stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(centres))
            break
        order = (lambda c: F.col(c)) if turn == 0 else (lambda c, t=turn: F.xxhash64(F.col(c), F.lit(t)))
        both = stars.select("u", "v").unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = both.groupBy(F.col("u").alias("node")).agg(F.min(F.struct(order("v").alias("place"), "v")).alias("first"))
        mine = F.when(F.col("first.place") < order("node"), F.col("first.v")).otherwise(F.col("node"))
        taken = materialise(first.select("node", mine.alias("label")), "taken")
        chosen.append(taken)
        of = lambda end, t=taken: t.select(F.col("node").alias(end), F.col("label").alias(f"{end}_"))
        moved = stars.select("u", "v").join(of("u"), "u").join(of("v"), "v").where("u_ <> v_")
        left = moved.select(F.least("u_", "v_").alias("u"), F.greatest("u_", "v_").alias("v")).distinct()
    if not chosen:
        return edges.sparkSession.createDataFrame([], "node long, label long")
    labels = chosen.pop()
    if not chosen:
        return labels  # one task's stars, whose centres are the least nodes
    while chosen:
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = materialise(chosen.pop().join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
    least = labels.groupBy("label").agg(F.min("node").alias("least"))
    return materialise(labels.join(least, "label").select("node", F.col("least").alias("label")), "labels")


def with_rank(df: DataFrame, order: list[Column], rank: str, parts: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with ``rank``, its rows' place from 0 in ``order``, and the number of rows.

    Rows are range-partitioned and sorted once; a row's rank is its place in its partition plus
    the rows of the partitions before, of which the driver reads one count each. ``order`` should
    end in a column that tells rows apart, so that ties don't meet in one partition.
    """
    at = free_name(df, "at")
    spread = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    placed = materialise(spread.sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "ranked")
    part = F.shiftright(at, 33)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    spark, before, total = df.sparkSession, [], 0
    for p, n in counts:
        before.append((p, total))
        total += n
    if not before:
        return placed.withColumn(rank, F.lit(0).cast("long")).drop(at), 0
    starts = F.create_map(*[F.lit(x).cast("long") for pair in before for x in pair]) if len(before) <= 256 else None
    low = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    if starts is not None:
        return placed.withColumn(rank, starts[part] + low).drop(at), total
    key, start = free_name(df, "part_"), free_name(df, "start_")
    table = spark.createDataFrame(before, f"{key} long, {start} long")
    joined = placed.withColumn(key, part).join(F.broadcast(table), key)  # a row for each partition
    return joined.withColumn(rank, F.col(start) + low).drop(at, key, start), total


#: At most so many keys are heavy: those that hold a share of 1 / HEAVY_KEYS of the weight or more.
HEAVY_KEYS = 4096


def join_weighted(df: DataFrame, keys: DataFrame, on: list[str], weight: str, spread: Column) -> DataFrame:
    """``df`` inner-joined with ``keys``, a written table in which ``on`` is distinct and not null, without hot tasks.

    ``weight`` is a column of ``keys`` in proportion to the rows of ``df`` that a key has. Keys of
    a share of 1 / HEAVY_KEYS or more, of which there are HEAVY_KEYS at most, are broadcast; their
    rows are then dealt by ``spread``, a hash of what tells rows apart, and every other key is met
    by a sorted join. ``weight`` is not returned.
    """
    spark, new = df.sparkSession, [c for c in keys.columns if c not in on and c != weight]
    total = keys.agg(F.sum(weight).alias("s")).first()["s"]
    if total is None:
        none = spark.createDataFrame([], keys.select(*on, *new).schema)
        return df.join(none, on)
    found, salt = free_name(df, "found_"), free_name(df, "salt_")
    heavy = F.broadcast(keys.where(F.col(weight) * HEAVY_KEYS >= F.lit(total)).select(*on, F.struct(F.lit(True), *new).alias(found)))
    marked = df.join(heavy, on, "left").withColumn(salt, F.when(F.col(found).isNull(), 0).otherwise(1 + F.pmod(spread, F.lit(1 << 30))).cast("int"))
    light = keys.where(F.col(weight) * HEAVY_KEYS < F.lit(total)).select(*on, F.lit(0).alias(salt), F.struct(F.lit(True), *new).alias(found + "2"))
    met = marked.join(light.hint("merge"), [*on, salt], "left").withColumn(found, F.coalesce(found, found + "2")).where(F.col(found).isNotNull())
    return met.select(*df.columns, *[F.col(f"{found}.{c}").alias(c) for c in new])
