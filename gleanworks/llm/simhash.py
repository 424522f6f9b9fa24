"""SimHash near-duplicates by sharded BK-trees.

A document's fingerprint is the bitwise majority of its shingles' hashes. Fingerprints that differ
in at most ``radius`` bits link; linked documents form a component.

How it scales. Only distinct fingerprints are compared. Were their bits cut into ``radius + 1``
groups, two that link would agree on at least one whole group; so each fingerprint goes to one
shard for each group, named by the group's mask and the bits under it. A shard of more than
``shard_rows`` fingerprints is cut again by groups of its remaining bits, which loses no link for
the same reason. After five levels at most 16 bits remain, so no shard has more than 65,536
fingerprints. Each shard is one BK-tree, built and searched in one task: a node's children are
keyed by their integer distance to it, and a search follows only edges within the radius. Trees
reach their queries by the shuffle, not through the driver, since together they hold every
fingerprint. A task reports each tree's own components as stars, never all pairs, and the stars
meet in a distributed component search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.llm.common import connected_components, materialise, small_batches

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
SHARD_ROWS = 512
_LEVELS = 5
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_U64 = (1 << 64) - 1


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of UTF-8 ``text``; 0 for null, empty and blank texts."""
    found = _WORD.findall(text.translate(_LOWER)) if text else []
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(found) - words + 1]
    pieces = [joined[a:b] for a, b in zip(starts.tolist(), ends[words - 1 :].tolist(), strict=True)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces))
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        octets = hashes[k : k + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(majority.view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``id_col`` and ``fp`` (a long holding the 64 bits) for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [_signed(fingerprint(t.as_py(), words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(bits, pa.int64())], ["id", "fp"])

    small_batches(docs.sparkSession)
    pair = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("body"))
    return pair.mapInArrow(run, "id long, fp long").withColumnRenamed("id", id_col)


def child_masks(mask: int, groups: int) -> list[int]:
    """``mask`` with each of ``groups`` groups of its free bits added in turn."""
    free = [k for k in range(64) if not mask >> k & 1]
    return [mask | sum(1 << int(k) for k in part) for part in np.array_split(free, groups)]


class BKTree:
    """Integers under Hamming distance; a node's children are keyed by their distance to it."""

    __slots__ = ("root", "size")

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None
        self.size = 0

    def add(self, value: int) -> None:
        self.size += 1
        if self.root is None:
            self.root = (value, {})
            return
        node, kids = self.root
        while True:
            d = (node ^ value).bit_count()
            if d not in kids:
                kids[d] = (value, {})
                return
            node, kids = kids[d]

    def within(self, value: int, radius: int) -> list[int]:
        """All held values at a distance of ``radius`` or less."""
        found, open_ = [], [self.root] if self.root else []
        while open_:
            node, kids = open_.pop()
            d = (node ^ value).bit_count()
            if d <= radius:
                found.append(node)
            if kids:
                low, high = d - radius, d + radius
                open_ += [kid for at, kid in kids.items() if low <= at <= high]
        return found


def tree_stars(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, centre) for each value that links within ``values``, which are distinct."""
    tree, parent = BKTree(), {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for v in values:
        parent[v] = v
        for near in tree.within(v, radius):
            parent[find(near)] = find(v)
        tree.add(v)
    return [(v, root) for v in values if (root := find(v)) != v]


def _link_shards(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[tuple[int, int, int]] = []  # the last shard of a batch may go on in the next
        out: list[tuple[int, int]] = []

        def close(shard: list[tuple[int, int, int]]) -> None:
            if len(shard) > 1:
                out.extend(tree_stars([fp & _U64 for _, _, fp in shard], radius))

        def emit() -> pa.RecordBatch:
            both = [pa.array([_signed(pair[k]) for pair in out], pa.int64()) for k in (0, 1)]
            out.clear()
            return pa.RecordBatch.from_arrays(both, ["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if left and left[-1][:2] != row[:2]:
                    close(left)
                    left = []
                left.append(row)
            if out:
                yield emit()
        close(left)
        if out:
            yield emit()

    return run


def _explode_shards(df: DataFrame, masks: dict[int, list[int]] | list[int]) -> DataFrame:
    """Each fingerprint once for each child mask of its shard (or for each mask of a list)."""
    lits = lambda ms: F.array(*[F.lit(_signed(m)).cast("long") for m in ms])
    if isinstance(masks, list):
        picked = lits(masks)
    else:
        picked = F.create_map(*[x for m, kids in masks.items() for x in (F.lit(_signed(m)).cast("long"), lits(kids))])[F.col("mask")]
    return df.select("fp", F.explode(picked).alias("mask")).select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("bits"), "fp")


def fingerprint_stars(fps: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``a, b``: links enough to connect all distinct ``fp`` within ``radius`` of each other."""
    groups, masks = radius + 1, child_masks(0, radius + 1)
    open_, done = _explode_shards(fps, masks), []
    for level in range(1, _LEVELS + 1):
        if level == _LEVELS:
            done.append(open_)
            break
        crowded = materialise(open_.groupBy("mask", "bits").count().where(F.col("count") > shard_rows).select("mask", "bits"), "crowded")
        if not crowded.head(1):
            done.append(open_)
            break
        told = materialise(open_.join(crowded.withColumn("more", F.lit(True)), ["mask", "bits"], "left"), f"shards{level}")
        done.append(told.where(F.col("more").isNull()).select("mask", "bits", "fp"))
        kids = {m: child_masks(m, groups) for m in masks}
        open_ = _explode_shards(told.where(F.col("more")), kids)
        masks = sorted({x for ks in kids.values() for x in ks})
    shards = done[0]
    for more in done[1:]:
        shards = shards.unionAll(more)
    dealt = shards.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp")
    return dealt.mapInArrow(_link_shards(radius), "a long, b long")


def _components(docs: DataFrame, id_col: str, text_col: str, words: int, radius: int, shard_rows: int) -> DataFrame:
    prints = materialise(fingerprints(docs, id_col, text_col, words), "fingerprints")
    held = materialise(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    labels = connected_components(fingerprint_stars(held.select("fp"), radius, shard_rows))
    of = held.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left")
    of = materialise(of.select("fp", "least", F.coalesce("label", "fp").alias("label")), "labelled")
    least = materialise(of.groupBy("label").agg(F.min("least").alias("component_id")), "components")
    known = materialise(of.join(least, "label").select("fp", "label", "component_id"), "known")
    return prints.join(known, "fp").select(id_col, "fp", "label", "component_id")


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fp`` and ``component_id``.

    component_id is the smallest ``id_col`` among the documents reachable by links, the row's own
    included. Null, empty and blank texts have fingerprint 0, which links like any other. A row
    whose id is null is compared too and gets its component's smallest id, or null if no document
    there has an id. Repeated rows give repeated results; other columns are not looked at. An
    empty table gives an empty result.
    """
    return _components(docs, id_col, text_col, words, radius, shard_rows).drop("label")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents."""
    found = simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
