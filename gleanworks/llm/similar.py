"""SimHash near-duplicates at a stated similarity of word shingles.

At a Jaccard similarity of 0.8 two fingerprints differ in about 15 % of their bits, too many for a
few bits of a 64-bit fingerprint. So a fingerprint here has 256 bits over the distinct shingles,
and it is put in many shards, one for each of a list of random bit positions: two documents at the
similarity agree on one of them with probability RECALL or more. Bits to a shard follow the
logarithm of the number of documents, so shards stay small, and the number of lists grows slowly
(a power of about 0.24) with it.

Near. Each shard is searched with BK-trees over 128 of the bits, one tree for each group of
fingerprints that are near each other, within a radius of three standard deviations beyond the
expected distance. A search of a tree ends at its first hit, and a fingerprint all but equal to one
that a tree holds is not added (the radius is wider by as much), so crowded shards stay cheap. The
bits of texts of few shingles vary more; such texts meet by the rarest of their shingles instead,
so many that two at the similarity surely share one. Hits only say which documents are near; what
they connect is a neighbourhood.

Linked. All pairs of a neighbourhood are compared, in tiles of two blocks of bounded size: first
the radius, then a sketch, and where the sketch leaves it open the shingle sets themselves. A tile
follows its own links, so that large groups of copies cost a row of comparisons each, and reports
a tree of links, never pairs. Nothing is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanworks.llm.common import connected_components, free_name, having, materialise, small_batches, sorted_runs
from gleanworks.llm.simhash import _LOWER, _U64, _WORD

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.997
SHORT = 75  # shingles
_SAME = 2  # of 128 bits
BLOCK_ROWS = 1024
BLOCK_BYTES = 8 << 20
_MIX = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_FP = ["f0", "f1", "f2", "f3"]
_CELLS = 512  # of a sketch, a power of two


def shingle_hashes(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of ``text``; of fewer words, of their sequence."""
    found = _WORD.findall(text.translate(_LOWER)) if text else []
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: max(1, len(found) - words + 1)]
    stops = ends[min(words, len(found)) - 1 :]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)), np.uint64, len(starts)))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """256 bits as four words; zeros for no hashes."""
    out = np.zeros(4, np.uint64)
    if not len(hashes):
        return out
    for k, odd in enumerate(_MIX):
        h = hashes * np.uint64(odd)
        if k:
            h ^= h >> np.uint64(31)
        lanes = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        # A byte of a lane counts up to 255 rows.
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        counts = sums.view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0]
    return out


def bit_share(similarity: float) -> float:
    """The expected share of bits in which fingerprints at a Jaccard similarity differ."""
    return math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi


def lists_for(rows: int, similarity: float, recall: float = RECALL) -> list[np.ndarray]:
    """Random lists of bit positions, enough for ``recall`` at ``similarity``."""
    bits = max(8, math.floor(math.log2(max(2, rows))) - 4)
    n = math.ceil(math.log(1 / (1 - recall)) / (1 - bit_share(similarity)) ** bits)
    draw = np.random.default_rng(2024)
    return [np.sort(draw.choice(256, bits, replace=False)) for _ in range(n)]


class NearTree:
    """A BK-tree of (value, id) that is asked whether it holds a near one."""

    __slots__ = ("root",)

    def __init__(self, value: int, name: int) -> None:
        self.root: tuple[int, int, dict] = (value, name, {})

    def add(self, value: int, name: int) -> None:
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            if d not in node[2]:
                node[2][d] = (value, name, {})
                return
            node = node[2][d]

    def near(self, value: int, radius: int) -> int | None:
        """The id of a held value at a distance of ``radius`` or less, the first that is met."""
        open_ = [self.root]
        while open_:
            node, name, kids = open_.pop()
            d = (node ^ value).bit_count()
            if d <= radius:
                return name
            if kids:
                low, high = d - radius, d + radius
                open_ += [kid for at, kid in kids.items() if low <= at <= high]
        return None


class Neighbours:
    """The fingerprints of one shard, as groups of trees; ``add`` gives an id of each group that is near."""

    __slots__ = ("groups", "radius")

    def __init__(self, radius: int) -> None:
        self.groups: list[list[NearTree]] = []
        self.radius = radius

    def add(self, value: int, name: int) -> list[int]:
        for group in self.groups:
            for tree in group:
                if (same := tree.near(value, _SAME)) is not None:
                    return [same]
        found, near, far = [], [], []
        for group in self.groups:
            hit = next((x for tree in group if (x := tree.near(value, self.radius + _SAME)) is not None), None)
            if hit is None:
                far.append(group)
            else:
                found.append(hit)
                near += group
        if near:
            near[0].add(value, name)
        else:
            near.append(NearTree(value, name))
        self.groups = [*far, near]
        return found


def _shards(lists: list[np.ndarray]):
    masks = np.zeros((len(lists), 4), np.uint64)
    for k, bits in enumerate(lists):
        for b in bits.tolist():
            masks[k, b // 64] |= np.uint64(1 << (b % 64))
    odd = np.array(_MIX, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                gid = part.column(0).to_numpy()
                fp = np.stack([part.column(1 + j).to_numpy().view(np.uint64) for j in range(4)], axis=1)
                keys = np.empty((len(gid), len(lists)), np.uint64)
                for t in range(len(lists)):
                    held = (fp & masks[t]) * odd
                    held ^= held >> np.uint64(29)
                    keys[:, t] = held.sum(axis=1, dtype=np.uint64) * np.uint64(_MIX[1]) + np.uint64(t)
                each = lambda x: pa.array(np.repeat(x, len(lists)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), each(gid), each(fp[:, 0].view(np.int64)), each(fp[:, 1].view(np.int64))], ["shard", "gid", "f0", "f1"])

    return run


def _search(radius: int):
    """Rows sorted by shard to ``a, b``: links enough to connect what is near in a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, last, out = Neighbours(radius), None, []
        held: tuple | None = None  # a shard's first row, put in a tree once there is a second
        for batch in batches:
            for shard, gid, f0, f1 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                value = (f0 & _U64) << 64 | f1 & _U64
                if shard != last:
                    near, last, held = Neighbours(radius), shard, (value, gid)
                    continue
                if held:
                    near.add(*held)
                    held = None
                out += [(gid, other) for other in near.add(value, gid)]
            if out:
                yield _pairs(out)
                out = []

    return run


def _pairs(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])


def _short_links(distinct: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: texts of few shingles and the first text that has one of their rarest shingles in common.

    Sets of n and more shingles at the similarity have at most n - ceil(similarity * n) that the
    other lacks, so of one more of the rarest of each, by one order over all, they share one.
    """
    each = distinct.where(F.size("who.short") > 0).select("gid", F.size("who.short").alias("n"), F.explode("who.short").alias("h"))
    counts = each.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    common = each.join(counts, "h").groupBy("gid", "n").agg(F.sort_array(F.collect_list(F.struct("times", "h"))).alias("common"))
    first = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1 - (F.col("n") - F.size("common"))
    shared = materialise(common.withColumn("first", first.cast("int")).where("first > 0").select("gid", F.explode(F.slice("common", F.lit(1), F.col("first"))).alias("c")).select("gid", "c.h"), "rare-shingles")
    least = shared.groupBy("h").agg(F.min("gid").alias("b"))
    return shared.join(least, "h").where("gid <> b").select(F.col("gid").alias("a"), "b")


def short_hashes(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct 32-bit forms of shingle hashes, for sets that are moved."""
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32))


def sketch(held: np.ndarray) -> np.ndarray:
    """A byte for each of ``_CELLS`` equal ranges of hashes: 0 if the set has none there, else of its least one."""
    out = np.zeros(_CELLS, np.uint8)
    if len(held):
        cell = held >> np.uint32(32 - (_CELLS.bit_length() - 1))
        firsts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        out[cell[firsts]] = held[firsts] % np.uint32(255) + np.uint32(1)
    return out


def similar_enough(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets of hashes have the Jaccard similarity."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)) - 1e-9:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both) - 1e-9


def link_tile(gids: np.ndarray, fps: np.ndarray, sets: list[np.ndarray], split: int, radius: int, similarity: float) -> list[tuple[int, int]]:
    """A tree of the links between the first ``split`` rows and the others; of all rows, if there are no others."""
    n = len(gids)
    sizes = np.array([len(s) for s in sets])
    cells = np.stack([sketch(s) for s in sets])
    root, out = np.arange(n), []
    for i in range(split):
        low = i + 1 if split == n else split
        at = low + np.flatnonzero(root[low:] != root[i])
        if sizes[i] > SHORT:
            at = at[(np.bitwise_count(fps[at] ^ fps[i]).sum(axis=1) <= radius) | (sizes[at] <= SHORT)]
        at = at[np.minimum(sizes[at], sizes[i]) >= similarity * np.maximum(sizes[at], sizes[i]) - 1e-9]
        if not len(at):
            continue
        neither = ((cells[at] | cells[i]) == 0).sum(axis=1)
        share = ((cells[at] == cells[i]).sum(axis=1) - neither) / np.maximum(_CELLS - neither, 1)
        # A cell shared by several hashes may hide a common one: of small sets a few count for much.
        open_ = similarity - np.maximum(4.5 * math.sqrt(similarity * (1 - similarity) / _CELLS), 3 / np.maximum(1, np.minimum(sizes[at], sizes[i])))
        ok = share >= open_
        at, share = at[ok], share[ok]
        for j in at[np.argsort(-share, kind="stable")].tolist():
            if root[j] != root[i] and similar_enough(sets[i], sets[j], similarity):
                out.append((int(gids[i]), int(gids[j])))
                root[root == root[j]] = root[i]
    return out


def _linked(near: DataFrame, sets: DataFrame, radius: int, similarity: float, block_rows: int, block_bytes: int) -> DataFrame:
    """``a, b``: links enough to connect all that link within a neighbourhood (gid, near); sets: gid, f0, f1, s."""
    rows = sets.join(near, "gid")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.ceil(F.sum(F.octet_length("s")) / block_bytes)).cast("int")
    sizes = materialise(rows.groupBy("near").agg(blocks.alias("blocks")), "neighbourhoods")
    mine = rows.join(sizes, "near").withColumn("block", F.pmod(F.xxhash64("gid"), F.greatest("blocks", F.lit(1))).cast("int"))
    tiled = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest(F.col("blocks"), F.lit(1)) - 1)))
    key = ["near", "low", "high"]
    tiled = tiled.select("near", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "gid", "f0", "f1", "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for tile in sorted_runs(batches, key):
            gids, block = tile["gid"].to_numpy(), tile["block"].to_numpy()
            own = np.flatnonzero(np.r_[True, gids[1:] != gids[:-1]])  # repeated rows have one text
            fps = np.stack([tile[c].to_numpy()[own].view(np.uint64) for c in ("f0", "f1")], axis=1)
            held = tile["s"].combine_chunks()
            held = [np.frombuffer(held[k].as_buffer(), np.uint32) for k in own.tolist()]
            first = int((block[own] == tile["low"][0].as_py()).sum())
            if len(own) > 1:
                out += link_tile(gids[own], fps, held, first, radius, similarity)
            if len(out) >= 1 << 14:
                yield _pairs(out)
                out = []
        if out:
            yield _pairs(out)

    return tiled.repartition(*key).sortWithinPartitions(*key, "block", "gid").mapInArrow(run, "a long, b long")


def near_duplicate_survivors(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near duplicates: that of the smallest id.

    Documents are linked if the Jaccard similarity of their sets of ``words``-word shingles is at
    least ``similarity``; groups are what links connect. Texts without words, null ones among them,
    are copies of each other. A null id counts as the largest; of a group's rows with the smallest
    id one text's stay, and of rows equal in id and text any one. Columns are those of ``docs``,
    whatever their names; an empty table gives no rows. ``docs`` is read three times and must give
    the same rows each time; texts are not written and, up to ``BROADCAST_IDS`` of the ids that are
    sought, not shuffled.
    """
    small_batches(docs.sparkSession)
    keys = [free_name(docs, "k1_"), free_name(docs, "k2_")]
    text = F.col(text_col).cast("binary")
    hashed = [F.xxhash64(F.col(id_col), text).alias(keys[0]), F.xxhash64(F.lit("second"), F.col(id_col), text).alias(keys[1])]
    rows = docs.select(hashed[0].alias("k1"), hashed[1].alias("k2"), F.col(id_col).alias("id"), text.alias("body"))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, short = np.empty((batch.num_rows, 4), np.uint64), []
            for k, t in enumerate(batch.column(3)):
                found = shingle_hashes(t.as_py(), words)
                fp[k] = wide_fingerprint(found)
                short.append(found.view(np.int64) if len(found) <= SHORT else None)
            cols = [pa.array(fp[:, j].view(np.int64)) for j in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *cols, pa.array(short, pa.list_(pa.int64()))], ["k1", "k2", "id", *_FP, "short"])

    kind = docs.schema[id_col].dataType.simpleString()
    marked = materialise(rows.mapInArrow(prints, f"k1 long, k2 long, id {kind}, f0 long, f1 long, f2 long, f3 long, short array<long>"), "fingerprints")
    who = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2", "short")
    distinct = marked.groupBy(*_FP).agg(F.min(who).alias("who"))
    distinct = materialise(distinct.withColumn("gid", F.monotonically_increasing_id()), "distinct")
    share = bit_share(similarity)
    radius = math.ceil(128 * share + 3 * math.sqrt(128 * share * (1 - share)))
    sharded = distinct.select("gid", *_FP).mapInArrow(_shards(lists_for(distinct.count(), similarity)), "shard long, gid long, f0 long, f1 long")
    found = sharded.repartition("shard").sortWithinPartitions("shard", "gid").mapInArrow(_search(radius), "a long, b long")
    near = connected_components(found.unionAll(_short_links(distinct, similarity))).select(F.col("node").alias("gid"), F.col("label").alias("near"))
    near = materialise(near.join(distinct.select("gid", "who.k1", "who.k2", "f0", "f1"), "gid"), "near")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [short_hashes(shingle_hashes(t.as_py(), words)).tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], ["gid", "f0", "f1", "s"])

    texts = having(rows.select("k1", "k2", "body"), near.select("k1", "k2", "gid", "f0", "f1"), ["k1", "k2"], "inner")
    sets = materialise(texts.select("gid", "f0", "f1", "body").mapInArrow(sets_of, "gid long, f0 long, f1 long, s binary"), "shingle-sets")
    links = _linked(near.select("gid", "near"), sets, radius, similarity, block_rows, block_bytes)
    labels = connected_components(links)
    of = distinct.select("gid", "who").join(labels.select(F.col("node").alias("gid"), "label"), "gid", "left")
    stay = of.groupBy(F.coalesce("label", "gid").alias("label")).agg(F.min("who").alias("who"))
    again = marked.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    stay = stay.select(F.col("who.k1").alias("k1"), F.col("who.k2").alias("k2")).join(again, ["k1", "k2"], "left")
    stay = materialise(stay.select(F.col("k1").alias(keys[0]), F.col("k2").alias(keys[1]), F.col("rows").isNotNull().alias("repeated")), "stay")
    keyed = docs.select("*", *hashed)
    once = having(keyed, stay.where(~F.col("repeated")).drop("repeated"), keys)
    repeated = stay.where("repeated").drop("repeated")
    if repeated.head(1):
        once = once.unionByName(having(keyed, repeated, keys).dropDuplicates(keys))
    return once.drop(*keys)
