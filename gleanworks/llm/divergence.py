"""Source divergence audit by systolic rotation.

For every language, each source's term shares are compared with those of every other source and of
the language as a whole. All arithmetic is on whole numbers and exact.

Systolic rotation. The groups (language, source) of a language are cut into blocks, and its kept
terms into segments by hash, so that a cell (language, segment, block) is bounded whatever the size of
a source or a vocabulary. A cell holds its groups' vectors, compressed. Cells are dealt to partitions
once and stay there. In round-robin tournament rounds the blocks of a language meet in pairs, every
two blocks once: in each round one side of a meeting travels to the other's partition, as compressed
bytes, and both directions of each pair of groups are evaluated there; round 0 is a cell's meeting
with itself. A round's sums are written, so a lost executor costs one round at most. While a cell is
packed, a heap for each of its groups ranks the group's terms; heaps meet in one final ranking.

How it scales. Documents are counted by (language, source, term) in their tasks before anything is
shuffled. Terms meet their language's counts by equality of (language, term), groups and languages are
joined by ``join_weighted``, so a language or source that holds most rows is not one task. A round moves
each compressed vector at most once; there are as many rounds as blocks of the largest language.
What is compared is each pair of sources, as the result asks for, never a pair of terms or documents.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator


import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanworks.llm.common import having, join_weighted, materialise, small_batches, sorted_runs, with_rank

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
SMOOTHING = 2
BLOCK_GROUPS, MAX_BLOCK_GROUPS, BLOCKS = 4, 256, 64
CELL_ENTRIES = 1 << 14
#: Entries of the dictionaries that a task counts in before it sends them on.
HELD_TERMS = 1 << 18
#: Letters, lower-cased, and all bytes beyond ASCII stay; every other byte becomes a blank.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of UTF-8 ``text``: longest runs of ASCII letters and characters beyond ASCII, A-Z lower-cased."""
    return (text or b"").translate(_TERMS).split()


def shares(count: np.ndarray, total: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact while the divisor is below 2**63 / 1000: long division by three digits at a time."""
    rest, by, out = count + SMOOTHING, total + SMOOTHING * kept, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // by, rest % by
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q)); shares are at most SCALE + 1, so squares fit a long."""
    return (p - q) * (p - q) // (p + q)


def term_counts(docs: DataFrame, held_terms: int = HELD_TERMS) -> DataFrame:
    """lang, source, term, n (occurrences) and df (documents) for ``docs`` of lang, source and text, none null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, df) in held.items():
                keys = list(n)
                for k in range(0, len(keys), 1 << 14):
                    part = keys[k : k + (1 << 14)]
                    cols = [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()), pa.array([n[t] for t in part], pa.int64()), pa.array([df[t] for t in part], pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "n", "df"])

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                n, df = held.setdefault((lang, source), (Counter(), Counter()))
                found, before = terms_of(text.as_py()), len(n)
                n.update(found)
                df.update(set(found))
                size += len(n) - before
                if size >= held_terms:
                    yield from out()
                    held.clear()
                    size = 0
        yield from out()

    small_batches(docs.sparkSession)
    found = docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(run, "lang string, source string, term binary, n long, df long")
    summed = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    return summed.select("lang", "source", F.col("term").cast("string").alias("term"), "n", "df")


def opponent(r: int, block: Column, blocks: Column) -> Column:
    """The block that ``block`` meets in round ``r`` from 1; null in a round without a meeting.

    With m places (blocks, and an empty one to make them even) the last place stays and the numbers of all
    others that meet add up to r modulo m - 1, so each two places meet in one of m - 1 rounds.
    """
    m = blocks + F.pmod(blocks, F.lit(2))
    turn = m - 1
    other = F.pmod(F.lit(r) - block, turn)
    alone = F.pmod(F.lit(r) * (m / 2).cast("long"), turn)  # the place with 2 * place = r
    meets = F.when(block == m - 1, alone).when(other == block, m - 1).otherwise(other)
    return F.when((F.lit(r) <= turn) & (meets < blocks), meets)


def pack(g: np.ndarray, absent: np.ndarray, n_terms: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """A cell as compressed bytes: groups, their shares of absent terms, and each one's term places and shares."""
    head = np.array([len(g), n_terms, *[len(i) for i, _ in parts]], np.int64)
    places = [np.diff(i, prepend=0).astype(np.int32).tobytes() for i, _ in parts]
    body = b"".join([head.tobytes(), g.tobytes(), absent.tobytes(), *places, *[p.astype(np.int32).tobytes() for _, p in parts]])
    return zstandard.ZstdCompressor(level=3).compress(body)


def unpack(body: bytes) -> tuple[np.ndarray, np.ndarray, int, list[tuple[np.ndarray, np.ndarray]]]:
    """What ``pack`` was given."""
    raw = zstandard.ZstdDecompressor().decompress(body)
    n, n_terms = np.frombuffer(raw, np.int64, 2).tolist()
    sizes = np.frombuffer(raw, np.int64, n, 16)
    g, absent = np.frombuffer(raw, np.int64, n, 16 + 8 * n), np.frombuffer(raw, np.int64, n, 16 + 16 * n)
    at = 16 + 24 * n
    flat = np.frombuffer(raw, np.int32, 2 * int(sizes.sum()), at).astype(np.int64)
    ends = np.cumsum(sizes).tolist()
    cuts, half = list(zip([0, *ends], ends, strict=False)), int(sizes.sum())
    return g, absent, n_terms, [(np.cumsum(flat[a:b]), flat[half + a : half + b]) for a, b in cuts]


def meet(home: bytes, peer: bytes) -> Iterator[tuple[int, int, int]]:
    """(group, other group, sum of gaps over the segment's terms) for each pair of a group here and one of the visitor, both ways; a cell with itself gives its own pairs."""
    g, absent, n_terms, parts = unpack(home)
    own = peer == home
    h, h_absent, _, h_parts = (g, absent, n_terms, parts) if own else unpack(peer)
    dense, there = np.zeros(n_terms, np.int64), np.zeros(n_terms, bool)
    for i in range(len(g)):
        at, p = parts[i]
        dense[:] = absent[i]
        dense[at] = p
        for j in range(i + 1 if own else 0, len(h)):
            at_j, q = h_parts[j]
            there[at_j] = True
            only = ~there[at]
            both_or_j = int(gap(dense[at_j], q).sum())
            only_i = int(gap(p[only], h_absent[j]).sum())
            neither = n_terms - len(at_j) - int(only.sum())
            value = both_or_j + only_i + neither * int(gap(absent[i], h_absent[j]))
            there[at_j] = False
            yield int(g[i]), int(h[j]), value
            yield int(h[j]), int(g[i]), value


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", block_groups: int = BLOCK_GROUPS, cell_entries: int = CELL_ENTRIES, held_terms: int = HELD_TERMS, rounds: list | None = None) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source's terms are from other sources' and from its language's.

    A language keeps the V terms that are in ``min_docs`` of its rows or more. A group or a language with
    N occurrences of kept terms gives a term with c of them the share p = 1 + floor(10**9 (c + 2) / (N + 2 V)).
    The gap of two shares is floor((p - q)**2 / (p + q)). Part ``pair``: the sum of gaps over all kept
    terms between the source and ``item``, each other source of the language (0 if V = 0). Part ``term``:
    the gap between the source and its language for kept terms that the source has with the greater
    share, the ``top`` first. Ranks are from 1 for each group and part, by value downwards, then item.

    Null texts, languages and sources are read as empty strings, so null and '' are one source. Each row
    is a document, repeated rows too. A source without terms takes part with its smoothed shares. A
    language of one source has no pairs. An empty table gives no rows. Only the three columns are
    read, and no other is returned, so no column clashes. ``rounds``, if given, gets the number of meetings of each round.
    """
    spark = docs.sparkSession
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text"))
    counts = materialise(term_counts(docs, held_terms), "term-counts")
    ranked, n_groups = with_rank(docs.select("lang", "source").distinct(), [F.col("lang"), F.col("source")], "g")
    result = "lang string, source string, part string, item string, value long, rank int"
    if not n_groups:
        return spark.createDataFrame([], result)
    ranked = materialise(ranked, "groups")

    # Kept terms with their place in a segment of their language.
    terms = materialise(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).where(F.col("df") >= min_docs).drop("df"), "terms")
    kept_of = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    langs = ranked.groupBy("lang").agg(F.min("g").alias("lang_at"), F.count(F.lit(1)).alias("n_groups")).join(kept_of, "lang", "left")
    size = F.greatest(F.lit(block_groups), F.least(F.lit(MAX_BLOCK_GROUPS), F.ceil(F.col("n_groups") / BLOCKS)))
    segments = F.greatest(F.lit(1), F.ceil(F.coalesce("kept", F.lit(0)) * F.col("size") / cell_entries))
    langs = langs.withColumn("size", size.cast("long")).withColumn("segments", segments.cast("long")).withColumn("blocks", F.ceil(F.col("n_groups") / F.col("size")).cast("long"))
    langs = materialise(langs.fillna(0, ["kept", "lang_total"]), "langs")
    of_lang = langs.select("lang", "lang_at", "segments", "lang_total", "kept")
    placed = join_weighted(terms, of_lang.select("*", F.col("kept").alias("w")), ["lang"], "w", F.xxhash64("term")) if terms.take(1) else None
    if placed is None:
        placed = terms.join(of_lang, "lang")
    placed = placed.withColumn("segment", F.pmod(F.xxhash64("term"), F.col("segments")))
    cell = Window.partitionBy("lang_at", "segment")
    placed = placed.withColumn("place", F.row_number().over(cell.orderBy("term")) - 1)
    placed = materialise(placed.select("lang", "term", "lang_n", "lang_total", "lang_at", "segment", "place"), "places")
    sizes = placed.groupBy("lang_at", "segment").agg(F.count(F.lit(1)).alias("n_terms"))

    # Groups with their block, and the occurrences of kept terms by group.
    kept = materialise(counts.select("lang", "source", "term", "n").join(placed.hint("merge"), ["lang", "term"]), "kept")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("w"))
    about = langs.select("lang", "lang_at", "size", "segments", "blocks", "kept", F.col("n_groups").alias("w_lang"))
    groups = join_weighted(ranked, about, ["lang"], "w_lang", F.xxhash64("g")).join(totals, ["lang", "source"], "left").fillna(0, ["total", "w"])
    groups = groups.withColumn("block", F.floor((F.col("g") - F.col("lang_at")) / F.col("size")).cast("long"))
    groups = materialise(groups, "groups")

    heads = groups.withColumn("segment", F.explode(F.sequence(F.lit(0).cast("long"), F.col("segments") - 1))).join(sizes, ["lang_at", "segment"], "left")
    names = ["lang_at", "segment", "block", "g", "place", "n", "total", "kept", "lang_n", "lang_total", "term", "blocks"]
    zero = F.lit(0).cast("long")
    heads = heads.select("lang_at", "segment", "block", "g", F.lit(-1).alias("place"), zero.alias("n"), "total", "kept", F.coalesce("n_terms", zero).alias("lang_n"), zero.alias("lang_total"), F.lit(None).cast("string").alias("term"), "blocks")
    mine = groups.select("lang", "source", "g", "block", "blocks", "total", "kept", "w").where("w > 0")
    entries = join_weighted(kept, mine, ["lang", "source"], "w", F.xxhash64("term")).select(*names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in sorted_runs(batches, ["lang_at", "segment", "block"]):
            col = {c: run[c].to_numpy() for c in names if c != "term"}
            first = np.flatnonzero(col["place"] == -1)  # a group's head stands before its terms
            p = shares(col["n"], col["total"], np.maximum(col["kept"], 1))
            q = shares(col["lang_n"], col["lang_total"], np.maximum(col["kept"], 1))
            parts, best = [], []
            for a, b in zip(first, [*first[1:], len(p)], strict=True):
                parts.append((col["place"][a + 1 : b], p[a + 1 : b]))
                more = a + 1 + np.flatnonzero(p[a + 1 : b] > q[a + 1 : b])
                f = gap(p[more], q[more])
                if len(f) > top:  # what is below the last rank by value alone needs no heap
                    line = np.partition(f, len(f) - top)[len(f) - top]
                    more, f = more[f >= line], f[f >= line]
                heap = heapq.nsmallest(top, zip((-f).tolist(), [t.as_py().encode() for t in run["term"].take(pa.array(more))], strict=True))
                best += [{"g": int(col["g"][a]), "value": -v, "term": t.decode()} for v, t in heap]
            body = pack(col["g"][first], p[first], int(col["lang_n"][first[0]]), parts)
            cols = [pa.array(col[c][:1]) for c in ("lang_at", "segment", "block", "blocks")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([body], pa.binary()), pa.array([best], pa.list_(pa.struct([("g", pa.int64()), ("value", pa.int64()), ("term", pa.string())])))], ["lang_at", "segment", "block", "blocks", "body", "best"])

    key = ["lang_at", "segment", "block"]
    dealt = entries.unionByName(heads.select(*names)).repartition(*key).sortWithinPartitions(*key, "g", "place")
    cells = materialise(dealt.mapInArrow(packed, "lang_at long, segment long, block long, blocks long, body binary, best array<struct<g: long, value: long, term: string>>"), "cells")

    pairs = _tournament(cells, int(langs.agg(F.max("blocks")).first()[0]), rounds)
    of = lambda end, name: groups.select(F.col("g").alias(end), *([] if end == "b" else ["lang"]), F.col("source").alias(name))
    pair = having(having(pairs, of("a", "source"), ["a"], "inner"), of("b", "item"), ["b"], "inner")
    term = cells.select(F.explode("best").alias("x")).select(F.col("x.g").alias("a"), F.col("x.term").alias("item"), F.col("x.value").alias("value"))
    term = having(term, of("a", "source"), ["a"], "inner")

    def ranks(df: DataFrame, part: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("a").orderBy(F.col("value").desc(), "item"))
        return df.withColumn("rank", place).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

    return ranks(pair, "pair").unionByName(ranks(term, "term").where(F.col("rank") <= top))


def _tournament(cells: DataFrame, blocks: int, seen: list | None) -> DataFrame:
    """a, b, value for each two groups of a language, by rounds in which one side of each meeting travels."""
    spark, key = cells.sparkSession, ["lang_at", "segment", "block"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    residents = cells.select(*key, "body").repartition(parts, *key).sortWithinPartitions(*key).persist(StorageLevel.DISK_ONLY)

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for home, peer in zip(batch.column(0), batch.column(1), strict=True):
                found = np.array(list(meet(home.as_py(), peer.as_py())), np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in range(3)], ["a", "b", "value"])

    done = []
    try:
        for r in range(blocks + blocks % 2 if blocks > 1 else 1):
            if r == 0:
                met = residents.select("body", F.col("body").alias("peer"))
            else:
                away = cells.withColumn("meets", opponent(r, F.col("block"), F.col("blocks"))).where(F.col("meets").isNotNull())
                stays = (F.pmod(F.col("block") + F.col("meets"), F.lit(2)) == 1) == (F.col("block") < F.col("meets"))
                away = away.where(~stays).select("lang_at", "segment", F.col("meets").alias("block"), F.col("body").alias("peer"))
                met = residents.join(away.repartition(parts, *key).hint("merge"), key).select("body", "peer")
            found = met.mapInArrow(evaluate, "a long, b long, value long").groupBy("a", "b").agg(F.sum("value").alias("value"))
            done.append(materialise(found, "meetings"))
            if seen is not None:
                seen.append(done[-1].count())
    finally:
        residents.unpersist()
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents' sources."""
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
t AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 10),
l AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM t GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN t USING (lang, term) GROUP BY ALL),
g AS (
  SELECT d.lang, d.source, coalesce(l.v, 0) AS v, coalesce(x.total, 0) AS total, coalesce(l.lang_total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) d LEFT JOIN l USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) x USING (lang, source)),
p AS (
  SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n,
         CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // CAST(g.total + 2 * g.v AS HUGEINT) AS HUGEINT) AS p,
         CAST(1 + CAST(1000000000 AS HUGEINT) * (t.lang_n + 2) // CAST(g.lang_total + 2 * g.v AS HUGEINT) AS HUGEINT) AS q
  FROM g JOIN t USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
