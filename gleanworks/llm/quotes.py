"""Quotation linking: conversations in reply order, without quotes.

A message's lines are parsed into quote levels (leading ``>`` marks; what follows a line such as
``-----Original Message-----`` is a level deeper); consecutive lines of a level without a blank one
between are a passage. Passages are normalised (lower case, single spaces) and hashed. A quoted
passage is joined to the first message that wrote it itself as a paragraph, a line or a sentence,
in the same conversation or, for at least ``min_words`` words, in any. If there is none, as when
somebody trimmed a paragraph, the longest of the passage's own lines and sentences that has a
source stands for it, if it has ``PIECE_WORDS`` words. A message replies to the source of its
outermost quote; if that quotes several messages, to the latest.

How it scales. Only what somebody quotes is looked for, and sources are reduced to one message for
each hash before any join, so a passage that very many messages share joins each of them to one
row. Reply chains are followed by pointer doubling over written tables, and places in the reply
order come from one range partitioning.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.llm.common import materialise, small_batches, with_rank

MIN_WORDS = 5
#: Words that a line or sentence must have to stand for the quoted passage it is a part of.
PIECE_WORDS = 3
#: Lines over which an attribution may run.
ATTRIBUTION_LINES = 3
_MARKS = re.compile(r"^[ \t]{0,3}((?:>[ \t]?)+)")
_ATTRIBUTION = re.compile(r"^\s*(?:on\b.{0,200}\bwrote|am\b.{0,200}\bschrieb.{0,80}|le\b.{0,200}\ba écrit|el\b.{0,200}\bescribió)\s*:\s*$", re.I)
_SEPARATOR = re.compile(r"^\s*-{2,}\s*(?:original message|forwarded message)\s*-{2,}\s*$", re.I)
_HEADER = re.compile(r"^\s*(?:from|sent|date|to|cc|subject|reply-to)\s*:", re.I)
_SENTENCE_END = re.compile(r"(?<=[.!?]) ")


def _levels(text: str) -> list[tuple[int, str | None]]:
    """The lines of ``text`` with their quote levels, attributions and separators of replies left out (as None)."""
    lines: list[tuple[int, str | None]] = []
    below, head = 0, False
    for line in text.split("\n"):
        m = _MARKS.match(line)
        level, body = (below + m[1].count(">"), line[m.end() :]) if m else (below, line)
        if _SEPARATOR.match(body):
            below, head = below + (m is None), True
            lines.append((max(level, below), None))
        elif head and (_HEADER.match(body) or not body.strip()):
            lines.append((level, None))
            head = bool(body.strip())
        else:
            lines.append((level, body))
            head = False
    deeper = 0  # the level of the next line with content, from the end
    ahead = [0] * len(lines)
    for k in range(len(lines) - 1, -1, -1):
        ahead[k] = deeper
        if lines[k][1] is None or lines[k][1].strip():
            deeper = lines[k][0]
    k = 0
    while k < len(lines):
        level, joined = lines[k][0], ""
        for end in range(k, min(k + ATTRIBUTION_LINES, len(lines))):
            if lines[end][0] != level or not (lines[end][1] or "").strip():
                break
            joined += " " + lines[end][1]
            if _ATTRIBUTION.match(joined):
                if ahead[end] > level:
                    lines[k : end + 1] = [(level, None)] * (end + 1 - k)
                    k = end
                break
        k += 1
    return lines


def _normal(text: str) -> str:
    return " ".join(text.lower().split())


def parse_message(text: str | None) -> tuple[str, list[tuple[int, str, list[str]]]]:
    """(text without quotes and their attributions, quoted passages as (level, normalised text, its lines and sentences)).

    Null texts have neither. Own lines that a removed quote stood between are parted by one blank line.
    """
    if not text:
        return "", []
    lines = _levels(text)
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    last, cut = None, False
    for level, body in lines:
        if level or body is None:
            cut = True
        elif body.strip():
            if cut and own and own[-1].strip():
                own.append("")
            own.append(body)
            cut = False
        elif not cut or (own and own[-1].strip()):
            own.append(body)
        if body is None or not body.strip():
            last = None
            continue
        if level and level != last:
            passages.append((level, []))
        if level:
            passages[-1][1].append(body)
        last = level
    quoted = any(level or body is None for level, body in lines)
    return ("\n".join(own).strip("\n") if quoted else text), [(level, _normal(" ".join(p)), _pieces(p)) for level, p in passages]


def _pieces(lines: list[str]) -> list[str]:
    """The distinct lines and sentences of a paragraph, normalised, but for the paragraph itself."""
    whole = _normal(" ".join(lines))
    found = dict.fromkeys([*map(_normal, lines), *_SENTENCE_END.split(whole)])
    return [p for p in found if p and p != whole]


def own_units(text: str | None) -> set[str]:
    """What a quote of ``text``, which holds none itself, may consist of: its paragraphs, lines and sentences, normalised."""
    out: set[str] = set()
    paragraph: list[str] = []
    for line in [*(text or "").split("\n"), ""]:
        if line.strip():
            paragraph.append(line)
        elif paragraph:
            out.add(_normal(" ".join(paragraph)))
            out.update(_pieces(paragraph))
            paragraph = []
    return out


def _hash(passage: str) -> bytes:
    return hashlib.blake2b(passage.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def link_quotes(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", role_col: str = "role", min_words: int = MIN_WORDS
) -> DataFrame:
    """A row for each row of ``messages``, its quotes resolved and removed.

    Columns: conversation, turn and role; text without quotes; reply_conv and reply_turn (null if
    nothing quoted was found), depth (replies up to the thread's first message), thread_conv (the
    conversation of that first message), position (from 0 in its thread's reply order, in which
    every reply comes after its source), quotes and linked (numbers of quoted passages and of those
    found, whole or by a piece). Messages are in order of conversation, turn and, if repeated, input place; a source is
    always earlier, so links have no cycle. Rows with a null conversation or turn keep their text
    without quotes but are no source and reply to none; those of a null conversation form one
    thread. Columns not named are not read; an empty table gives no rows.
    """
    role = F.col(role_col).cast("string") if role_col in messages.columns else F.lit(None).cast("string")
    rows = messages.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("level", pa.int32()), ("number", pa.int32()), ("hash", pa.binary()), ("words", pa.int32()), ("whole", pa.bool_())]))
        for batch in batches:
            texts, found = [], []
            for t in batch.column(3).to_pylist():
                own, passages = parse_message(t)
                texts.append(None if t is None else own)
                parts = []
                for number, (level, whole, pieces) in enumerate(passages):
                    for p in [whole, *pieces]:
                        parts.append({"level": level, "number": number, "hash": _hash(p), "words": len(p.split()), "whole": p == whole})
                found.append(parts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.string()), pa.array(found, kind)], ["conv", "turn", "role", "text", "passages"])

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for k, t in enumerate(batch.column(3).to_pylist()):
                mine = [_hash(u) for u in own_units(t)]
                at += [k] * len(mine)
                found += mine
            where = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(where) for c in range(3)), pa.array(found, pa.binary())], ["conv", "turn", "mid", "hash"])

    small_batches(messages.sparkSession)
    parsed = rows.mapInArrow(run, "conv long, turn long, role string, text string, passages array<struct<level:int,number:int,hash:binary,words:int,whole:boolean>>")
    parsed = materialise(parsed.withColumn("mid", F.monotonically_increasing_id()), "messages")
    placed = parsed.where(F.col("conv").isNotNull() & F.col("turn").isNotNull())
    quotes = materialise(placed.where(F.size("passages") > 0).select("conv", "turn", "mid", F.explode("passages").alias("p")).select("conv", "turn", "mid", "p.*"), "quotes")
    linked = None
    if quotes.head(1):
        wanted = quotes.select("hash").distinct()
        who = F.struct("conv", "turn", "mid")
        said = placed.select("conv", "turn", "mid", "text").mapInArrow(units, "conv long, turn long, mid long, hash binary")
        own = said.join(wanted, "hash", "left_semi")
        near = materialise(own.groupBy("conv", "hash").agg(F.min(who).alias("near")), "sources")
        far = materialise(near.groupBy("hash").agg(F.min("near").alias("far")), "first-sources")
        both = quotes.join(near, ["conv", "hash"], "left").join(far, "hash", "left")
        me = F.struct("conv", "turn", "mid")
        here = F.when(F.col("near") < me, F.col("near"))
        there = F.when((F.col("far") < me) & (F.col("words") >= min_words), F.col("far"))
        both = both.withColumn("source", F.when(F.col("whole") | (F.col("words") >= PIECE_WORDS), F.coalesce(here, there)))
        part = F.struct("whole", "words", "source")
        both = both.groupBy("mid", "number", "level").agg(F.max(F.when(F.col("source").isNotNull(), part))["source"].alias("source"))
        best = F.max(F.when(F.col("source").isNotNull(), F.struct((-F.col("level")).alias("near"), "source"))).alias("best")
        linked = both.groupBy("mid").agg(F.count(F.lit(1)).alias("quotes"), F.count("source").alias("linked"), best)
        linked = materialise(linked.select("mid", "quotes", "linked", F.col("best.source").alias("source")), "linked")
        up = linked.where(F.col("source").isNotNull()).select("mid", F.col("source.mid").alias("top"), F.lit(1).cast("long").alias("depth"))
        up = materialise(up, "up")
        while True:
            above = up.select(F.col("mid").alias("top"), F.col("top").alias("higher"), F.col("depth").alias("more"))
            grown = up.join(above, "top", "left").select("mid", F.coalesce("higher", "top").alias("top"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("higher").isNotNull().alias("moved"))
            grown = materialise(grown, "up")
            up = grown.drop("moved")
            if not grown.where("moved").head(1):
                break
        roots = materialise(up.select("top").distinct().join(placed.select(F.col("mid").alias("top"), F.col("conv").alias("thread")), "top"), "roots")
        linked = linked.join(up.join(roots, "top").select("mid", "depth", "thread"), "mid", "left")
        linked = materialise(linked.select("mid", "quotes", "linked", F.col("source.conv").alias("reply_conv"), F.col("source.turn").alias("reply_turn"), "depth", "thread"), "replies")
        full = parsed.drop("passages").join(linked, "mid", "left")
    else:
        none = {"quotes": "long", "linked": "long", "reply_conv": "long", "reply_turn": "long", "depth": "long", "thread": "long"}
        full = parsed.drop("passages").select("*", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    zero = F.lit(0).cast("long")
    full = full.withColumn("thread", F.coalesce("thread", "conv")).withColumn("depth", F.coalesce("depth", zero))
    ranked, _ = with_rank(full, [F.col(c) for c in ("thread", "conv", "turn", "mid")], "rank")
    starts = materialise(ranked.groupBy("thread").agg(F.min("rank").alias("start")), "threads")
    blank = ranked.where(F.col("thread").isNull())
    named = ranked.where(F.col("thread").isNotNull()).join(starts.where(F.col("thread").isNotNull()), "thread").unionByName(blank.withColumn("start", zero))  # nulls are first
    return named.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), F.col("text").alias(text_col), "reply_conv", "reply_turn", "depth",
        F.col("thread").alias("thread_conv"), (F.col("rank") - F.col("start")).alias("position"), F.coalesce("quotes", zero).alias("quotes"), F.coalesce("linked", zero).alias("linked"),
    )


def op10_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotes."""
    return link_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


