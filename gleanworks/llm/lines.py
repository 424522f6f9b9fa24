"""Line dedup: lines that many documents share are dropped from all of them.

Texts are exploded to their normalised lines; a line's key is hashed to 128 bits. Distinct
documents are counted for each hash, hashes at or over the threshold are looked up again in each
document's lines, and texts are reassembled by position from the lines that are left.

How it scales. A document gives each of its hashes once, so a plain count of rows is the count of
documents, and a line that is in every document is summed up before the shuffle. Text is shuffled
once; what else moves is a hash of 16 bytes for each distinct line of a document. Common hashes are
joined back by ``join_weighted``: those with a large share of the rows, of which there is a fixed
number at most, are broadcast, all others meet in a sorted join. Decisions come back to a document
under a hash of its id and its text: copies have keys of their own, and should two documents ever
meet under one key they get each other's common hashes, which changes nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.llm.common import free_name, join_weighted, materialise, small_batches

MIN_DOCS = 10
MIN_CHARS = 1
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_hashes(text: bytes | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """For each line of UTF-8 ``text`` the 128-bit hash of its key, None where the key is shorter than ``min_chars`` code points."""
    keys = [line.strip(_SPACE) for line in (text or b"").translate(_LOWER).split(b"\n")]
    if min_chars <= 1:
        return [xxhash.xxh3_128_digest(k) if k or not min_chars else None for k in keys]
    return [xxhash.xxh3_128_digest(k) if len(k.decode("utf-8", "replace")) >= min_chars else None for k in keys]


def without(text: bytes | None, dropped: set[bytes], min_chars: int = MIN_CHARS) -> tuple[bytes, int, int]:
    """``text`` without the lines whose hashes are in ``dropped``, its number of lines before, and how many went."""
    text = text or b""
    if not dropped:
        return text, text.count(b"\n") + 1, 0
    hashes = line_hashes(text, min_chars)
    kept = [line for line, h in zip(text.split(b"\n"), hashes, strict=True) if h not in dropped]
    return b"\n".join(kept), len(hashes), len(hashes) - len(kept)


def common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, text_col: str = "text") -> DataFrame:
    """``hash`` (binary) and ``n``, its documents, of every key that is in ``min_docs`` rows of ``docs`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter = Counter()
            for text in batch.column(0):
                n.update(set(line_hashes(text.as_py(), min_chars)))
            n.pop(None, None)
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.binary()), pa.array(n.values(), pa.int64())], ["hash", "n"])

    small_batches(docs.sparkSession)
    found = docs.select(F.col(text_col).cast("binary")).mapInArrow(run, "hash binary, n long")
    return found.groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text", lines_col: str = "n_lines", dropped_col: str = "n_dropped") -> DataFrame:
    """``docs`` with ``text_col`` without common lines, and with the number of its lines before and of those dropped.

    A line's key is the line without the ASCII white space at its ends and with A-Z lower-cased.
    Keys of at least ``min_chars`` code points that are in at least ``min_docs`` rows go from every
    row, each occurrence of them; other lines stay as they are, in their order.

    Each row is a document, rows with one id or equal rows too. A null text is read as empty, which
    is one empty line, and comes back empty; a text whose lines all go is empty as well. Null ids
    are allowed. Other columns are returned as they are, but one named ``lines_col`` or
    ``dropped_col`` (in either case) is an error. Rows equal in id and text have one key; Spark's
    adaptive join splits those if they are very many.
    """
    clash = {lines_col.lower(), dropped_col.lower()} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns that would be overwritten: {sorted(clash)}")
    common = materialise(common_lines(docs, min_docs, min_chars, text_col), "common-lines")
    key, drop, out = (free_name(docs, c) for c in ("line_key_", "line_drop_", "line_out_"))
    of_row = F.xxhash64(F.col(id_col), F.col(text_col))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(set(line_hashes(t.as_py(), min_chars)) - {None}) for t in batch.column(1)]
            keys = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([h for x in found for h in x], pa.binary())], ["key", "hash"])

    lines = docs.select(of_row.alias("key"), F.col(text_col).cast("binary").alias("text")).mapInArrow(explode, "key long, hash binary")
    met = join_weighted(lines, common, ["hash"], "n", F.xxhash64("key"))
    decided = met.groupBy(F.col("key").alias(key)).agg(F.collect_set("hash").alias(drop))
    joined = docs.withColumn(key, of_row).join(decided.hint("merge"), key, "left")

    @F.arrow_udf("struct<text: binary, n: long, d: long>")
    def kept(texts: pa.Array, drops: pa.Array) -> pa.Array:
        rows = [without(t.as_py(), set(d.as_py() or ()), min_chars) for t, d in zip(texts, drops, strict=True)]
        cols = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())]
        return pa.StructArray.from_arrays(cols, ["text", "n", "d"])

    done = joined.withColumn(out, kept(F.col(text_col).cast("binary"), F.col(drop)))
    others = [F.col(f"{out}.text").cast("string").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return done.select(*others, F.col(f"{out}.n").alias(lines_col), F.col(f"{out}.d").alias(dropped_col))


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines, how many are common, and the digest of what is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_common_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = """
WITH l AS (
  SELECT rowid AS r, doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos
  FROM (SELECT row_number() OVER () AS rowid, doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM c)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (key NOT IN (SELECT key FROM c)), '')) AS kept_sha256
FROM k GROUP BY r, doc_id
"""
