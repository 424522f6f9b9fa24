"""Structured Streaming: incremental upserts, emit-once and windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanworks.operators.dedup import best, place
from gleanworks.operators.sinks import free, upsert_table


def stream_upsert(items: DataFrame, path: str, checkpoint: str, keys: list[str], seq: str) -> StreamingQuery:
    """Apply a stream's rows to the table at ``path``; ``seq``, not arrival, decides what is latest.

    A batch that is replayed after a failure changes nothing, rows without a key included, since the
    table keeps the number of the last batch of a checkpoint. A batch rewrites only the buckets of its
    keys. Read the table with ``sinks.read_table``.
    """
    put = lambda batch, number: upsert_table(batch, path, keys, seq, (checkpoint, number))
    return items.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def emit_once(items: DataFrame, key: str) -> DataFrame:
    """The first row of each key to arrive; rows without one are dropped. State grows with the number of keys; see ``stream_first``."""
    return items.where(F.col(key).isNotNull()).dropDuplicates([key])


def improving(items: DataFrame, keys: list[str], seq: str, lifetime_s: float = 3600.0) -> DataFrame:
    """The rows of a stream that come before what was seen of their key, in order of ``seq``; for a sink in update mode.

    A streaming aggregate holds the first row of each key and passes it on only in the batch that brought
    it; rows are reduced to one for each key before the shuffle, so a hot key is no hot task. Keys are held
    by windows of ``lifetime_s``, whose state goes when they are over, so it is bounded by the keys of that
    time; a key that comes later passes again, which a sink that compares ``seq`` itself sets right. Rows
    with a null key are dropped; a row without a ``seq`` is behind any that has one.

    A row's time is that of the batch that reads it, so none is ever late; the watermark follows the batches.
    """
    seen, last, row = (free(name, items.columns) for name in ("seen_", "last_", "row_"))
    timed = items.dropna(subset=keys).withColumn(seen, F.current_timestamp()).withWatermark(seen, "0 seconds")
    span = F.window(seen, f"{max(1, int(lifetime_s * 1000))} milliseconds")
    # The hash that tells rows apart is of the items' own columns, as in the table.
    arrived = F.struct(best(items, F.col(seq), last=False).alias("item"), F.min_by(F.col(seen), place(items, F.col(seq), last=False)).alias("at"))
    held = timed.groupBy(span, *[F.col(k).alias(f"key_{i}_") for i, k in enumerate(keys)]).agg(arrived.alias(row), F.max(seen).alias(last))
    return held.where(F.col(row)["at"] == F.col(last)).select(F.col(row)["item"].alias(row)).select(f"{row}.*")


def stream_first(items: DataFrame, path: str, checkpoint: str, keys: list[str], seq: str, lifetime_s: float = 3600.0) -> StreamingQuery:
    """Keep the first row of each key by ``seq``, whatever order rows arrive in, in the table at ``path``.

    Rows that can't be first are left out by ``improving`` before they reach the table, which has the last word.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.persist()  # the upsert reads it twice, and each time would take the state's step again
        try:
            upsert_table(batch, path, keys, seq, (checkpoint, number), first=True)
        finally:
            batch.unpersist()

    return improving(items, keys, seq, lifetime_s).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their values by window and type; an extension beyond the record store's own needs."""
    rows = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
