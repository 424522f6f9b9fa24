"""A durable frontier: expansion in rounds that are committed one by one and can be taken up again.

The store of an expansion is a folder. Each round's new nodes are a Parquet folder, which a small
numbered file makes part of the store once it is whole; only one writer can make that file, so a
round is there or it is not, and two runs on one store are told. What a round looks up on the way, such
as the pages of its nodes, is kept in the same manner by name, so that a run that broke in the middle of
a round does not look it up again. A run that finds a store goes on with the round after the last.

What a round reaches is compared with all that was visited. Beyond ``bloom_from`` visited nodes a
Bloom filter of the reached nodes, sized by their count, is sent to the scan of the visited ones
first; nearly all of them are left out there, and only the rest is shuffled for the exact anti-join.
Reached nodes too many for a filter of MAX_BLOOM_BITS go to the anti-join at once.
"""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.operators.dedup import unseen
from gleanworks.storage import names_in, read_text, remove, write_text

#: Sources of a page in order of preference at equal depth.
SOURCES = ("directory", "nearby", "opponent")
BLOOM_FROM = 1_000_000
BITS_PER_NODE = 12
HASHES = 6
MAX_BLOOM_BITS = 1 << 26


class Bloom:
    """A Bloom filter of a column's values, built by Spark; the driver holds its bits, at most MAX_BLOOM_BITS."""

    def __init__(self, ids: DataFrame, column: str, n: int) -> None:
        self.bits = 1 << max(10, (BITS_PER_NODE * max(1, n) - 1).bit_length())
        a, b = self._hashes(column)
        at = F.explode(F.array(*[F.pmod(a + b * k, F.lit(self.bits)) for k in range(HASHES)])).alias("at")
        words = ids.select(at).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        held = words.toArrow()
        self.words = np.zeros(self.bits // 64, np.int64)
        self.words[held["word"].to_numpy()] = held["bits"].to_numpy()

    @staticmethod
    def _hashes(column: str) -> tuple[Column, Column]:
        """Two hashes of 32 bits, so that their multiples stay in a long."""
        h = F.xxhash64(column)
        return F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0x7FFFFFFF))

    def may_hold(self, column: str) -> Column:
        """False only for values that are not in the filter."""
        words, bits = self.words, self.bits

        @F.arrow_udf("boolean")
        def run(a: pa.Array, b: pa.Array) -> pa.Array:
            x, y = a.to_numpy(zero_copy_only=False), b.to_numpy(zero_copy_only=False)
            found = np.ones(len(x), bool)
            for k in range(HASHES):
                at = (x + y * k) % bits
                found &= (words[at >> 6] >> (at & 63) & 1).astype(bool)
            return pa.array(found)

        return run(*self._hashes(column))


class Store:
    """Rounds and what they have looked up, in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, signature: str = "") -> None:
        self.spark, self.path = spark, path.rstrip("/")
        if not write_text(spark, f"{self.path}/about.json", [json.dumps({"signature": signature})], overwrite=False):
            held = json.loads(read_text(spark, f"{self.path}/about.json"))["signature"]
            if held != signature:
                raise ValueError(f"the store at {path} belongs to another expansion: {held!r}, not {signature!r}")

    def _note(self, name: str) -> dict | None:
        return json.loads(read_text(self.spark, f"{self.path}/{name}.json")) if f"{name.rpartition('/')[2]}.json" in names_in(self.spark, f"{self.path}/{name.rpartition('/')[0]}") else None

    def _put(self, name: str, df: DataFrame) -> dict:
        """Write rows, then make them known under ``name``."""
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        note = {"folder": folder, "rows": self.spark.read.parquet(f"{self.path}/{folder}").count(), "schema": df.schema.jsonValue()}
        if not write_text(self.spark, f"{self.path}/{name}.json", [json.dumps(note)], overwrite=False):
            remove(self.spark, f"{self.path}/{folder}")
            raise RuntimeError(f"another run has written {name} of the store at {self.path}")
        return note

    def _frame(self, notes: list[dict]) -> DataFrame:
        from pyspark.sql.types import StructType

        return self.spark.read.schema(StructType.fromJson(notes[0]["schema"])).parquet(*[f"{self.path}/{n['folder']}" for n in notes])

    def keep(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """What was kept under ``name``; made and written now, if nothing was."""
        note = self._note(f"kept/{name}") or self._put(f"kept/{name}", make())
        return self._frame([note])

    def kept(self, prefix: str) -> DataFrame | None:
        """All that was kept under names that start with ``prefix``; None if nothing was."""
        notes = [self._note(f"kept/{n.removesuffix('.json')}") for n in names_in(self.spark, f"{self.path}/kept") if n.startswith(prefix) and n.endswith(".json")]
        return self._frame(notes) if notes else None

    def rounds(self) -> list[dict]:
        """Notes of the committed rounds in their order."""
        names = {n for n in names_in(self.spark, f"{self.path}/rounds") if n.endswith(".json")}
        count = next(k for k in itertools.count() if f"{k:06d}.json" not in names)
        return [self._note(f"rounds/{k:06d}") for k in range(count)]

    def commit(self, k: int, nodes: DataFrame) -> dict:
        return self._put(f"rounds/{k:06d}", nodes)

    def nodes(self, rounds: list[dict]) -> DataFrame:
        return self._frame(rounds)


def _best(df: DataFrame, depth: int) -> DataFrame:
    """One row for each node: of several ways directory before nearby before opponent, then the label."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.substring_index(F.col("via"), ":", 1)), F.lit(9))
    picked = df.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(F.struct(rank.alias("r"), "via")).alias("b"))
    return picked.select("id", F.lit(depth).alias("depth"), F.col("b.via").alias("via"))


def _new(store: Store, reached: DataFrame, visited: DataFrame, n_visited: int, k: int, bloom_from: int) -> DataFrame:
    """The reached nodes that are not among the visited ones."""
    if n_visited < bloom_from:
        return unseen(reached, visited, "id")
    reached = store.keep(f"reached-{k:06d}", lambda: reached)
    n = reached.count()
    if n * BITS_PER_NODE <= MAX_BLOOM_BITS:
        visited = visited.where(Bloom(reached, "id", n).may_hold("id"))
    return unseen(reached, visited, "id")


def expand_rounds(
    store: Store, seeds: Callable[[], DataFrame], visit: Callable[[DataFrame, int], DataFrame], max_rounds: int | None = None, stop_after: int | None = None, bloom_from: int = BLOOM_FROM
) -> tuple[DataFrame, bool]:
    """(``id, depth, via`` of all that was reached, whether that is everything).

    ``seeds`` gives id and via, ``visit`` what a frontier leads to (id, via), scoped already. Rounds go on
    until nothing new is reached, or stop after ``stop_after`` rounds of this call, to be taken up by
    the next call on the store. More than ``max_rounds`` rounds in all are an error.
    """
    rounds = store.rounds()
    if not rounds:
        rounds = [store.commit(0, _best(seeds(), 0))]
    here = 0
    while rounds[-1]["rows"]:
        if stop_after is not None and here >= stop_after:
            return store.nodes(rounds), False
        k = len(rounds)
        reached = _best(visit(store.nodes(rounds[-1:]), k - 1), k)
        made = store.commit(k, _new(store, reached, store.nodes(rounds), sum(r["rows"] for r in rounds), k, bloom_from))
        if made["rows"] and max_rounds is not None and k > max_rounds:
            raise RuntimeError(f"something is reached only after more than {max_rounds} rounds")
        rounds.append(made)
        here += 1
    return store.nodes(rounds), True
