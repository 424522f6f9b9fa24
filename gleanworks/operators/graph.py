"""Expansion of a frontier over an edge table to its fix-point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanworks.operators.frontier import BLOOM_FROM, SOURCES, Store, expand_rounds
from gleanworks.storage import fresh

__all__ = ["SOURCES", "expand"]
#: So few frontier nodes are named in the filter of the edge scan.
FEW = 256


def expand(seeds: DataFrame, edges: DataFrame, scope: Column | None = None, max_rounds: int | None = None, store: str | None = None, signature: str = "", stop_after: int | None = None, bloom_from: int = BLOOM_FROM) -> DataFrame:
    """``id, depth, via`` of everything reachable from ``seeds`` (id, via) over ``edges`` (src, dst, via).

    Seeds need not be in ``scope``, a condition on ``dst``; what edges lead to must. Edges are computed
    once and written, sorted by their source in each file, so a small frontier reads few of their row
    groups. Each round joins only the new frontier and leaves out what was visited. Of several ways to
    a page the least depth wins, then directory before nearby before opponent, then the label. Rounds
    go on until nothing new is reached; more than ``max_rounds``, if given, are an error.

    Rounds are kept in ``store``, a folder, and a call with the same store and ``signature`` goes on
    after its last round (``stop_after`` ends a call early); without one they are in the shared folder.
    """
    spark = seeds.sparkSession
    rounds = Store(spark, store or fresh(spark, "frontier"), signature)

    def steps() -> DataFrame:
        held = edges.where(F.col("dst").isNotNull()) if scope is None else edges.where(F.col("dst").isNotNull() & scope)
        return held.select("src", "dst", "via").distinct().sortWithinPartitions("src")

    table = rounds.keep("edges", steps)

    def visit(frontier: DataFrame, k: int) -> DataFrame:
        some = [r["id"] for r in frontier.select("id").limit(FEW + 1).collect()]
        held = table.where(F.col("src").isin(some)) if len(some) <= FEW else table
        return frontier.select(F.col("id").alias("src")).join(held, "src").select(F.col("dst").alias("id"), "via")

    return expand_rounds(rounds, lambda: seeds.select("id", "via"), visit, max_rounds, stop_after, bloom_from)[0]
