"""First-wins, last-wins and slice-merging deduplication; order is always an explicit column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _whole(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def place(df: DataFrame, order: Column, last: bool) -> Column:
    """What rows of ``df`` are compared by.

    Rows without an order come behind all that have one: they are the earliest where the last wins
    and the latest where the first wins. Rows equal in order are told apart by a hash of the row,
    so that a rerun picks the same one.
    """
    hashed = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return F.struct((order.isNotNull() if last else order.isNull()).alias("known"), order.alias("order"), F.xxhash64(*hashed).alias("tie"))


def best(df: DataFrame, order: Column, last: bool) -> Column:
    """The whole row of ``df`` that is first in ``order`` (or last), as a partial aggregate, also in streams."""
    return (F.max_by if last else F.min_by)(_whole(df), place(df, order, last))


def _pick(df: DataFrame, keys: list[str], order: Column, last: bool) -> DataFrame:
    """One row for each key by a partial aggregate, so that a hot key is reduced before the shuffle."""
    return df.groupBy(*[F.col(k).alias(f"key_{i}_") for i, k in enumerate(keys)]).agg(best(df, order, last).alias("row_")).select("row_.*")


def first_wins(df: DataFrame, keys: list[str], order: Column, keep_null_keys: bool = False) -> DataFrame:
    """The earliest row for each key; rows with a null key are dropped, or all kept. A row without an order loses to any with one."""
    return _split_nulls(df, keys, lambda d: _pick(d, keys, order, last=False), keep_null_keys)


def last_wins(df: DataFrame, keys: list[str], order: Column, keep_null_keys: bool = True) -> DataFrame:
    """The latest row for each key: a whole-row upsert. Rows with a null key never collapse; a row without an order loses to any with one."""
    return _split_nulls(df, keys, lambda d: _pick(d, keys, order, last=True), keep_null_keys)


def _split_nulls(df: DataFrame, keys: list[str], pick, keep: bool) -> DataFrame:
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    picked = pick(df.where(~null))
    return picked.unionByName(df.where(null)) if keep else picked


def merge_slices(df: DataFrame, key: str, slice_no: str, order: str) -> DataFrame:
    """In a slice the last row of a key wins, over slices the first slice; blank keys are dropped."""
    at = F.struct(-F.col(slice_no).cast("long"), F.col(order))
    held = df.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    return _pick(held, [key], at, last=True)


def changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` that ``old`` lacks, with multiplicity."""
    return new.exceptAll(old)


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not among those of ``seen``; a null key never is."""
    return rows.join(seen.select(key), key, "left_anti")
