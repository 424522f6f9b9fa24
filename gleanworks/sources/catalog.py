"""Paged catalog sources: a reader interface, retries, slices, checkpoints and cache.

A reader takes (parameters, offset or page) and returns a page. The network is behind it; tests use
local pages. Slices are rows, read by executors.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.operators.dedup import merge_slices, unseen
from gleanworks.operators.sinks import append_table, has_table, read_table, write_table
from gleanworks.storage import ensure_checkpoints, remove
from gleanworks.sources.tables import STATES

# Page sizes and limits of the two catalogs.
PAGE_SIZE, OFFSET_SIZE, OFFSET_CAP = 2000, 500, 10_000
NETWORK = "slug string, name string, city string, state_code string, gofan_id string"
FULL = "__full__"


def with_retries(get: Callable, tries: int, wait: Callable[[int], float], sleep: Callable = time.sleep) -> Callable:
    """``get`` tried again after ``wait(i)`` seconds; the last error is raised."""

    def run(*args, **kwargs):
        for i in range(tries):
            try:
                return get(*args, **kwargs)
            except Exception:
                if i == tries - 1:
                    raise
                sleep(wait(i))

    return run


def linear(i: int) -> float:
    return 1.5 * (i + 1)


def capped(i: int) -> float:
    return min(8.0 * (i + 1), 45.0)


def numbered_pages(get: Callable[[int, int], dict], size: int = PAGE_SIZE, pause: float = 0.0) -> Iterator[dict]:
    """Items of pages 0, 1, ... until one says it is the last or is empty."""
    page = 0
    while True:
        got = get(page, size)
        items = got.get("content") or []
        yield from items
        if got.get("last") or not items:
            return
        page += 1
        time.sleep(pause)


def offset_pages(get: Callable[[dict, int, int], dict], params: dict, stop_at: int | None = None, size: int = OFFSET_SIZE, pause: float = 0.0) -> Iterator[dict]:
    """Items with a slug by offset, until empty, the known total (or ``stop_at``) or the cap is reached."""
    start = 0
    while True:
        got = get(params, start, size)
        items, total = got.get("items") or [], got.get("total")
        for i in items:
            if i.get("slug"):
                yield {k: i.get(k) for k in ("slug", "name", "city", "state_code", "gofan_id")}
        start += len(items)
        limit = total if stop_at is None else min(total or 0, stop_at)
        if not items or (total is not None and start >= limit) or start + size > OFFSET_CAP:
            return
        time.sleep(pause)


def slices() -> list[str]:
    return [FULL, *(c.upper() for c in STATES)]


def build_sliced(spark: SparkSession, get: Callable[[dict, int, int], dict], path: str, steps: list[str] | None = None, refresh: bool = False, wave: int = 8) -> tuple[DataFrame, bool]:
    """(catalog with ``pos``, complete): a cached, resumable build over slices.

    Each open slice is one row and is read by one task; ``wave`` slices are read at a time and kept
    in ``path``/progress before the next ones, so that a lost driver loses one wave. A slice that
    fails is read again by the next call. The whole catalog, one row for each slug (last in a slice,
    first of the slices), is in ``path``/catalog.
    """
    cat, progress = f"{path}/catalog", f"{path}/progress"
    if not refresh and has_table(spark, cat):
        return read_table(spark, cat), True
    if refresh:
        remove(spark, progress)
    steps = steps or slices()
    fields = f"slice_no int, step string, at long, {NETWORK}"
    open_ = missing(spark, path, steps)
    todo = [(k, s) for k, s in enumerate(steps) if s in open_]

    def read(batches):
        import pandas as pd

        names = [f.split()[0] for f in fields.split(", ")]
        for batch in batches:
            for no, step in zip(batch["slice_no"], batch["step"], strict=True):
                try:
                    params, stop = ({}, OFFSET_CAP) if step == FULL else ({"state": step}, None)
                    items = list(offset_pages(get, params, stop))
                except Exception:  # noqa: BLE001 - this slice is read again by the next call
                    continue
                rows = [(no, step, -1, None, None, None, None, None)] + [(no, step, k, *[None if v is None else str(v) for v in i.values()]) for k, i in enumerate(items)]
                yield pd.DataFrame(rows, columns=names)

    for k in range(0, len(todo), wave):
        some = spark.createDataFrame(todo[k : k + wave], "slice_no int, step string").repartition(wave, "step")
        append_table(some.mapInPandas(read, fields), progress)
    held = read_table(spark, progress) if has_table(spark, progress) else spark.createDataFrame([], fields)
    merged = merge_slices(held.where(F.col("at") >= 0), "slug", "slice_no", "at")
    merged = merged.select("slug", "name", "city", "state_code", "gofan_id", (F.col("slice_no").cast("long") * (1 << 40) + F.col("at")).alias("pos"))
    if not missing(spark, path, steps):
        write_table(merged, cat)
        remove(spark, progress)
        return read_table(spark, cat), True
    return merged, False


DETAIL = "id string, city string, zip_code string"


def lookup_details(ids: DataFrame, get: Callable[[str], dict], path: str, pause: float = 0.0) -> DataFrame:
    """``id, city, zip_code`` for each distinct ``id``: a point lookup, remembered in the table at ``path``.

    ``get`` takes an id and gives a dictionary with city and zipCode. Each id is asked for once over
    all calls. A lookup that fails counts as one without a place, which bears out any row; it is not
    remembered, so that the next call asks again.
    """
    spark = ids.sparkSession
    known = read_table(spark, path) if has_table(spark, path) else spark.createDataFrame([], DETAIL)
    wanted = ids.select(F.col("id").cast("string").alias("id")).where("id is not null").distinct()

    def read(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for i in batch["id"]:
                try:
                    d = get(i) or {}
                    rows.append((i, None if d.get("city") is None else str(d["city"]), None if d.get("zipCode") is None else str(d["zipCode"]), True))
                except Exception:  # noqa: BLE001 - an unknown place
                    rows.append((i, None, None, False))
                time.sleep(pause)
            yield pd.DataFrame(rows, columns=["id", "city", "zip_code", "ok"])

    ensure_checkpoints(spark)
    asked = unseen(wanted, known, "id").mapInPandas(read, f"{DETAIL}, ok boolean").checkpoint()  # asked once
    append_table(asked.where("ok").drop("ok"), path)
    found = known.join(wanted, "id", "left_semi").unionByName(asked.drop("ok"))
    return found


def download_tickets(spark: SparkSession, get: Callable[[int, int], dict], path: str, refresh: bool = False, pause: float = 0.0) -> DataFrame:
    """``id, name, state, pos``: the numbered pages of the ticket catalog, cached at ``path``.

    Pages depend on the one before, so one task reads them; the rows stay with the executors.
    """
    if refresh or not has_table(spark, path):

        def read(batches):
            import pandas as pd

            for _ in batches:
                rows = [(k, *[None if i.get(c) is None else str(i[c]) for c in ("huddleId", "name", "state")]) for k, i in enumerate(numbered_pages(get, pause=pause))]
                yield pd.DataFrame(rows, columns=["pos", "id", "name", "state"])

        write_table(spark.range(1, numPartitions=1).mapInPandas(read, "pos long, id string, name string, state string"), path)
    return read_table(spark, path)


def missing(spark: SparkSession, path: str, steps: list[str] | None = None) -> list[str]:
    """Slices that are still open, sorted."""
    progress = f"{path}/progress"
    done = {r["step"] for r in read_table(spark, progress).select("step").distinct().collect()} if has_table(spark, progress) else set()  # a row for each slice
    return sorted(set(steps or slices()) - done)
