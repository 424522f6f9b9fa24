"""Catalog connectors: Python data sources over paged JSON services.

``spark.read.format("ticket_catalog")`` reads numbered pages, ``spark.read.format("network_catalog")``
offset pages of slices (all, and one for each state). Call ``register(spark)`` first. Addresses are
templates: https:// for a service, or file:// and the like for recorded pages.
Every page is asked for with retries in the task that needs it, so a page that fails for a moment costs
that page again and not the scan.

A partition is a slice (network) or every nth page (tickets). Filters on ``step``, ``slice_no`` and
``state_code`` reach the network reader, which then plans only the slices that can hold such rows:
Spark hands them over where ``spark.sql.python.filterPushdown.enabled`` is set, as ``register`` does.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from gleanworks.operators.dedup import merge_slices
from gleanworks.operators.sinks import append_table, has_table, read_table, write_table
from gleanworks.sources.catalog import FULL, NETWORK, OFFSET_CAP, PAGE_SIZE, capped, linear, missing, offset_pages, slices, with_retries
from gleanworks.storage import remove

TICKETS = "pos long, id string, name string, state string"
SLICES = f"slice_no int, step string, at long, {NETWORK}"
#: A place in the order of numbered pages: page, then item.
_PAGE_SHIFT = 32


def get_json(address: str, timeout: float = 30.0) -> dict:
    """The JSON document at ``address``: http(s), or a recorded one on any file system that Arrow knows.

    A recorded document may be a folder with parts, as Spark writes them. What is not there is an error, as are bad bodies.
    """
    if address.startswith(("http://", "https://")):
        request = urllib.request.Request(address, headers={"Accept": "application/json", "User-Agent": "gleanworks"})
        with urllib.request.urlopen(request, timeout=timeout) as answer:  # noqa: S310 - http only
            return json.loads(answer.read().decode())
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(address)
    parts = [path]
    if system.get_file_info(path).type == fs.FileType.Directory:
        found = system.get_file_info(fs.FileSelector(path))
        parts = sorted(f.path for f in found if not f.base_name.startswith(("_", ".")))
    return json.loads(b"".join(system.open_input_stream(x).read() for x in parts).decode())


def _text(x: object) -> str | None:
    return None if x is None else str(x)


@dataclass
class Page(InputPartition):
    """Numbered pages ``first``, ``first + step``, ..."""

    first: int
    step: int


@dataclass
class Slice(InputPartition):
    number: int
    step: str


class _Source(DataSource):
    """Options: address (a template), pause (seconds between pages), tries, wait (a factor of the waits between tries), timeout."""

    tries = 4

    def address(self) -> str:
        if "address" not in self.options:
            raise ValueError("the option address, a template, is needed")
        return self.options["address"]

    def number(self, name: str, default: float) -> float:
        return float(self.options.get(name, default))


class TicketCatalog(_Source):
    """Rows of all numbered pages; {page} and {size} in the address. ``readers``: tasks that read every nth page.

    ``pos`` is the order of the items: the page in the upper bits, the place in it in the lower ones. A reader ends
    with the first page that says it is the last or is empty; with several readers, pages behind the last
    one are asked for and must be empty.
    """

    @classmethod
    def name(cls) -> str:
        return "ticket_catalog"

    def schema(self) -> str:
        return TICKETS

    def reader(self, schema) -> DataSourceReader:
        return _TicketReader(self.address(), int(self.number("size", PAGE_SIZE)), int(self.number("readers", 1)), self.number("pause", 0.4), int(self.number("tries", 4)), self.number("wait", 1.0), self.number("timeout", 30))


class _TicketReader(DataSourceReader):
    def __init__(self, address: str, size: int, readers: int, pause: float, tries: int, wait: float, timeout: float) -> None:
        self.address, self.size, self.readers, self.pause, self.tries, self.wait, self.timeout = address, size, readers, pause, tries, wait, timeout

    def partitions(self) -> list[Page]:
        return [Page(k, self.readers) for k in range(self.readers)]

    def read(self, partition: Page) -> Iterator[tuple]:
        get = with_retries(get_json, self.tries, lambda i: self.wait * linear(i))
        page = partition.first
        while True:
            got = get(self.address.format(page=page, size=self.size), self.timeout)
            items = got.get("content") or []
            for k, i in enumerate(items):
                yield (page << _PAGE_SHIFT) + k, _text(i.get("huddleId")), _text(i.get("name")), _text(i.get("state"))
            if got.get("last") or not items:
                return
            page += partition.step
            time.sleep(self.pause)


class NetworkCatalog(_Source):
    """Rows of slices; {state} (empty for the slice of all), {start} and {size} in the address.

    ``steps``: slices, joined by commas (all of them, if not given). ``failures``: ``raise``, or ``skip`` a slice that
    fails after its retries. A slice that was read to its end has one more row, of ``at`` -1 and no values;
    rows of one that was not are not given. A slice's items, OFFSET_CAP at most, are held by its task.
    """

    @classmethod
    def name(cls) -> str:
        return "network_catalog"

    def schema(self) -> str:
        return SLICES

    def reader(self, schema) -> DataSourceReader:
        failures = self.options.get("failures", "raise")
        if failures not in ("raise", "skip"):
            raise ValueError(f"failures must be raise or skip, not {failures}")
        steps = [s for s in self.options.get("steps", "").split(",") if s] or slices()
        return _NetworkReader(self.address(), steps, failures, self.number("pause", 1.0), int(self.number("tries", 8)), self.number("wait", 1.0), self.number("timeout", 30))


class _NetworkReader(DataSourceReader):
    def __init__(self, address: str, steps: list[str], failures: str, pause: float, tries: int, wait: float, timeout: float) -> None:
        self.address, self.failures, self.pause, self.tries, self.wait, self.timeout = address, failures, pause, tries, wait, timeout
        self.chosen = [Slice(k, s) for k, s in enumerate(steps)]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Slices that no row of the filters can be in are not planned; Spark evaluates every filter on the rows again.

        A state's rows are in its own slice and in that of all. A slice's end row has no state, so it goes with a filter on states.
        """
        for f in filters:
            if isinstance(f, EqualTo):
                values = {f.value}
            elif isinstance(f, In):
                values = set(f.value)
            else:
                values = None
            if values is not None and f.attribute == ("step",):
                self.chosen = [s for s in self.chosen if s.step in values]
            elif values is not None and f.attribute == ("slice_no",):
                self.chosen = [s for s in self.chosen if s.number in values]
            elif values is not None and f.attribute == ("state_code",):
                self.chosen = [s for s in self.chosen if s.step == FULL or s.step in values]
            yield f

    def partitions(self) -> list[Slice]:
        return self.chosen or [Slice(-1, "")]

    def read(self, partition: Slice) -> Iterator[tuple]:
        if partition.number < 0:
            return
        whole = partition.step == FULL
        get = with_retries(lambda params, start, size: get_json(self.address.format(state=params.get("state", ""), start=start, size=size), self.timeout), self.tries, lambda i: self.wait * capped(i))
        try:
            items = list(offset_pages(get, {} if whole else {"state": partition.step}, OFFSET_CAP if whole else None, pause=self.pause))
        except Exception:
            if self.failures == "skip":
                return
            raise
        head = partition.number, partition.step
        yield *head, -1, None, None, None, None, None
        for k, i in enumerate(items):
            yield *head, k, *map(_text, i.values())


def register(spark: SparkSession) -> None:
    """Make the sources known to the session and let filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (TicketCatalog, NetworkCatalog):
        spark.dataSource.register(source)


def network_catalog(spark: SparkSession, address: str, store: str, steps: list[str] | None = None, refresh: bool = False, wave: int = 8, **options: object) -> tuple[DataFrame, bool]:
    """(catalog with ``pos``, complete): the slices of ``address``, cached in ``store`` and resumable.

    ``wave`` open slices are read at a time, each by a task, and kept before the next ones. A slice that
    fails is left open and read again by the next call. Once none is open the catalog, one row for each
    slug (last in a slice, first of the slices), is in ``store``/catalog and nothing is read any more.
    """
    register(spark)
    cat, progress = f"{store}/catalog", f"{store}/progress"
    if not refresh and has_table(spark, cat):
        return read_table(spark, cat), True
    if refresh:
        remove(spark, progress)
    steps = steps or slices()
    open_ = missing(spark, store, steps)
    for k in range(0, len(open_), wave):
        source = spark.read.format("network_catalog").options(address=address, steps=",".join(steps), failures="skip", **options).load()
        append_table(source.where(F.col("step").isin(open_[k : k + wave])), progress)
    held = read_table(spark, progress) if has_table(spark, progress) else spark.createDataFrame([], SLICES)
    merged = merge_slices(held.where(F.col("at") >= 0), "slug", "slice_no", "at")
    merged = merged.select("slug", "name", "city", "state_code", "gofan_id", (F.col("slice_no").cast("long") * (1 << 40) + F.col("at")).alias("pos"))
    if missing(spark, store, steps):
        return merged, False
    write_table(merged, cat)
    remove(spark, progress)
    return read_table(spark, cat), True


def ticket_catalog(spark: SparkSession, address: str, store: str, refresh: bool = False, **options: object) -> DataFrame:
    """``id, name, state, pos``: the numbered pages of ``address``, cached in ``store``."""
    register(spark)
    if refresh or not has_table(spark, store):
        write_table(spark.read.format("ticket_catalog").options(address=address, **options).load(), store)
    return read_table(spark, store)


def details_at(address: str, tries: int = 4, wait: float = 1.0, timeout: float = 30.0) -> Callable[[str], dict]:
    """A lookup for ``catalog.lookup_details``: the document at ``address`` with {id} filled in."""

    def get(i: str) -> dict:
        return with_retries(get_json, tries, lambda k: wait * linear(k))(address.format(id=urllib.request.quote(i, safe="")), timeout)

    return get


__all__ = ["NetworkCatalog", "TicketCatalog", "details_at", "get_json", "network_catalog", "register", "ticket_catalog"]
