"""Running counts of a stream by kind, and a last step that never fails it."""

from __future__ import annotations

import logging
import threading
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_LOG = logging.getLogger(__name__)


def counted(items: DataFrame, name: str, kind: str, kinds: list[str]) -> DataFrame:
    """``items`` with its rows of each kind counted as they pass, under ``name``; kinds not listed count as ``other``.

    Counts are observed metrics: each task's count is taken once, when the task has succeeded, so a
    task that is tried again does not count twice.
    """
    each = [F.count_if(F.col(kind) == k).alias(k) for k in kinds]
    return items.observe(name, *each, F.count_if(~F.coalesce(F.col(kind).isin(kinds), F.lit(False))).alias("other"))


class Counters(StreamingQueryListener):
    """Sums of what ``counted`` has observed, by name; a batch that is run again after a failure counts once."""

    def __init__(self) -> None:
        self.totals: dict[str, Counter] = {}
        self.batches: dict[tuple[str, str], int] = {}
        self.ended: set[str] = set()
        self.change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self.change:
            for name, row in (p.observedMetrics or {}).items():
                if self.batches.get((str(p.id), name), -1) < p.batchId:
                    self.batches[str(p.id), name] = p.batchId
                    self.totals.setdefault(name, Counter()).update(row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.change:
            self.ended.add(str(event.runId))
            self.change.notify_all()

    def of(self, name: str) -> dict[str, int]:
        with self.change:
            return dict(self.totals.get(name, {}))

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until all that was said of an ended query has arrived here."""
        with self.change:
            self.change.wait_for(lambda: str(query.runId) in self.ended, seconds)


def finish(query: StreamingQuery, export: Callable[[], object], counters: Counters | None = None) -> object:
    """Wait for the query's end, then ``export``; what it returns, or None if it failed, which is logged and not raised.

    A query that failed itself raises, after the export of what it had written.
    """
    try:
        query.awaitTermination()
    finally:
        if counters is not None:
            counters.wait(query)
        try:
            result = export()
        except Exception:  # noqa: BLE001 - the rows are in the table; the export can be made again
            _LOG.exception("the export after the stream failed; run it again")
            result = None
    return result
