"""Polite fetching of pages: limits for each host, while other hosts go on.

Addresses are dealt by host, so that one task keeps a host's limits and nothing has to be agreed on
between tasks. Each host has a token bucket and an adaptive delay: the delay follows the time that the
host takes to answer, never goes below the configured one, and is not lowered by answers that are
errors. A task has a bounded number of requests open over all its hosts, and one host a bounded number
of those. A host's rules for robots are read first and obeyed.

A host of many addresses is its own limit: its rate is the same wherever it is kept. Beyond HOST_ROWS
addresses its rows are dealt to several tasks, each with that part of the host's rate, so that no
task has an unbounded share of the rows and a lost task loses little.

Rows are streamed: a task holds one batch of addresses and the bodies of the pages it has just read,
each at most ``max_bytes`` long. A fetch that fails gives a row without a body and with its error.
"""

from __future__ import annotations

import http.client
import threading
import time
import urllib.error
import urllib.request
import urllib.robotparser
from collections import defaultdict, deque
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGENT = "gleanworks"
PAGES = "request_url string, url string, status int, content_type string, html string, error string"
HOST_ROWS = 10_000
#: Answers that are asked for again.
RETRIED = frozenset({408, 429, 500, 502, 503, 504, 522, 524})


@dataclass(frozen=True)
class Limits:
    """Limits of a fetch: seconds between a host's requests at least and at most, how many of a host are open at
    once on average, requests in a burst, open requests of a task and of a host, tries, seconds, bytes of a body."""

    delay: float = 0.75
    max_delay: float = 30.0
    target: float = 3.0
    burst: int = 1
    concurrency: int = 8
    per_host: int = 4
    tries: int = 4
    timeout: float = 30.0
    max_bytes: int = 8 << 20
    robots: bool = True


class Host:
    """The token bucket and the adaptive delay of a host, or of a share of it."""

    def __init__(self, limits: Limits, shares: int, now: Callable[[], float] = time.monotonic) -> None:
        self.limits, self.shares, self.now = limits, shares, now
        self.delay, self.tokens, self.at, self.open = limits.delay, float(limits.burst), now(), 0

    def _fill(self) -> None:
        t = self.now()
        gap = self.delay * self.shares
        self.tokens = min(float(self.limits.burst), self.tokens + (t - self.at) / gap) if gap > 0 else float(self.limits.burst)
        self.at = t

    def ready_in(self) -> float:
        """Seconds until a request may be made; infinite while as many as allowed are open."""
        if self.open >= self.limits.per_host:
            return float("inf")
        self._fill()
        return 0.0 if self.tokens >= 1 - 1e-9 else (1 - self.tokens) * self.delay * self.shares

    def start(self) -> None:
        self._fill()
        self.tokens -= 1
        self.open += 1

    def done(self, seconds: float, ok: bool) -> None:
        """The delay moves half way to what holds ``target`` requests open; an error never lowers it."""
        self._fill()
        self.open -= 1
        wanted = max(self.limits.delay, min(self.limits.max_delay, (self.delay + seconds / self.limits.target) / 2))
        self.delay = wanted if ok else max(self.delay, wanted)


def open_page(address: str, limits: Limits, agent: str = AGENT) -> dict:
    """One page: url after redirects, status, content_type, html; html only of texts."""
    request = urllib.request.Request(address, headers={"User-Agent": agent})
    try:
        answer = urllib.request.urlopen(request, timeout=limits.timeout)  # noqa: S310 - only http addresses get here
    except urllib.error.HTTPError as why:
        answer = why
    with answer:
        kind = answer.headers.get("Content-Type") or ""
        body = answer.read(limits.max_bytes) if any(x in kind.lower() for x in ("html", "xml", "json", "text")) else b""
        charset = answer.headers.get_content_charset() or "utf-8"
        try:
            text = body.decode(charset, "replace")
        except LookupError:
            text = body.decode("utf-8", "replace")
        return {"url": answer.geturl(), "status": answer.status, "content_type": kind, "html": text}


class _Robots:
    """The rules of hosts, read once each in a task; a host without rules, or whose rules can't be read, allows all."""

    def __init__(self, limits: Limits, agent: str) -> None:
        self.limits, self.agent = limits, agent
        self.rules: dict[str, urllib.robotparser.RobotFileParser | None] = {}
        self.locks: dict[str, threading.Lock] = defaultdict(threading.Lock)

    def allows(self, address: str) -> bool:
        root = "{0.scheme}://{0.netloc}".format(urlsplit(address))
        with self.locks[root]:
            if root not in self.rules:
                try:
                    page = open_page(f"{root}/robots.txt", self.limits, self.agent)
                    rules = urllib.robotparser.RobotFileParser()
                    rules.parse(page["html"].splitlines() if page["status"] < 400 else [])
                    self.rules[root] = rules
                except Exception:  # noqa: BLE001 - no rules
                    self.rules[root] = None
        rules = self.rules[root]
        return rules is None or rules.can_fetch(self.agent, address)


def fetch_all(asked: Iterator[tuple[str, str, int]], limits: Limits, agent: str = AGENT, hosts: dict | None = None, robots: _Robots | None = None) -> Iterator[dict]:
    """Pages of (address, key of its host, shares of the host), as they come; each host within its limits."""
    hosts = {} if hosts is None else hosts
    robots = robots or _Robots(limits, agent)
    queues: dict[str, deque] = defaultdict(deque)
    for address, key, shares in asked:
        if key not in hosts:
            hosts[key] = Host(limits, shares)
        queues[key].append((address, 1))

    def one(address: str) -> tuple[dict, float]:
        began = time.monotonic()
        try:
            if limits.robots and not robots.allows(address):
                return {"error": "not allowed for robots"}, 0.0
            got = open_page(address, limits, agent)
            return got, time.monotonic() - began
        except (OSError, ValueError, http.client.HTTPException) as why:
            return {"error": f"{type(why).__name__}: {why}", "again": True}, time.monotonic() - began

    running: dict = {}
    with ThreadPoolExecutor(limits.concurrency) as pool:
        while queues or running:
            pause = 0.5
            for key in [k for k in queues if queues[k]]:
                while queues[key] and len(running) < limits.concurrency:
                    left = hosts[key].ready_in()
                    if left > 0:
                        pause = min(pause, left)
                        break
                    hosts[key].start()
                    address, turn = queues[key].popleft()
                    running[pool.submit(one, address)] = key, address, turn
            if not running:
                time.sleep(max(pause, 0.001))
                continue
            for future in wait(running, timeout=pause, return_when=FIRST_COMPLETED)[0]:
                key, address, turn = running.pop(future)
                got, seconds = future.result()
                bad = got.pop("again", False) or got.get("status") in RETRIED
                hosts[key].done(seconds, not bad and got.get("status", 500) < 400)
                if bad and turn < limits.tries:
                    queues[key].append((address, turn + 1))
                else:
                    yield {"request_url": address} | got
            for key in [k for k in queues if not queues[k]]:
                del queues[key]


def host_of(address: Column) -> Column:
    """The host of an address, in lower case, with its port; null for what is not http(s)."""
    found = F.regexp_extract(F.lower(address), r"^https?://([^/?#]+)", 1)
    return F.when(found != "", F.regexp_replace(found, "^[^@]*@", ""))


def fetch(asked: DataFrame, limits: Limits | None = None, agent: str = AGENT, url_col: str = "url", host_rows: int = HOST_ROWS, tasks: int | None = None) -> DataFrame:
    """``request_url, url, status, content_type, html, error`` for each distinct http(s) address of ``asked``.

    Addresses of other kinds and null ones give no row. ``url`` is where redirects led. Without an answer status
    is null; answers of every status have a row, so that callers decide what they take for a page.
    """
    limits = limits or Limits()
    spark = asked.sparkSession
    one = asked.select(F.trim(F.col(url_col)).alias("address")).withColumn("host", host_of(F.col("address"))).where(F.col("host").isNotNull()).distinct()
    sizes = one.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / host_rows).cast("int").alias("shares"))
    dealt = one.join(sizes, "host").withColumn("key", F.concat_ws("#", "host", F.pmod(F.xxhash64("address"), F.col("shares"))))
    parts = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts, robots = {}, _Robots(limits, agent)
        names = [f.split()[0] for f in PAGES.split(", ")]
        for batch in batches:
            rows: list[dict] = []
            size = 0
            for page in fetch_all(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True), limits, agent, hosts, robots):
                rows.append(page)
                size += len(page.get("html") or "")
                if size >= limits.max_bytes:
                    yield _batch(rows, names)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, names)

    # Within a task hosts are mixed, so that one which must wait leaves the others to go on.
    spread = dealt.select("address", "key", "shares").repartition(parts, "key").sortWithinPartitions(F.xxhash64("address"))
    return spread.mapInArrow(run, PAGES)


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32() if n == "status" else pa.string() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)


def statuses(asked: DataFrame, limits: Limits | None = None, url_col: str = "url") -> DataFrame:
    """``url, status`` of each distinct address, null without an answer: what a check of links needs."""
    return fetch(asked, limits, url_col=url_col).select(F.col("request_url").alias("url"), "status")


def page_reader(limits: Limits | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """A reader of live pages for ``plans.crawl.crawl``; pages of an error status have no body."""

    def read(asked: DataFrame, kind: str) -> DataFrame:
        got = fetch(asked, limits)
        body = F.when(F.coalesce("status", F.lit(500)) < 400, F.col("html"))
        return got.select("request_url", F.coalesce("url", "request_url").alias("url"), F.lit(kind).alias("kind"), "status", "content_type", body.alias("html"), F.lit(None).cast("string").alias("state_code"))

    return read
