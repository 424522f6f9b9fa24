"""The whole collection as one plan: seeds, expansion, schools, games, enrichment, export.

``collect`` takes a source table of pages (url, kind, status, content_type, html, state_code); ``crawl``
asks a reader for pages round by round and can be stopped and taken up. Scope and level are filters
below every join and explode.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.functions import text as X
from gleanworks.operators import extract
from gleanworks.operators.dedup import first_wins, unseen
from gleanworks.operators.frontier import Store, expand_rounds
from gleanworks.operators.graph import expand
from gleanworks.sources import tables


@dataclass
class Options:
    """What to collect: empty states or levels mean all, empty sports mean no filter."""

    base: str
    states: list[str] = field(default_factory=list)
    levels: list[str] = field(default_factory=lambda: ["varsity"])
    sports: list[str] = field(default_factory=list)
    schedules: bool = True
    discover: bool = True

    @classmethod
    def parse(cls, base: str, states: str | None = None, levels: str = "Varsity", sports: str | None = None, schedules: object = None, discover: object = None) -> Options:
        every = states in (None, "", "all")
        return cls(base, [] if every else X.listed(states), [] if str(levels).lower() == "all" else X.listed(levels), X.listed(sports), X.truthy(schedules), X.truthy(discover))


Reader = Callable[[DataFrame, str], DataFrame]


def recorded(pages: DataFrame) -> Reader:
    """A reader of a table of pages (url, kind, status, content_type, html, state_code); ``url`` is what was asked for."""

    def read(asked: DataFrame, kind: str) -> DataFrame:
        held = pages.where(F.col("kind") == kind).withColumn("request_url", F.col("url"))
        return held.join(asked.select(F.col("url").alias("request_url")).distinct(), "request_url", "left_semi")

    return read


def _directories(spark: SparkSession, o: Options) -> DataFrame:
    return tables.seeds(spark, o.base, o.states or None).select("url", "state_code")


def _records(spark: SparkSession, reached: DataFrame, school_pages: DataFrame, schedule_pages: DataFrame | None, o: Options) -> tuple[DataFrame, DataFrame]:
    """(schools, games) of the reached pages. A sport filter drops schools and schedules."""
    held = school_pages.join(reached.select(F.col("id").alias("url"), F.col("via").alias("discovered_via"), "depth"), "url")
    found = extract.schools(held)
    schools = first_wins(found, ["school_id"], F.struct("discovered_via", "url")).where(X.offers(F.col("sports"), o.sports))
    if schedule_pages is None:
        return schools, spark.createDataFrame([], "school_id string")
    asked = extract.season_requests(held, o.levels)
    if o.sports:
        asked = asked.where(F.lower(X.strip(F.col("sport"))).isin(o.sports))
    asked = first_wins(asked, ["request_url"], F.struct("school_url", "school_id", "sport", "gender", "season"))
    return schools, extract.games(asked.drop("school_url"), schedule_pages)


def collect(spark: SparkSession, pages: DataFrame, o: Options) -> tuple[DataFrame, DataFrame]:
    """(schools, games) reached from the directories of the wanted states, from a table of pages at once.

    A sport filter drops schools and schedules but never stops the expansion. A page's links are
    read once, when the edges are written.
    """
    of = lambda kind: pages.where(F.col("kind") == kind)
    wanted = F.lower("state_code").isin(o.states) if o.states else F.lit(True)
    seeds = extract.directory_links(of("directory").where(wanted))
    school_pages = of("school")
    schedule_pages = of("schedule").select(F.col("url").alias("request_url"), "url", "html")
    if o.discover:
        edges = extract.nearby_edges(school_pages)
        if o.schedules:
            known = extract.season_requests(school_pages, o.levels).select("request_url", "school_url").distinct()
            edges = edges.unionByName(extract.opponent_edges(schedule_pages.join(known, "request_url"), o.base))
        reached = expand(seeds, edges, X.in_scope(F.col("dst"), o.base, o.states))
    else:
        reached = expand(seeds, spark.createDataFrame([], "src string, dst string, via string"))
    return _records(spark, reached, school_pages, schedule_pages if o.schedules else None, o)


def crawl(spark: SparkSession, reader: Reader, o: Options, store: str, stop_after: int | None = None) -> tuple[DataFrame, DataFrame, bool]:
    """(schools, games, complete): ``collect`` with pages read as the frontier reaches them, resumable.

    ``reader`` takes urls and a kind (directory, school, schedule) and gives pages with request_url, url,
    state_code for directories, and html. Each round reads the pages of its schools and their
    schedules, keeps them in ``store`` and commits the schools that they newly lead to; a page is
    asked for once, and a crawl that stopped in or after any round goes on there. The rows are those
    of an unbroken run, since everything is computed from the kept pages.
    """
    kept = Store(spark, store, repr(o))
    page = ["request_url", "url", "state_code", "html"]

    def seeds() -> DataFrame:
        asked = _directories(spark, o)
        pages = kept.keep("directory", lambda: reader(asked.select("url"), "directory").drop("state_code").join(F.broadcast(asked.withColumnRenamed("url", "request_url")), "request_url").select(*page))  # a row for each state
        return extract.directory_links(pages)

    def visit(frontier: DataFrame, k: int) -> DataFrame:
        schools = kept.keep(f"school-{k:06d}", lambda: reader(frontier.select(F.col("id").alias("url")), "school").withColumn("url", F.col("request_url")).select(*page))
        edges = extract.nearby_edges(schools)
        if o.schedules:
            requests = extract.season_requests(schools, o.levels).select("request_url", "school_url").distinct()

            def schedules() -> DataFrame:
                asked, before = requests.select("request_url").distinct(), kept.kept("schedule-")
                asked = asked if before is None else unseen(asked, before, "request_url")
                return reader(asked.withColumnRenamed("request_url", "url"), "schedule").select(*page)

            edges = edges.unionByName(extract.opponent_edges(kept.keep(f"schedule-{k:06d}", schedules).join(requests, "request_url"), o.base))
        if not o.discover:
            edges = edges.limit(0)
        return edges.where(X.in_scope(F.col("dst"), o.base, o.states)).select(F.col("dst").alias("id"), "via")

    reached, complete = expand_rounds(kept, seeds, visit, stop_after=stop_after)
    nothing = spark.createDataFrame([], "request_url string, url string, state_code string, html string")
    all_of = lambda kind: found if (found := kept.kept(f"{kind}-")) is not None else nothing
    schools, games = _records(spark, reached, all_of("school"), all_of("schedule") if o.schedules else None, o)
    return schools, games, complete
