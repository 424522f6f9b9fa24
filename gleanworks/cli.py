"""Command line: crawl pages, enrich CSVs, rebuild exports, or all of a job's steps.

Pages are a Parquet table, or the word ``live``: then they are fetched politely. A catalog is a JSON file, or
an address template with braces: then it is built from its service, slice by slice, in ``--store``.
Exit codes: 2 for wrong usage, 1 for a missing input, 3 for a catalog that is incomplete, 4 for a crawl that
has stopped after ``--rounds`` and is to be taken up with ``--resume``.
"""

from __future__ import annotations

import argparse
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.operators import enrich, match, sinks
from gleanworks.plans import crawl as plan
from gleanworks.plans.crawl import Options
from gleanworks.schemas import GAME_KEY, NAME_COLUMN, SCHOOL_KEY, TICKET_URL
from gleanworks.sources import catalog, connectors, fetch
from gleanworks.sources.tables import read_csv, read_json_array
from gleanworks.storage import exists, fresh, remove

#: Seconds that a job's enrichment steps may take.
NAMES_SECONDS, TICKETS_SECONDS = 1800, 900


def crawl(spark: SparkSession, pages: str, out: str, options: Options, best_effort=(), rounds: int | None = None, resume: bool = False, limits: fetch.Limits | None = None) -> tuple[int, int] | None:
    """Collect into the store under ``out`` and export it; None if the crawl was stopped after ``rounds``.

    Its rounds are kept under ``out``/crawl, where ``resume`` takes them up. ``best_effort`` steps may fail
    without harm.
    """
    kept = f"{out}/crawl"
    if not resume:
        remove(spark, kept)
    reader = fetch.page_reader(limits) if pages == "live" else plan.recorded(spark.read.parquet(pages))
    schools, games, complete = plan.crawl(spark, reader, options, kept, rounds)
    if not complete:
        return None
    sinks.write_table(schools, f"{out}/store/schools", SCHOOL_KEY)
    sinks.write_table(games, f"{out}/store/games", GAME_KEY if set(GAME_KEY) <= set(games.columns) else None)
    counts = sinks.export(spark, f"{out}/store", out)
    for step in best_effort:
        try:
            step()
        except Exception as why:  # noqa: BLE001 - enrichment never fails a finished crawl
            print(f"enrichment failed, output left as it is: {why!r}", file=sys.stderr)
    return counts


def limited(spark: SparkSession, seconds: float, step: Callable[[], object]) -> None:
    """Run ``step``, its Spark jobs in a group of their own that is cancelled after ``seconds``; TimeoutError then."""
    from pyspark import InheritableThread

    group, failed = f"limited-{uuid.uuid4().hex}", []

    def run() -> None:
        spark.sparkContext.setJobGroup(group, "a step with a time limit", True)
        try:
            step()
        except BaseException as why:  # noqa: BLE001 - raised again below
            failed.append(why)

    worker = InheritableThread(target=run, daemon=True)
    worker.start()
    worker.join(seconds)
    if worker.is_alive():
        spark.sparkContext.cancelJobGroup(group)
        worker.join(10)
        raise TimeoutError(f"a step took longer than {seconds} seconds")
    if failed:
        raise failed[0]


def enrich_csv(spark: SparkSession, path: str, add) -> int:
    """``add`` columns to a CSV file in place, its rows in their order; the number of rows.

    Places are fixed at the scan, which is written once, so joins in ``add`` may deal the rows anew and
    rows may be counted without reading the file again. The file is replaced in one step.
    """
    first = read_csv(spark, path)
    pos = sinks.free("pos_", first.columns)
    held = fresh(spark, "csv-rows")
    read_csv(spark, path, pos).write.parquet(held)
    try:
        rows = spark.read.parquet(held)
        new = add(rows)
        fields = [*first.columns, *[c for c in new.columns if c not in rows.columns]]
        sinks.write_csv_file(new, path, fields, pos)
        return rows.count()
    finally:
        remove(spark, held)


def live_pages(rows: DataFrame, limits: fetch.Limits | None = None) -> DataFrame:
    """Pages (website, status, content_type, html) of the rows' web sites, each fetched once."""
    got = fetch.fetch(rows.select("website"), limits, url_col="website")
    return got.select(F.col("request_url").alias("website"), "status", "content_type", "html")


def names(spark: SparkSession, path: str, pages: str, limits: fetch.Limits | None = None) -> int:
    """Add the names on web sites to a CSV; a site that can't be read leaves a row its own name."""

    def add(rows: DataFrame) -> DataFrame:
        if pages != "live":
            return enrich.add_site_name(rows, spark.read.parquet(pages))
        held = fresh(spark, "sites")
        live_pages(rows, limits).write.parquet(held)  # fetched once
        return enrich.add_site_name(rows, spark.read.parquet(held))

    return enrich_csv(spark, path, add)


def ticket_tables(spark: SparkSession, rows: DataFrame, source: str, places: str | None, store: str | None, refresh: bool = False, **options: object) -> tuple[DataFrame, DataFrame] | None:
    """(catalog, places of its schools), from files or built from services; None if either is not there."""
    if "{" in source:
        cat = connectors.ticket_catalog(spark, source, f"{store}/tickets", refresh, **options)
    elif exists(spark, source):
        cat = read_json_array(spark, source, "huddleId string, name string, state string").withColumnRenamed("huddleId", "id")
    else:
        return None
    if places and "{" in places:
        asked = match.candidate_ids(rows, cat)
        return cat, catalog.lookup_details(asked, connectors.details_at(places, wait=float(options.get("wait", 1.0))), f"{store}/places", float(options.get("pause", 0.15)))
    if not places or not exists(spark, places):
        return None
    return cat, read_json_array(spark, places, "huddleId string, city string, zipCode string").selectExpr("huddleId as id", "city", "zipCode as zip_code")


def verified(spark: SparkSession, rows: DataFrame, cat: DataFrame, places: DataFrame, status: str, limits: fetch.Limits | None = None) -> DataFrame:
    """Rows with the ticket page that answers; ``status`` is a table of url, status, or ``live``."""
    rows = rows if NAME_COLUMN in rows.columns else rows.withColumn(NAME_COLUMN, F.lit(""))
    if status != "live":
        return enrich.add_verified_ticket(rows, cat, spark.read.parquet(status), places)
    found = match.match_twice(rows, cat, places).where("match_id is not null").select(F.format_string(TICKET_URL, "match_id").alias("url"))
    held = fresh(spark, "statuses")
    fetch.statuses(found, limits).write.parquet(held)  # asked once
    return enrich.add_verified_ticket(rows, cat, spark.read.parquet(held), places)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gleanworks")
    sub = p.add_subparsers(dest="what", required=True)
    for name in ("crawl", "work"):
        c = sub.add_parser(name)
        c.add_argument("pages", help="a Parquet table of pages, or live")
        c.add_argument("output")
        c.add_argument("--base", required=True)
        c.add_argument("--states", default="all")
        c.add_argument("--sports", default="")
        c.add_argument("--levels", default="Varsity")
        c.add_argument("--no-schedules", action="store_true")
        c.add_argument("--no-discover", action="store_true")
        c.add_argument("--rounds", type=int, help="stop after so many rounds")
        c.add_argument("--resume", action="store_true", help="take up a crawl that was stopped")
        if name == "work":
            c.add_argument("--sites", default="live", help="a Parquet table of pages of web sites, or live")
            c.add_argument("--catalog", required=True)
            c.add_argument("--detail", required=True)
            c.add_argument("--status", default="live")
            c.add_argument("--names-seconds", type=float, default=NAMES_SECONDS)
            c.add_argument("--tickets-seconds", type=float, default=TICKETS_SECONDS)
    for name in ("tickets", "verified", "network"):
        e = sub.add_parser(name)
        e.add_argument("csv")
        e.add_argument("catalog", help="a JSON file, or an address with {page} and {size}, or {state}, {start} and {size}")
        e.add_argument("--store", help="where a catalog from a service is kept")
        e.add_argument("--refresh", action="store_true")
        e.add_argument("--pause", type=float, help="seconds between requests")
        e.add_argument("--wait", type=float, default=1.0, help="a factor of the waits between tries")
        if name != "network":
            e.add_argument("--detail", help="JSON array of huddleId, city, zipCode, or an address with {id}")
        else:
            e.add_argument("--steps", help="slices, joined by commas, if not all")
        if name == "verified":
            e.add_argument("--status", required=True, help="Parquet table of url, status, or live")
    e = sub.add_parser("names")
    e.add_argument("csv")
    e.add_argument("pages", help="a Parquet table of pages, or live")
    x = sub.add_parser("export")
    x.add_argument("store")
    x.add_argument("output")
    return p


def _enrich(spark: SparkSession, a: argparse.Namespace) -> int:
    if not exists(spark, a.csv):
        print(f"there is nothing to read at {a.csv}", file=sys.stderr)
        return 1
    if a.what == "names":
        names(spark, a.csv, a.pages)
        return 0
    store = a.store or f"{os.path.dirname(a.csv) or '.'}/catalogs"
    options = {"wait": a.wait} | ({} if a.pause is None else {"pause": a.pause})
    if a.what == "network":
        if "{" in a.catalog:
            cat, complete = connectors.network_catalog(spark, a.catalog, f"{store}/network", a.steps.split(",") if a.steps else None, a.refresh, **options)
            if not complete:
                left = catalog.missing(spark, f"{store}/network", a.steps.split(",") if a.steps else None)
                print(f"{len(left)} slices could not be read ({', '.join(left[:8])}{', ...' if len(left) > 8 else ''}); run it again. {a.csv} stays as it was", file=sys.stderr)
                return 3
        elif exists(spark, a.catalog):
            cat = read_json_array(spark, a.catalog, "slug string, name string, city string, state_code string, gofan_id string")
        else:
            print(f"there is no catalog at {a.catalog}; {a.csv} stays as it was", file=sys.stderr)
            return 3
        enrich_csv(spark, a.csv, lambda rows: enrich.add_network(rows, cat))
        return 0
    found = ticket_tables(spark, read_csv(spark, a.csv), a.catalog, a.detail, store, a.refresh, **options)
    if found is None:
        print(f"a catalog and the places of its schools (--detail) are needed: without them any school of a name would match. {a.csv} stays as it was", file=sys.stderr)
        return 3
    if a.what == "tickets":
        enrich_csv(spark, a.csv, lambda rows: enrich.add_tickets(rows, *found))
    else:
        enrich_csv(spark, a.csv, lambda rows: verified(spark, rows, *found, a.status))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    if a.what in ("tickets", "verified", "network", "names"):
        return _enrich(spark, a)
    if a.what == "export":
        print("exported %d schools and %d games" % sinks.export(spark, a.store, a.output))
        return 0
    o = Options.parse(a.base, a.states, a.levels, a.sports, not a.no_schedules, not a.no_discover)
    steps = []
    if a.what == "work":
        table = f"{a.output}/schools.csv"

        def tickets() -> None:
            found = ticket_tables(spark, read_csv(spark, table), a.catalog, a.detail, f"{a.output}/catalogs")
            if found is None:
                raise FileNotFoundError(f"no catalog at {a.catalog} or no places at {a.detail}")
            enrich_csv(spark, table, lambda rows: verified(spark, rows, *found, a.status))

        steps = [lambda: limited(spark, a.names_seconds, lambda: names(spark, table, a.sites)), lambda: limited(spark, a.tickets_seconds, tickets)]
    counts = crawl(spark, a.pages, a.output, o, steps, a.rounds, a.resume)
    if counts is None:
        print(f"stopped after {a.rounds} rounds; --resume takes it up", file=sys.stderr)
        return 4
    print("collected %d schools and %d games" % counts)
    return 0


if __name__ == "__main__":
    sys.exit(main())
