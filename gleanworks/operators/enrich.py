"""Column enrichment, its statistics and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanworks.functions import text as X
from gleanworks.operators.extract import page_name
from gleanworks.operators.match import match_network, match_tickets, match_twice
from gleanworks.schemas import NAME_COLUMN, NETWORK_COLUMNS, NETWORK_URL, TICKET_COLUMNS, TICKET_URL, VERIFIED_COLUMN


def append(df: DataFrame, columns: dict) -> DataFrame:
    """``df`` with columns set: present ones are overwritten in place, others come last."""
    return df.withColumns(columns)


def add_tickets(rows: DataFrame, catalog: DataFrame, detail: DataFrame | None = None) -> DataFrame:
    m = match_tickets(rows.drop("match_id", "match_kind"), catalog, detail)
    url, key, kind = TICKET_COLUMNS
    got = F.col("match_id").isNotNull()
    return append(m, {url: F.when(got, F.format_string(TICKET_URL, "match_id")).otherwise(""), key: X.nz(F.col("match_id")), kind: F.col("match_kind")}).drop("match_id", "match_kind")


def add_network(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    m = match_network(rows.drop("match_id", "match_kind"), catalog)
    url, key, kind = NETWORK_COLUMNS
    got = F.col("match_id").isNotNull()
    return append(m, {url: F.when(got, F.format_string(NETWORK_URL, "match_id")).otherwise(""), key: X.nz(F.col("match_id")), kind: F.col("match_kind")}).drop("match_id", "match_kind")


def add_site_name(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """The name on a row's web site, else its own; pages: website, status, content_type, html.

    Only http(s) sites are looked up; a website has one page (the first by its text, if repeated).
    """
    site = X.strip(X.nz(F.col("website")))
    names = page_name(pages).groupBy(F.col("website").alias("site_")).agg(F.min("found_name").alias("found_"))
    keyed = rows.withColumn("site_", F.when(site.rlike("(?i)^https?://"), site))
    return append(keyed.join(names, "site_", "left"), {NAME_COLUMN: X.first_truthy(F.col("found_"), X.strip(X.nz(F.col("name"))))}).drop("site_", "found_")


def add_verified_ticket(rows: DataFrame, catalog: DataFrame, status: DataFrame, detail: DataFrame | None = None) -> DataFrame:
    """The ticket page of a row matched by site name or name, kept only if its status (url, status) is 200."""
    m = match_twice(rows, catalog, detail)
    m = m.withColumn("url_", F.when(F.col("match_id").isNotNull(), F.format_string(TICKET_URL, "match_id")))
    seen = status.groupBy(F.col("url").alias("url_")).agg(F.max((F.col("status") == 200).cast("int")).alias("ok_"))
    return append(m.join(seen, "url_", "left"), {VERIFIED_COLUMN: F.when(F.col("ok_") == 1, F.col("url_")).otherwise("")}).drop("url_", "ok_", "match_id", "match_kind")


def kind_counts(df: DataFrame, kind: str, kinds: list[str]) -> DataFrame:
    """Rows of each kind, zeros included, and the whole percentage of all rows that match (kind not ``none``)."""
    fixed = df.sparkSession.createDataFrame([(k,) for k in kinds], f"{kind} string")
    n = fixed.join(df.groupBy(kind).agg(F.count(F.lit(1)).alias("n")), kind, "left").select(kind, F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    every = Window.partitionBy()  # a row for each kind
    matched = F.sum(F.when(F.col(kind) != "none", F.col("n")).otherwise(0)).over(every)
    return n.select(kind, "n", X.percent(matched, F.sum("n").over(every)).alias("matched_percent"))


def fallback_counts(df: DataFrame) -> DataFrame:
    """Rows whose site name differs from their name, and the others."""
    differs = X.strip(X.nz(F.col(NAME_COLUMN))) != X.strip(X.nz(F.col("name")))
    return df.agg(F.count_if(differs).alias("scraped"), F.count_if(~differs).alias("fallback"))


def source_counts(df: DataFrame) -> DataFrame:
    """Rows matched by site name and by name, and those with a verified page."""
    s = F.col("match_source")
    return df.agg(F.count_if(s == "original").alias("matched_original"), F.count_if(s == "name").alias("matched_name"), F.count_if(X.nz(F.col(VERIFIED_COLUMN)) != "").alias("verified"))


def record_by_entity(games: DataFrame, key: str = "school_id", name: str = "school_name", sport: str | None = None) -> DataFrame:
    """Games and wins by entity, most wins first; unknown results count as no win, only unknown ones as null."""
    held = games if sport is None else games.where(F.col("sport") == sport)
    rows = held.groupBy(key).agg(F.min(name).alias(name), F.count(F.lit(1)).alias("games"), F.sum((F.col("result") == "W").cast("long")).alias("wins"))
    return rows.orderBy(F.desc("wins"), key)
