"""Pages to typed rows: schools, seasons, games and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanworks.functions import html as H
from gleanworks.functions import text as X
from gleanworks.schemas import GAME_FIELDS, NEXT_DATA, SCHOOL_FIELDS


def with_props(pages: DataFrame, html: str = "html", out: str = "props") -> DataFrame:
    """``pages`` with the embedded document's page properties; absent or malformed: null fields."""
    return pages.withColumn(out, F.from_json(H.embedded(F.col(html)), NEXT_DATA)["props"]["pageProps"])


def directory_links(pages: DataFrame) -> DataFrame:
    """``id, via`` of the schools that directory pages (state_code) list; not limited to a scope."""
    listed = with_props(pages).select("state_code", F.explode("props.groupings").alias("g"))
    return listed.where(X.nz(F.col("g.canonicalUrl")) != "").select(F.col("g.canonicalUrl").alias("id"), F.concat(F.lit("directory:"), "state_code").alias("via"))


def _school_id() -> Column:
    return X.first_truthy(F.col("props.schoolContext.schoolId"), F.col("props.schoolContext.schoolInfo.schoolId"))


def schools(pages: DataFrame) -> DataFrame:
    """School rows of school pages (url, discovered_via, html); pages without an id give none."""
    i, links = (lambda f: F.col(f"props.schoolContext.schoolInfo.{f}")), (lambda f: F.col(f"props.schoolLinksData.{f}"))
    plain = {"city": "city", "state_name": "stateName", "mascot": "mascot", "address": "address", "phone": "phone", "mascot_url": "mascotUrl", "league_name": "leagueName", "association_name": "associationName", "governing_body_name": "associationGoverningBodyName", "governing_body_url": "associationGoverningBodyUrl"}
    cols = {k: i(v) for k, v in plain.items()} | {c: X.strip(X.nz(i(c))) for c in ("color1", "color2", "color3")} | {c: links(c) for c in ("facebook", "instagram", "twitter", "youtube")}
    cols |= {
        "school_id": _school_id(),
        "name": X.first_truthy(i("name"), i("formattedNameWithoutState")),
        "state": X.first_truthy(i("stateCode"), i("state")),
        "url": X.first_truthy(i("canonicalUrl"), F.col("url")),
        "zip_code": X.first_truthy(i("zipCode"), i("zip")),
        "website": X.first_truthy(links("website"), i("websiteUrl")),
        "sports": X.sport_labels(F.col("props.schoolContext.sportSeasons")),
        "discovered_via": F.col("discovered_via"),
    }
    cols["sports_count"] = F.size(cols["sports"])
    return with_props(pages).where(X.nz(_school_id()) != "").select(*[cols[f].alias(f) for f in SCHOOL_FIELDS])


def season_requests(pages: DataFrame, levels: list[str]) -> DataFrame:
    """A row for each team with a page: schedule_url, team and school context. No levels: all.

    Levels are compared in lower case and not trimmed; the array is filtered before it is exploded.
    """
    wanted = lambda s: (X.nz(s["canonicalUrl"]) != "") & (F.lower(X.nz(s["level"])).isin(levels) if levels else F.lit(True))
    info = "props.schoolContext.schoolInfo"
    rows = with_props(pages).select(
        F.col("url").alias("school_url"), _school_id().alias("school_id"), X.first_truthy(F.col(f"{info}.name"), F.col(f"{info}.formattedName")).alias("school_name"),
        X.first_truthy(F.col(f"{info}.stateCode"), F.col(f"{info}.state")).alias("state"), F.explode(F.filter("props.schoolContext.sportSeasons", wanted)).alias("team"),
    )
    return rows.select(X.schedule_url(F.col("team.canonicalUrl")).alias("request_url"), "school_url", "school_id", "school_name", "state", F.col("team.sport").alias("sport"), F.col("team.gender").alias("gender"), X.season_label(F.col("team.season"), F.col("team.year")).alias("season"))


def games(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """Game rows: ``requests`` joined to schedule pages (request_url, url after redirects, html)."""
    parsed = pages.select("request_url", F.col("url").alias("schedule_url"), H.schedule_table(F.col("html")).alias("t"))
    rows = parsed.select("request_url", "schedule_url", F.explode("t.rows").alias("r")).join(requests, "request_url")
    cell = lambda k: X.nz(F.get("r.cells", F.lit(k)))
    out = rows.select("*", cell(0).alias("date"), cell(1).alias("raw"), cell(2).alias("game_info"), F.col("r.game_index").alias("game_index"))
    out = out.withColumn("home_away", X.home_away(F.col("raw"))).withColumn("opponent", X.clean_opponent(F.col("raw")))
    out = out.withColumn("opponent_url", F.when(X.nz(F.col("r.opp_href")) != "", H.url_join(F.col("schedule_url"), F.col("r.opp_href"))).otherwise(""))
    return out.withColumn("result", X.result_of(F.col("game_info"))).withColumn("score", X.score_of(F.col("game_info"))).select(*GAME_FIELDS)


def nearby_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, via``: links of school pages to nearby schools."""
    near = with_props(pages).select(F.col("url").alias("src"), F.explode("props.nearbySchools").alias("n"))
    return near.where(X.nz(F.col("n.canonicalUrl")) != "").select("src", F.col("n.canonicalUrl").alias("dst"), F.lit("nearby").alias("via"))


def opponent_edges(pages: DataFrame, base: str) -> DataFrame:
    """``src, dst, via``: links of schedule pages (school_url, url, html) to opponents' school pages."""
    links = pages.select(F.col("school_url").alias("src"), "url", F.explode(H.schedule_table(F.col("html"))["links"]).alias("href"))
    root = X.school_root(H.url_join(F.col("url"), F.col("href")), base)
    return links.select("src", root.alias("dst"), F.lit("opponent").alias("via")).where(F.col("dst").isNotNull())


def page_name(pages: DataFrame, out: str = "found_name") -> DataFrame:
    """``pages`` with the best name a page (status, content_type, html) gives; empty if none.

    Metadata titles in order, then the title, all cleaned; then the first heading, only trimmed.
    Junk is passed over; error pages and other kinds of content give nothing.
    """
    t = pages.withColumn("titles_", H.titles(F.col("html")))
    cleaned = [X.clean_title(F.col(f"titles_.{k}")) for k in ("og_site", "og_title", "name_site", "name_title", "title")] + [X.strip(X.nz(F.col("titles_.h1")))]
    good = F.coalesce(*[F.when((c != "") & ~X.is_junk(c), c) for c in cleaned], F.lit(""))
    usable = (F.coalesce("status", F.lit(0)) < 400) & H.is_page(F.col("content_type"))
    return t.withColumn(out, F.when(usable, good).otherwise("")).drop("titles_")
