"""Record layouts: field orders, Spark schemas and the embedded page document."""

from __future__ import annotations

from pyspark.sql import types as T

# Field orders of the exported tables.
SCHOOL_FIELDS = [
    "school_id", "name", "city", "state", "state_name", "url", "mascot", "address", "zip_code", "phone", "color1", "color2", "color3", "mascot_url",
    "league_name", "association_name", "governing_body_name", "governing_body_url", "website", "facebook", "instagram", "twitter", "youtube", "sports",
    "sports_count", "discovered_via",
]
GAME_FIELDS = [
    "school_id", "school_name", "state", "sport", "gender", "season", "game_index", "date", "home_away", "opponent", "opponent_url", "result", "score",
    "game_info", "schedule_url",
]
# Columns that enrichment appends.
TICKET_COLUMNS = ["gofan_ticket_url", "gofan_school_id", "gofan_match"]
NETWORK_COLUMNS = ["nfhs_url", "nfhs_slug", "nfhs_match"]
NAME_COLUMN = "original_name"
VERIFIED_COLUMN = "go_fan_ticket_url"
TICKET_KINDS = ["exact", "fuzzy", "none"]
NETWORK_KINDS = ["gofan_id", "exact", "fuzzy", "none"]
TICKET_URL = "https://gofan.co/app/school/%s"
NETWORK_URL = "https://www.nfhsnetwork.com/schools/%s"

SCHOOL_KEY = ["school_id"]
GAME_KEY = ["school_id", "schedule_url", "game_index"]


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


SCHOOLS = T.StructType([T.StructField(f, {"sports": T.ArrayType(T.StringType()), "sports_count": T.IntegerType()}.get(f, T.StringType())) for f in SCHOOL_FIELDS])
GAMES = T.StructType([T.StructField(f, T.IntegerType() if f == "game_index" else T.StringType()) for f in GAME_FIELDS])

# Names of fields of the embedded document.
LINKS = _text("website", "facebook", "instagram", "twitter", "youtube")
URL_ONLY = _text("canonicalUrl")
SEASON = _text("sport", "gender", "level", "season", "year", "canonicalUrl")
INFO = _text(
    "schoolId", "name", "formattedName", "formattedNameWithoutState", "city", "stateCode", "state", "stateName", "canonicalUrl", "mascot", "address", "zipCode",
    "zip", "phone", "color1", "color2", "color3", "mascotUrl", "leagueName", "associationName", "associationGoverningBodyName",
    "associationGoverningBodyUrl", "websiteUrl",
)
PAGE_PROPS = T.StructType(
    [
        T.StructField("groupings", T.ArrayType(URL_ONLY)),
        T.StructField("schoolContext", T.StructType([T.StructField("schoolId", T.StringType()), T.StructField("schoolInfo", INFO), T.StructField("sportSeasons", T.ArrayType(SEASON))])),
        T.StructField("schoolLinksData", LINKS),
        T.StructField("nearbySchools", T.ArrayType(URL_ONLY)),
    ]
)
NEXT_DATA = T.StructType([T.StructField("props", T.StructType([T.StructField("pageProps", PAGE_PROPS)]))])
