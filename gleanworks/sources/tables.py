"""File sources and fixed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# States by code, and common sports.
STATES = {
    "al": "Alabama", "ak": "Alaska", "az": "Arizona", "ar": "Arkansas", "ca": "California", "co": "Colorado", "ct": "Connecticut", "de": "Delaware",
    "dc": "District of Columbia", "fl": "Florida", "ga": "Georgia", "hi": "Hawaii", "id": "Idaho", "il": "Illinois", "in": "Indiana", "ia": "Iowa",
    "ks": "Kansas", "ky": "Kentucky", "la": "Louisiana", "me": "Maine", "md": "Maryland", "ma": "Massachusetts", "mi": "Michigan", "mn": "Minnesota",
    "ms": "Mississippi", "mo": "Missouri", "mt": "Montana", "ne": "Nebraska", "nv": "Nevada", "nh": "New Hampshire", "nj": "New Jersey",
    "nm": "New Mexico", "ny": "New York", "nc": "North Carolina", "nd": "North Dakota", "oh": "Ohio", "ok": "Oklahoma", "or": "Oregon",
    "pa": "Pennsylvania", "ri": "Rhode Island", "sc": "South Carolina", "sd": "South Dakota", "tn": "Tennessee", "tx": "Texas", "ut": "Utah",
    "vt": "Vermont", "va": "Virginia", "wa": "Washington", "wv": "West Virginia", "wi": "Wisconsin", "wy": "Wyoming",
}
SPORTS = [
    "Football", "Basketball", "Baseball", "Softball", "Soccer", "Volleyball", "Wrestling", "Track & Field", "Cross Country", "Tennis", "Golf", "Lacrosse",
    "Field Hockey", "Ice Hockey", "Swimming", "Flag Football",
]


def states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATES.items()), "code string, name string")


def sports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(SPORTS)), "pos int, name string")


def seeds(spark: SparkSession, base: str, codes: list[str] | None = None) -> DataFrame:
    """A directory page for each state: url, state_code."""
    wanted = states(spark) if codes is None else states(spark).where(F.col("code").isin([c.lower() for c in codes]))
    return wanted.select(F.format_string(f"{base}/%s/schools/", "code").alias("url"), F.col("code").alias("state_code"))


def read_csv(spark: SparkSession, path: str, pos: str | None = None) -> DataFrame:
    """A CSV with a header, all cells text; blank cells are empty strings, quoted line ends are kept.

    ``pos``, if given, names a column of the rows' places: rows of a file in their order. A file with quoted line
    ends can't be cut, so it is read by one task, as a stream.
    """
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.fillna("")
    return df if pos is None else df.withColumn(pos, F.monotonically_increasing_id())


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A cached catalog: a JSON array, with ``pos``, its order."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("pos", F.monotonically_increasing_id())
