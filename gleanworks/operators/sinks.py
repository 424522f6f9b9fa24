"""Table and export sinks.

Canonical tables are Parquet. A table's folder holds versions and one small numbered file for each
commit, which says what folders make the table up: one for each bucket by a hash of the key, and
loose ones for rows without a key. A commit writes its rows and then creates the file of the next
number, which only one writer can; so readers see the old table or the new one, a crash leaves the
old one, and a writer whose table has changed meanwhile starts again or is told. An upsert writes only the
buckets that it touches. Buckets double in number when they would grow beyond a size, so that each
stays one task's work. CSV and JSON are derived from tables, written in parts by tasks, and joined
to one file that takes its name in one step.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanworks.functions import text as X
from gleanworks.operators.dedup import first_wins, last_wins
from gleanworks.schemas import GAME_FIELDS, GAME_KEY, GAMES, SCHOOL_FIELDS, SCHOOL_KEY, SCHOOLS
from gleanworks.storage import file_system, fresh, join_files, names_in, read_text, remove, size_of, write_text

CSV = {"header": True, "escape": '"', "emptyValue": "", "nullValue": "", "multiLine": True}
BUCKETS = 64
BUCKET_BYTES = 1 << 30
KEEP_VERSIONS = 3
ATTEMPTS = 5


class ConcurrentWrite(RuntimeError):
    """Another writer has committed to the table meanwhile."""


def replace(df: DataFrame, path: str, write) -> None:
    """``write(df, folder)`` to a fresh folder, then rename it to ``path``."""
    spark = df.sparkSession
    fs, hadoop = file_system(spark, path)
    new, old = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}", f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    write(df, new)
    if fs.exists(hadoop(path)):
        fs.rename(hadoop(path), hadoop(old))
    fs.rename(hadoop(new), hadoop(path))
    fs.delete(hadoop(old), True)


def _commits(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names_in(spark, f"{path}/commits") if n.removesuffix(".json").isdigit())


def has_table(spark: SparkSession, path: str) -> bool:
    return bool(_commits(spark, path))


def _state(spark: SparkSession, path: str) -> dict:
    found = _commits(spark, path)
    if found:
        return json.loads(read_text(spark, f"{path}/commits/{found[-1]:08d}.json"))
    return {"version": 0, "parts": {}, "loose": [], "schema": None, "keys": None, "buckets": BUCKETS, "batches": {}}


def _read(spark: SparkSession, path: str, state: dict, buckets: list[str] | None = None) -> DataFrame:
    """The whole table, or only rows of ``buckets``."""
    schema = StructType.fromJson(state["schema"])
    folders = sorted({f for b, f in state["parts"].items() if buckets is None or b in buckets}) + (state["loose"] if buckets is None else [])
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders]) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table's current version, which stays readable for KEEP_VERSIONS commits; FileNotFoundError if there is none."""
    if not has_table(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    return _read(spark, path, _state(spark, path))


def _commit(spark: SparkSession, path: str, state: dict) -> bool:
    """Make ``state`` the version after the one it was made from; false if another writer has made one."""
    n = state["version"] + 1
    if not write_text(spark, f"{path}/commits/{n:08d}.json", [json.dumps(state | {"version": n})], overwrite=False):
        return False
    found = _commits(spark, path)
    held = lambda k: json.loads(read_text(spark, f"{path}/commits/{k:08d}.json"))
    old, live = [k for k in found if k <= n - KEEP_VERSIONS], set()
    for k in found[len(old) :] if old else []:
        s = held(k)
        live |= {*s["parts"].values(), *s["loose"]}
    for k in old:
        s = held(k)
        for folder in {*s["parts"].values(), *s["loose"]} - live:
            remove(spark, f"{path}/{folder}")
        remove(spark, f"{path}/commits/{k:08d}.json")
    return True


def _no_key(keys: list[str]) -> Column:
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return null


def _write_buckets(df: DataFrame, path: str, keys: list[str], buckets: int) -> dict[str, str]:
    """Rows with a key in a folder for each bucket, a bucket to a task; bucket -> folder."""
    spark, version, name = df.sparkSession, f"v-{uuid.uuid4().hex}", free("bucket_", df.columns)
    at = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    df.withColumn(name, at).repartition(name).write.partitionBy(name).parquet(f"{path}/{version}")
    return {n.rpartition("=")[2]: f"{version}/{n}" for n in names_in(spark, f"{path}/{version}") if n.startswith(f"{name}=")}


def _write_loose(df: DataFrame, path: str) -> list[str]:
    """Rows as they are dealt already; no folder if there are none."""
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    if spark.read.schema(df.schema).parquet(f"{path}/{version}").head(1):
        return [version]
    remove(spark, f"{path}/{version}")
    return []


def _grown(spark: SparkSession, path: str, parts: dict[str, str], buckets: int, more: int = 0) -> int:
    """The number of buckets, doubled until one holds BUCKET_BYTES or less on average."""
    size = sum(size_of(spark, f"{path}/{f}") for f in parts.values()) + more
    while size > BUCKET_BYTES * buckets:
        buckets *= 2
    return buckets


def write_table(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Replace the table at ``path``; ``keys`` put rows into buckets, for later upserts by them.

    Without keys rows are written as they are dealt. If another writer commits meanwhile, ConcurrentWrite is raised.
    """
    spark = df.sparkSession
    before = _state(spark, path)
    made = before | {"schema": df.schema.jsonValue(), "keys": keys or None, "parts": {}, "batches": {}}
    if keys:
        made["parts"] = _write_buckets(df.where(~_no_key(keys)), path, keys, before["buckets"])
        made["loose"] = _write_loose(df.where(_no_key(keys)), path)
    else:
        made["loose"] = _write_loose(df, path)
    if not _commit(spark, path, made):
        raise ConcurrentWrite(f"{path} was changed by another writer")


def append_table(df: DataFrame, path: str) -> None:
    """Add rows to a table without keys, in one commit; none, if there are no rows and there is a table."""
    spark = df.sparkSession
    added = _write_loose(df, path)
    for _ in range(ATTEMPTS):
        before = _state(spark, path)
        if before["keys"]:
            raise ValueError("rows are added to a table with keys by an upsert")
        if before["schema"] and not added:
            return
        if _commit(spark, path, before | {"loose": before["loose"] + added, "schema": df.schema.jsonValue()}):
            return
    raise ConcurrentWrite(f"{path} was changed by other writers {ATTEMPTS} times")


def _winners(df: DataFrame, keys: list[str], seq: str, first: bool) -> DataFrame:
    return first_wins(df, keys, F.col(seq), keep_null_keys=True) if first else last_wins(df, keys, F.col(seq))


def upsert_table(updates: DataFrame, path: str, keys: list[str], seq: str, batch: tuple[str, int] | None = None, first: bool = False) -> None:
    """Apply ``updates`` to the table at ``path``, the latest ``seq`` of a key winning; the earliest, if ``first``.

    A row with a null ``seq`` loses to any other. Rows with a null key never collapse and are added. The table
    must have been made by upserts with these keys, or by ``write_table`` with them. Only the buckets of the
    updates' keys are read and written. Columns that one side lacks are null. If another writer commits
    meanwhile, the work is done again on its table. ``batch`` (name, number): nothing is done if that
    number of the name, or a later one, has been applied.
    """
    spark, staged = updates.sparkSession, f"{path}/staged-{uuid.uuid4().hex}"
    _winners(updates, keys, seq, first).write.parquet(staged)
    try:
        new = spark.read.schema(updates.schema).parquet(staged)
        keyed, loose = new.where(~_no_key(keys)), None
        for _ in range(ATTEMPTS):
            before = _state(spark, path)
            if batch and before["batches"].get(batch[0], -1) >= batch[1]:
                return
            if before["schema"] and before["keys"] != keys:
                raise ValueError(f"the table at {path} is kept by {before['keys']}, not by {keys}")
            loose = _write_loose(new.where(_no_key(keys)), path) if loose is None else loose
            made = _merge(keyed, path, keys, seq, before, size_of(spark, staged), first)
            made |= {"loose": made["loose"] + loose, "batches": before["batches"] | ({batch[0]: batch[1]} if batch else {})}
            if _commit(spark, path, made):
                return
        raise ConcurrentWrite(f"{path} was changed by other writers {ATTEMPTS} times")
    finally:
        remove(spark, staged)


def _merge(new: DataFrame, path: str, keys: list[str], seq: str, before: dict, size: int, first: bool) -> dict:
    """The state after ``new`` is merged into the buckets of ``before``."""
    spark = new.sparkSession
    buckets = _grown(spark, path, before["parts"], before["buckets"], size)
    at = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    touched = None
    if buckets == before["buckets"]:
        touched = [str(r["b"]) for r in new.select(at.alias("b")).distinct().collect()]  # a number for each bucket at most
    both = new
    if before["schema"]:
        held = _read(spark, path, before | {"loose": []}, touched)
        both = held.unionByName(new, allowMissingColumns=True)
        schema = _read(spark, path, before, []).unionByName(new, allowMissingColumns=True).schema
    else:
        schema = new.schema
    parts = _write_buckets(_winners(both, keys, seq, first), path, keys, buckets) if touched or touched is None else {}
    kept = {} if touched is None else {b: f for b, f in before["parts"].items() if b not in touched}
    return before | {"parts": kept | parts, "schema": schema.jsonValue(), "keys": keys, "buckets": buckets}


def flat(df: DataFrame, fields: list[str]) -> DataFrame:
    """The fields as text cells: lists joined, numbers as text, unknown columns left out, missing ones null."""
    kinds = dict(df.dtypes)
    cell = lambda f: X.joined(F.col(f"`{f}`")) if kinds[f].startswith("array") else F.col(f"`{f}`").cast("string")
    return df.select(*[(cell(f) if f in kinds else F.lit(None).cast("string")).alias(f) for f in fields])


def write_csv(df: DataFrame, path: str, fields: list[str], mode: str = "overwrite", single: bool = False) -> None:
    """CSV with a header; ``append`` adds files to a folder, an overwrite swaps one in. ``single``: one file, see ``write_csv_file``."""
    if single:
        if mode == "append":
            raise ValueError("one file is written whole")
        write_csv_file(df, path, fields)
        return
    put = lambda d, p: d.write.options(**{k: v for k, v in CSV.items() if k != "multiLine"}).mode("append").csv(p)
    put(flat(df, fields), path) if mode == "append" else replace(flat(df, fields), path, put)


def _parts(spark: SparkSession, folder: str) -> list[str]:
    """A written folder's files in the order of the partitions that wrote them."""
    found = [n for n in names_in(spark, folder) if n.startswith("part-")]
    return [f"{folder}/{n}" for n in sorted(found, key=lambda n: (int(n.split("-")[1]), n))]


def in_order(df: DataFrame, pos: str) -> DataFrame:
    """``df`` in the order of ``pos``, which is dropped: a partition's rows are before those of the next."""
    return df.repartitionByRange(F.col(pos).asc_nulls_first()).sortWithinPartitions(F.col(pos).asc_nulls_first()).drop(pos)


def write_csv_file(df: DataFrame, path: str, fields: list[str], pos: str | None = None) -> None:
    """One CSV file with a header, its rows in the order of ``pos`` if given.

    Tasks write ranges of rows, the file system joins them, and the file takes its name in one step, in
    place of what was there: readers find the old file or the new one. ``pos`` need not be in ``fields``. ``path`` may be
    among what ``df`` reads.
    """
    spark, folder = df.sparkSession, fresh(df.sparkSession, "csv-parts")
    rows = flat(df, fields)
    if pos is not None:
        at = free("pos_", fields)
        rows = in_order(flat(df.withColumn(at, F.col(pos)), fields + [at]).withColumn(at, F.col(at).cast("long")), at)
    options = {k: v for k, v in CSV.items() if k not in ("multiLine", "header")}
    try:
        rows.write.options(**options).csv(f"{folder}/rows")
        head = ",".join(f if f and not any(c in f for c in ',"\r\n') else '"' + f.replace('"', '""') + '"' for f in fields)
        write_text(spark, f"{folder}/head", [head + "\n"])
        join_files(spark, [f"{folder}/head", *_parts(spark, f"{folder}/rows")], path)
    finally:
        remove(spark, folder)


def free(wanted: str, taken: list[str]) -> str:
    """``wanted``, made longer until no name of ``taken`` equals it in either case."""
    while wanted.lower() in {c.lower() for c in taken}:
        wanted += "_"
    return wanted


def write_json_array(df: DataFrame, path: str, order: list[str] | None = None) -> int:
    """One file with a JSON array, an object to a line, nulls and lists kept; the number of objects.

    Rows go from tasks to parts of the file: a part's lines end in separators, but for the last line
    of all, and the brackets are parts of their own, which the file system joins. Without ``order`` rows stay
    as they are dealt.
    """
    spark, folder = df.sparkSession, fresh(df.sparkSession, "json-parts")
    json_of = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")
    keyed = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    try:
        keyed.select(json_of).withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{folder}/rows")
        rows = spark.read.schema("j string, at long").parquet(f"{folder}/rows")
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last")).first()
        line = F.concat(F.lit("  "), "j", F.when(F.col("at") == F.lit(seen["last"]), "").otherwise(","))
        in_order(rows.select(line.alias("value"), "at"), "at").write.text(f"{folder}/lines")
        write_text(spark, f"{folder}/open", ["[\n" if seen["n"] else "["])
        write_text(spark, f"{folder}/close", ["]\n"])
        join_files(spark, [f"{folder}/open", *_parts(spark, f"{folder}/lines"), f"{folder}/close"], path)
    finally:
        remove(spark, folder)
    return seen["n"]


def export(spark: SparkSession, store: str, out: str) -> tuple[int, int]:
    """Rebuild CSV and JSON of both tables from the store; FileNotFoundError if there is none."""
    counts = []
    if not any(has_table(spark, f"{store}/{t}") for t in ("schools", "games")):
        raise FileNotFoundError(f"no tables at {store}")
    for table, fields, name in (("schools", SCHOOL_FIELDS, "schools"), ("games", GAME_FIELDS, "schedule")):
        df = read_table(spark, f"{store}/{table}") if has_table(spark, f"{store}/{table}") else spark.createDataFrame([], SCHOOLS if table == "schools" else GAMES)
        write_csv(df, f"{out}/{name}.csv", fields, single=True)
        cells = flat(df, fields)
        cells = cells.withColumn("sports", X.unjoined(F.col("sports"))) if "sports" in fields else cells
        counts.append(write_json_array(cells, f"{out}/{name}.json"))
    return counts[0], counts[1]


TABLES = {"schools": (SCHOOL_FIELDS, SCHOOL_KEY), "games": (GAME_FIELDS, GAME_KEY)}
