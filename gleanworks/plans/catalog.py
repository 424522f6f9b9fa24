"""Queries over the tables, each through the library's operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanworks.functions import html as H
from gleanworks.functions import names
from gleanworks.functions import text as X
from gleanworks.operators import dedup, enrich, extract, graph, match, sinks
from gleanworks.schemas import VERIFIED_COLUMN
from gleanworks.sources import connectors, tables
from gleanworks.storage import fresh, names_in
from gleanworks.streaming import finalise, upsert

Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, tuple[Query, str | None]] = {}


def _query(sql: str | None = None):
    def keep(f: Query) -> Query:
        _FOUND[f.__name__] = (f, sql)
        return f

    return keep


def queries() -> dict[str, Query]:
    return {n: f for n, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    return {n: s for n, (_, s) in _FOUND.items() if s}


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _long(c: str) -> Column:
    return F.col(c).cast("long").alias(c)


# Aggregates


@_query("""SELECT c_custkey, c_name, count(*) AS games, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS wins
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' GROUP BY c_custkey, c_name""")
def record_by_entity(spark, d):
    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "W").otherwise("L").alias("result"), F.col("o_orderpriority").alias("sport"))
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    return enrich.record_by_entity(o.join(c, "c_custkey"), "c_custkey", "c_name", "1-URGENT")


@_query("""WITH k(kind) AS (VALUES ('view'), ('click'), ('none')), n AS (SELECT kind, count(e.event_type) AS n FROM k LEFT JOIN events e ON e.event_type = kind GROUP BY kind)
SELECT kind, n, CAST(floor(sum(CASE WHEN kind <> 'none' THEN n ELSE 0 END) OVER () * 100 / greatest(sum(n) OVER (), 1)) AS BIGINT) AS matched_percent FROM n""")
def kind_counts(spark, d):
    return enrich.kind_counts(_t(spark, d, "events").select(F.col("event_type").alias("kind")), "kind", ["view", "click", "none"])


@_query("""SELECT count(*) FILTER (trim(coalesce(nullif(c_mktsegment, 'BUILDING'), c_name)) <> trim(c_name)) AS scraped,
count(*) FILTER (trim(coalesce(nullif(c_mktsegment, 'BUILDING'), c_name)) = trim(c_name)) AS fallback FROM customer""")
def fallback_counts(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_name").alias("name"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise(F.col("c_name")).alias("original_name"))
    return enrich.fallback_counts(c)


# Deduplication and upsert


@_query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def upsert_last_write(spark, d):
    return dedup.last_wins(_t(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], F.col("event_id"))


@_query("""SELECT k, event_id FROM (SELECT nullif(user_id, 13) AS k, event_id, row_number() OVER (PARTITION BY nullif(user_id, 13) ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 OR k IS NULL""")
def upsert_null_keys_kept(spark, d):
    e = _t(spark, d, "events").select(F.when(F.col("user_id") != 13, F.col("user_id")).alias("k"), "event_id")
    return dedup.last_wins(e, ["k"], F.col("event_id"))


_SEQ = "CASE WHEN user_id % 3 = 0 OR event_id % 4 = 0 THEN NULL ELSE event_id END"


@_query(f"""WITH e AS (SELECT user_id, {_SEQ} AS seq, min(event_id) AS n FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC NULLS LAST) AS rn FROM e) SELECT user_id, seq FROM r WHERE rn = 1""")
def upsert_null_order(spark, d):
    known = (F.col("user_id") % 3 != 0) & (F.col("event_id") % 4 != 0)
    rows = _t(spark, d, "events").select("user_id", F.when(known, F.col("event_id")).alias("seq"), (F.col("event_id") % 2).alias("half"))
    path = f"{fresh(spark, 'store')}/table"
    for half in (1, 0):
        sinks.upsert_table(rows.where(F.col("half") == half).drop("half"), path, ["user_id"], "seq")
    return sinks.read_table(spark, path)


@_query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1")
def emit_once_first(spark, d):
    return dedup.first_wins(_t(spark, d, "events").select("user_id", "event_id"), ["user_id"], F.col("event_id"))


@_query("""WITH s AS (SELECT user_id, event_id, dense_rank() OVER (ORDER BY event_type) AS slice_no FROM events),
l AS (SELECT user_id, slice_no, max(event_id) AS event_id FROM s GROUP BY ALL)
SELECT user_id, arg_min(event_id, slice_no) AS event_id, min(slice_no) AS slice_no FROM l GROUP BY user_id""")
def slice_first_wins(spark, d):
    e = _t(spark, d, "events")
    no = F.row_number().over(Window.orderBy(F.col("event_type").asc_nulls_last())).cast("long").alias("slice_no")
    kinds = e.select("event_type").distinct().select(F.col("event_type").alias("kind"), no)
    return dedup.merge_slices(e.join(kinds, F.col("event_type").eqNullSafe(F.col("kind"))).select("user_id", "event_id", "slice_no"), "user_id", "slice_no", "event_id")


@_query("""SELECT k, min(src) AS src FROM (SELECT s_nationkey AS k, CAST(0 AS BIGINT) AS src FROM supplier UNION ALL SELECT c_nationkey, 1 FROM customer
UNION ALL SELECT n_nationkey, 2 FROM nation) GROUP BY k""")
def union_sources(spark, d):
    src = lambda t, c, n: _t(spark, d, t).select(F.col(c).alias("k"), F.lit(n).cast("long").alias("src"))
    u = src("supplier", "s_nationkey", 0).unionByName(src("customer", "c_nationkey", 1)).unionByName(src("nation", "n_nationkey", 2))
    return dedup.first_wins(u, ["k"], F.col("src"))


@_query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'")
def changed_rows(spark, d):
    o = _t(spark, d, "orders")
    of = lambda p: o.where(F.col("o_orderpriority") == p).select("o_custkey").distinct()
    return dedup.changed(of("5-LOW"), of("1-URGENT"))


# Joins


@_query("SELECT c_custkey, c_nationkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def anti_unserved(spark, d):
    o = _t(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return dedup.unseen(_t(spark, d, "customer").select("c_custkey", "c_nationkey"), o, "c_custkey")


@_query("SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AND s_suppkey % 4 <> 0")
def scope_semi(spark, d):
    codes = [f"n{r.n_nationkey}" for r in _t(spark, d, "nation").where("n_regionkey = 1").collect()]  # some of 25 rows
    tail = F.when(F.col("s_suppkey") % 4 == 0, "/city/").otherwise("/city/school/x")  # two segments are too few
    url = F.concat(F.lit("https://x.org/N"), F.col("s_nationkey").cast("string"), tail)
    return _t(spark, d, "supplier").where(X.in_scope(url, "https://x.org", codes)).select("s_suppkey", "s_nationkey")


@_query("""WITH RECURSIVE e AS (SELECT DISTINCT a.l_suppkey AS src, b.l_suppkey AS dst FROM lineitem a JOIN lineitem b USING (l_orderkey)
JOIN supplier ON s_suppkey = b.l_suppkey WHERE a.l_suppkey <> b.l_suppkey AND s_nationkey < 5),
r AS (SELECT CAST(1 AS BIGINT) AS id UNION SELECT e.dst FROM r JOIN e ON e.src = r.id) SELECT id FROM r""")
def graph_reach(spark, d):
    l = _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    inside = _t(spark, d, "supplier").where("s_nationkey < 5").select(F.col("s_suppkey").alias("dst"))
    e = l.withColumnRenamed("l_suppkey", "src").join(l.withColumnRenamed("l_suppkey", "dst"), "l_orderkey").where("src <> dst")
    e = e.select("src", "dst").distinct().join(inside, "dst", "left_semi").withColumn("via", F.lit("nearby"))
    seeds = spark.createDataFrame([(1, "directory:x")], "id long, via string")
    return graph.expand(seeds, e).select("id")


@_query("""WITH RECURSIVE c AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer),
e AS (SELECT k AS src, unnest([2 * k + n % 2, 3 * k, k + 1000]) AS dst FROM c),
s AS (SELECT e.* FROM e SEMI JOIN c ON c.k = e.dst),
r AS (SELECT CAST(1 AS BIGINT) AS id, 0 AS depth UNION SELECT s.dst, r.depth + 1 FROM r JOIN s ON s.src = r.id)
SELECT id, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY id""")
def frontier_resume(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    e = c.select(k.alias("src"), F.explode(F.array(2 * k + F.col("c_nationkey") % 2, 3 * k, k + 1000)).alias("dst")).withColumn("via", F.lit("nearby"))
    e = e.join(c.select(k.alias("dst")), "dst", "left_semi")
    seeds, path = spark.createDataFrame([(1, "directory:x")], "id long, via string"), fresh(spark, "frontier")
    graph.expand(seeds, e, store=path, stop_after=2, bloom_from=0)  # two rounds, then a call that takes it up
    return graph.expand(seeds, e, store=path, bloom_from=0).select("id", "depth")


def _parts(spark, d, parity):
    p = _t(spark, d, "part").where(F.col("p_partkey") % 2 == parity)
    return p.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_brand").alias("state"), F.col("p_type").alias("city"))


_ROWS = "r AS (SELECT p_partkey AS key, p_name AS name, p_brand AS st, lower(trim(p_type)) AS city FROM part WHERE p_partkey % 2 = 1), c AS (SELECT p_partkey AS id, p_name AS name, p_brand AS st, lower(trim(p_type)) AS city FROM part WHERE p_partkey % 2 = 0)"


def _ticket_rows(spark, d):
    rows, cat = _parts(spark, d, 1), _parts(spark, d, 0)
    return rows, cat.select(F.col("key").alias("pos"), F.col("key").alias("id"), "name", "state"), cat.select(F.col("key").alias("id"), "city", F.lit("").alias("zip_code"))


@_query(f"""WITH {_ROWS} SELECT r.key, CAST(min(c.id) FILTER (left(r.city, 4) = left(c.city, 4)) AS VARCHAR) AS match_id FROM r LEFT JOIN c ON r.st = c.st AND r.name = c.name GROUP BY r.key""")
def exact_blocked(spark, d):
    m = match.match_tickets(*_ticket_rows(spark, d))
    return m.select("key", F.when(F.col("match_kind") == "exact", F.col("match_id")).alias("match_id"))


@_query(f"""WITH {_ROWS}, x AS (SELECT r.key, r.city, c.id, c.city AS cc, list_distinct(string_split(lower(r.name), ' ')) AS a, list_distinct(string_split(lower(c.name || ' annex'), ' ')) AS b
  FROM r JOIN c ON r.st = c.st),
s AS (SELECT key, id, row_number() OVER (PARTITION BY key ORDER BY abs(len(a) - len(b)), id) AS rn FROM x WHERE (list_has_all(a, b) OR list_has_all(b, a)) AND left(city, 4) = left(cc, 4))
SELECT key, CAST(id AS VARCHAR) AS match_id FROM s WHERE rn = 1""")
def subset_blocked(spark, d):
    rows, cat, detail = _ticket_rows(spark, d)
    cat = cat.withColumn("name", F.concat("name", F.lit(" annex")))
    m = match.match_tickets(rows, cat, detail, cutoff=1.0)  # a cut-off of 1 leaves the fuzzy tier empty
    return m.where("match_kind = 'fuzzy'").select("key", "match_id")


# The last tier's blocks: b is the longest block of a window as 1000 * size + 999 - place, so that the first of the longest is the greatest.
def _tiers_sql(cutoff: float) -> str:
    return f"""WITH RECURSIVE {_ROWS}, rn AS (SELECT *, lower(name) AS n, list_distinct(string_split(lower(name), ' ')) AS w FROM r),
cn AS (SELECT *, lower(name) AS n, list_distinct(string_split(lower(name), ' ')) AS w FROM c),
x AS (SELECT rn.key, min(cn.id) FILTER (left(rn.city, 4) = left(cn.city, 4)) AS id FROM rn JOIN cn ON rn.st = cn.st AND rn.n = cn.n GROUP BY rn.key),
s AS (SELECT rn.key, arg_min(cn.id, (abs(len(rn.w) - len(cn.w)), cn.id)) AS id FROM rn ANTI JOIN x USING (key) JOIN cn ON rn.st = cn.st
  WHERE (list_has_all(rn.w, cn.w) OR list_has_all(cn.w, rn.w)) AND left(rn.city, 4) = left(cn.city, 4) GROUP BY rn.key),
o AS (SELECT rn.* FROM rn ANTI JOIN x USING (key) ANTI JOIN s USING (key)),
p AS (SELECT DISTINCT o.st, o.n, cn.n AS c FROM o JOIN cn ON o.st = cn.st WHERE 2.0 * least(length(o.n), length(cn.n)) / (length(o.n) + length(cn.n)) >= {cutoff}),
v AS (SELECT st, n, c, 0 AS al, length(c) AS ah, 0 AS bl, length(n) AS bh, 0 AS k FROM p
  UNION ALL SELECT st, n, c, CASE WHEN side THEN al ELSE i + k END, CASE WHEN side THEN i ELSE ah END, CASE WHEN side THEN bl ELSE j + k END, CASE WHEN side THEN j ELSE bh END, CASE WHEN side THEN k ELSE 0 END
  FROM (SELECT *, bl + instr(substr(n, bl + 1, bh - bl), substr(c, i + 1, k)) - 1 AS j FROM (
    SELECT st, n, c, al, ah, bl, bh, CAST(b // 1000 AS INTEGER) AS k, CAST(999 - b % 1000 AS INTEGER) AS i FROM (
      SELECT st, n, c, al, ah, bl, bh, list_max(list_transform(range(al, ah), lambda i: 999 - i + 1000 * list_max(list_filter(range(0, ah - i + 1), lambda m: contains(substr(n, bl + 1, bh - bl), substr(c, CAST(i AS INTEGER) + 1, CAST(m AS INTEGER))))))) AS b
      FROM v WHERE al < ah AND bl < bh) WHERE b >= 1000)), (VALUES (true), (false)) AS sides(side)),
m AS (SELECT st, n, c, 2.0::DOUBLE * sum(k) / (length(n) + length(c)) AS ratio FROM v GROUP BY st, n, c),
t AS (SELECT st, n, arg_max(c, (ratio, c)) AS c FROM m WHERE ratio >= {cutoff} GROUP BY st, n),
f AS (SELECT o.key, o.city, min(cn.id) AS id FROM o JOIN t ON o.st = t.st AND o.n = t.n JOIN cn ON cn.st = t.st AND cn.n = t.c GROUP BY o.key, o.city),
g AS (SELECT key, id, 'exact' AS kind FROM x WHERE id IS NOT NULL UNION ALL SELECT key, id, 'fuzzy' FROM s
  UNION ALL SELECT f.key, f.id, 'fuzzy' FROM f JOIN cn ON cn.id = f.id WHERE left(f.city, 4) = left(cn.city, 4))
SELECT r.key, CAST(g.id AS VARCHAR) AS match_id, coalesce(g.kind, 'none') AS match_kind FROM r LEFT JOIN g USING (key)"""


@_query(_tiers_sql(0.87))
def fuzzy_match(spark, d):
    return match.match_tickets(*_ticket_rows(spark, d)).select("key", "match_id", "match_kind")


@_query(_tiers_sql(0.7))
def fuzzy_rivals(spark, d):
    """As ``fuzzy_match``, at a cut-off that many names of a state reach."""
    return match.match_tickets(*_ticket_rows(spark, d), cutoff=0.7).select("key", "match_id", "match_kind")


@_query(f"""WITH {_ROWS}, e AS (SELECT r.key, count(*) AS n, min(c.id) AS first, min(c.id) FILTER (left(r.city, 4) = left(c.city, 4)) AS ok FROM r JOIN c ON r.st = c.st AND r.name = c.name GROUP BY r.key)
SELECT key, CAST(CASE WHEN n = 1 THEN first ELSE coalesce(ok, first) END AS VARCHAR) AS match_id FROM e""")
def network_exact(spark, d):
    cat = _parts(spark, d, 0).select(F.col("key").alias("pos"), F.col("key").cast("string").alias("slug"), "name", "city", F.col("state").alias("state_code"), F.lit(None).cast("string").alias("gofan_id"))
    return match.match_network(_parts(spark, d, 1), cat).where("match_kind = 'exact'").select("key", "match_id")


@_query("""WITH c AS (SELECT p_partkey // 4 AS gid, min(p_partkey) AS slug FROM part WHERE p_partkey % 2 = 0 GROUP BY 1)
SELECT p_partkey AS key, CAST(slug AS VARCHAR) AS match_id FROM part JOIN c ON gid = p_partkey WHERE p_partkey % 2 = 1""")
def key_join_first(spark, d):
    cat = _parts(spark, d, 0).select(F.col("key").alias("pos"), F.col("key").cast("string").alias("slug"), F.lit("").alias("name"), "city", F.lit("").alias("state_code"), F.floor(F.col("key") / 4).cast("string").alias("gofan_id"))
    rows = _parts(spark, d, 1).withColumn("gofan_school_id", F.concat(F.lit(" "), F.col("key").cast("string")))
    return match.match_network(rows, cat).where("match_kind = 'gofan_id'").select("key", "match_id")


@_query(f"""WITH {_ROWS}, o AS (SELECT r.key, CASE WHEN r.key % 3 = 0 THEN 'no such thing' ELSE r.name END AS own, r.* EXCLUDE (key) FROM r),
m AS (SELECT o.key, min(c.id) FILTER (left(o.city, 4) = left(c.city, 4)) AS id FROM o JOIN c ON c.st = o.st AND c.name = o.name GROUP BY o.key)
SELECT key, CAST(id AS VARCHAR) AS match_id, CASE WHEN key % 3 = 0 THEN 'name' ELSE 'original' END AS match_source FROM m WHERE id IS NOT NULL""")
def two_attempt_match(spark, d):
    rows, cat, detail = _ticket_rows(spark, d)
    rows = rows.withColumn("original_name", F.when(F.col("key") % 3 == 0, "no such thing").otherwise(F.col("name")))
    return match.match_twice(rows, cat, detail).where("match_kind = 'exact'").select("key", "match_id", "match_source")


# Scalar functions


@_query(r"""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9 ]', ' ', 'g'), '\b(widget|plate)\b', ' ', 'g'), '\s+', ' ', 'g')) AS norm FROM part""")
def normalize_names(spark, d):
    return _t(spark, d, "part").select("p_partkey", X.normalize_name(F.col("p_name"), r"\b(widget|plate)\b").alias("norm"))


_INFO = "'W ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' - ' || CAST(l_linenumber AS VARCHAR)"


@_query(rf"""SELECT l_orderkey, l_linenumber, regexp_extract({_INFO}, '^\s*([WLT])\b', 1) AS result,
replace(regexp_extract({_INFO}, '\b(\d{{1,3}}\s*-\s*\d{{1,3}})\b', 1), ' ', '') AS score FROM lineitem""")
def parse_result_score(spark, d):
    info = F.concat(F.lit("W "), F.col("l_quantity").cast("long").cast("string"), F.lit(" - "), F.col("l_linenumber").cast("string"))
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.result_of(info).alias("result"), X.score_of(info).alias("score"))


_OPP = "CASE o_orderkey % 3 WHEN 0 THEN '@' WHEN 1 THEN 'vs ' ELSE '' END || o_orderpriority || CASE WHEN o_orderkey % 2 = 0 THEN '**' ELSE '' END"


@_query(rf"""SELECT o_orderkey, CASE WHEN starts_with({_OPP}, '@') THEN 'away' ELSE 'home' END AS home_away,
trim(regexp_replace(regexp_replace(trim(regexp_replace({_OPP}, '^@+', '')), '^(?i)vs ', ''), '\*+$', '')) AS opponent FROM orders""")
def opponent_clean(spark, d):
    k = F.col("o_orderkey") % 3
    raw = F.concat(F.when(k == 0, "@").when(k == 1, "vs ").otherwise(""), "o_orderpriority", F.when(F.col("o_orderkey") % 2 == 0, "**").otherwise(""))
    return _t(spark, d, "orders").select("o_orderkey", X.home_away(raw).alias("home_away"), X.clean_opponent(raw).alias("opponent"))


@_query("SELECT o_orderkey, trim(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END || ' ' || CAST(year(o_orderdate) AS VARCHAR)) AS season FROM orders")
def season_label(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", X.season_label(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")), F.year("o_orderdate").cast("string")).alias("season"))


@_query("""SELECT page_id, regexp_replace(url, '/+$', '') || CASE WHEN regexp_replace(url, '/+$', '') LIKE '%/schedule' THEN '/' ELSE '/schedule/' END AS schedule_url FROM pages""")
def schedule_url(spark, d):
    return _t(spark, d, "pages").select("page_id", X.schedule_url(F.col("url")).alias("schedule_url"))


@_query("""WITH p AS (SELECT page_id, string_split(regexp_replace(url, '^/+|/+$', '', 'g'), '/') AS s FROM pages)
SELECT page_id, CAST(len(s) AS BIGINT) AS depth, s[1] AS head, CASE WHEN len(s) >= 3 THEN '/' || array_to_string(s[1:3], '/') || '/' END AS root FROM p""")
def path_root(spark, d):
    parts = X.path_parts(F.col("url"), "\x00")
    return _t(spark, d, "pages").select("page_id", F.size(parts).cast("long").alias("depth"), parts[0].alias("head"), F.regexp_replace(X.school_root(F.col("url"), "\x00"), "^\x00", "").alias("root"))


@_query("""SELECT o_custkey, string_agg(DISTINCT o_orderpriority || ' (' || o_orderstatus || ')', '; ' ORDER BY o_orderpriority || ' (' || o_orderstatus || ')') AS sports,
count(DISTINCT o_orderpriority || o_orderstatus) AS sports_count FROM orders GROUP BY o_custkey""")
def distinct_labels(spark, d):
    s = F.collect_set(F.struct(F.col("o_orderpriority").alias("sport"), F.col("o_orderstatus").alias("gender")))
    labels = _t(spark, d, "orders").groupBy("o_custkey").agg(s.alias("s")).select("o_custkey", X.sport_labels(F.col("s")).alias("sports"))
    return labels.select("o_custkey", X.joined(F.col("sports")).alias("sports"), F.size("sports").cast("long").alias("sports_count"))


@_query("SELECT o_custkey, bool_or(lower(trim(split_part(o_orderpriority || ' (x)', ' (', 1))) = '1-urgent') AS offered FROM orders GROUP BY o_custkey")
def school_offers(spark, d):
    s = _t(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set(F.concat("o_orderpriority", F.lit(" (x)"))).alias("s"))
    return s.select("o_custkey", X.offers(F.col("s"), ["1-URGENT "]).alias("offered"))


@_query("SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN NULL ELSE c_name END, ''), c_mktsegment) AS first FROM customer")
def truthy_or(spark, d):
    k = F.col("c_custkey") % 3
    return _t(spark, d, "customer").select("c_custkey", X.first_truthy(F.when(k == 0, "").when(k == 2, F.col("c_name")), F.col("c_mktsegment")).alias("first"))


@_query("SELECT doc_id, regexp_matches(lower(text), 'error|slot|casino|poker|judi|not found|forbidden') AS junk FROM (SELECT doc_id, 'page ' || source || CASE doc_id % 3 WHEN 0 THEN ' Terrorer' WHEN 1 THEN ' Slots here' ELSE ' fine' END AS text FROM documents)")
def junk_filter(spark, d):
    k = F.col("doc_id") % 3
    t = F.concat(F.lit("page "), "source", F.when(k == 0, " Terrorer").when(k == 1, " Slots here").otherwise(" fine"))
    return _t(spark, d, "documents").select("doc_id", X.is_junk(t).alias("junk"))


@_query("""SELECT a.c_custkey AS a, b.c_custkey AS b, CASE WHEN a.c_custkey % 5 = 0 OR b.c_custkey % 7 = 0 THEN true ELSE left(a.c_mktsegment, 4) = left(b.c_mktsegment, 4) END AS agrees
FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1""")
def agree_matrix(spark, d):
    c = _t(spark, d, "customer")
    a = c.select(F.col("c_custkey").alias("a"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("ca"))
    b = c.select(F.col("c_custkey").alias("b"), (F.col("c_custkey") - 1).alias("a"), F.when(F.col("c_custkey") % 7 != 0, F.upper("c_mktsegment")).alias("cb"))
    no = F.lit("")
    return a.join(b, "a").select("a", "b", X.agrees(F.col("cb"), no, F.col("ca"), no, F.lit(False)).alias("agrees"))


@_query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN trim(c_name) ELSE c_mktsegment END AS original_name FROM customer")
def fallback_name(spark, d):
    c = _t(spark, d, "customer")
    return c.select("c_custkey", X.first_truthy(F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")), X.strip(F.col("c_name"))).alias("original_name"))


@_query("SELECT c_custkey, c_mktsegment || '!' AS c_name FROM customer")
def column_append_idempotent(spark, d):
    cols = {"c_name": F.concat("c_mktsegment", F.lit("!"))}
    return enrich.append(enrich.append(_t(spark, d, "customer"), cols), cols).select("c_custkey", "c_name")


# Pages


@_query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<h1[^>]*>([^<]*)', 1) AS h1 FROM (SELECT page_id, replace(replace(html, '&amp;', '+'), '&', '+') AS html FROM pages)")
def page_title_h1(spark, d):
    t = _t(spark, d, "pages").select("page_id", H.titles(F.replace(F.replace("html", F.lit("&amp;"), F.lit("+")), F.lit("&"), F.lit("+"))).alias("t"))
    return t.select("page_id", X.nz(F.col("t.title")).alias("title"), X.nz(F.col("t.h1")).alias("h1"))


@_query(r"SELECT page_id, regexp_extract(html, '(?s)<script[^>]*>(.*?)</script>', 1) AS script FROM pages")
def embedded_script(spark, d):
    marked = F.regexp_replace("html", "<script", '<script id="__NEXT_DATA__" x="y"')
    return _t(spark, d, "pages").select("page_id", H.embedded(marked).alias("script"))


@_query("SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN json_extract_string(props, '$.k') END AS k FROM events")
def json_field(spark, d):
    body = F.concat(F.lit('{"props":{"pageProps":{"schoolContext":{"schoolId":'), F.coalesce(F.get_json_object("props", "$.k"), F.lit("null")), F.when(F.col("event_id") % 7 == 0, "").otherwise("}}}}"))
    pages = _t(spark, d, "events").select("event_id", F.concat(F.lit('<p><script id="__NEXT_DATA__" type="application/json">'), body, F.lit("</script>")).alias("html"))
    return extract.with_props(pages).select("event_id", F.col("props.schoolContext.schoolId").alias("k"))


@_query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_shipmode FROM (SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS l_shipmode FROM lineitem)),
i AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipmode) - 1 AS game_index FROM l)
SELECT l_orderkey, CAST(game_index AS INTEGER) AS game_index, CAST(l_linenumber AS VARCHAR) AS date, 'to ' || l_shipmode AS opponent, '/s/' || l_shipmode AS href FROM i WHERE l_linenumber % 3 <> 0""")
def schedule_rows(spark, d):
    # Lines travel as a number and two letters; their rows are written where their page is.
    lines = F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.concat("l_returnflag", "l_linestatus").alias("flags"))))

    def row(x: Column) -> Column:
        cells = F.when(x["n"] % 3 == 0, "").otherwise(F.concat(F.lit('<td> <a href="/s/'), x["flags"], F.lit('">to <b>'), x["flags"], F.lit("</b></a></td>")))
        return F.concat(F.lit("<tr><td>"), x["n"].cast("string"), F.lit("</td>"), cells, F.lit("</tr>"))

    pages = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(lines.alias("lines")).select("l_orderkey", F.array_join(F.transform("lines", row), "").alias("b"))
    html = F.concat(F.lit("<table><tr><td>none</table><div><table><tr><th>Date<th>Opponent</tr><tbody>"), "b", F.lit("</tbody></table></div>"))
    first = pages.select("l_orderkey", F.explode(H.schedule_table(html)["rows"]).alias("r"))
    # The heading's row has no cell, and so no place.
    return first.select("l_orderkey", F.col("r.game_index").alias("game_index"), F.col("r.cells")[0].alias("date"), F.col("r.cells")[1].alias("opponent"), F.col("r.opp_href").alias("href"))


@_query("""WITH g AS (SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS f,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag || l_linestatus) - 1 AS INTEGER) AS game_index FROM lineitem)
SELECT l_orderkey, game_index, CAST(l_linenumber AS VARCHAR) AS date, 'to ' || f AS opponent, '/s/' || f AS href FROM g WHERE l_linenumber % 3 <> 0""")
def schedule_rows_sql(spark, d):
    names.register(spark)
    return spark.sql(
        """WITH l AS (SELECT l_orderkey, l_linenumber, concat(l_returnflag, l_linestatus) AS f FROM {lineitem}),
        r AS (SELECT l_orderkey, l_linenumber, concat('<tr><td>', l_linenumber, '</td>', CASE WHEN l_linenumber % 3 <> 0 THEN concat('<td> <a href="/s/', f, '">to <b>', f, '</b></a></td>') ELSE '' END, '</tr>') AS tr FROM l),
        p AS (SELECT l_orderkey, concat('<table><tr><th>Date<th>Opponent</tr><tbody>', array_join(transform(array_sort(collect_list(struct(l_linenumber, tr))), x -> x.tr), ''), '</tbody></table>') AS html FROM r GROUP BY l_orderkey)
        SELECT p.l_orderkey, t.game_index, t.date, t.opponent, t.opp_href AS href FROM p, LATERAL schedule_table(p.html, 'date, opponent') AS t""",
        lineitem=_t(spark, d, "lineitem"),
    )


_JUNK_SQL = "|".join("".join("\\" + x if x in "()." else "''" if x == "'" else x for x in part) for part in X.JUNK)
_TITLE = "CASE page_id % 3 WHEN 0 THEN 'Home | ' WHEN 1 THEN 'Error 404 - page not found: try again later - ' ELSE '' END || replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp;', '+'), '&', '+')"


@_query(rf"""WITH t AS (SELECT page_id, regexp_replace(trim(regexp_replace({_TITLE}, '\s+', ' ', 'g')), '(?i)^(home|welcome(\s+to)?)\b[\s:|\-–—]*', '') AS t FROM pages),
s AS (SELECT page_id, unnest(string_split_regex(t, '\s*[|\-–—•»·:]\s*')) AS x, generate_subscripts(string_split_regex(t, '\s*[|\-–—•»·:]\s*'), 1) AS i FROM t),
j AS (SELECT page_id, trim(x) AS x, i, regexp_matches(lower(trim(x)), '{_JUNK_SQL}') OR regexp_matches(lower(trim(x)), '^(https?://)?[\w-]+(\.[\w-]+)+(/\S*)?$') AS junk FROM s WHERE trim(x) <> '')
SELECT page_id, x AS name FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY junk, length(x) DESC, i) AS rn FROM j) WHERE rn = 1""")
def title_longest_segment(spark, d):
    title = H.titles(F.replace(F.replace("html", F.lit("&amp;"), F.lit("+")), F.lit("&"), F.lit("+")))["title"]
    k = F.col("page_id") % 3
    lead = F.when(k == 0, "Home | ").when(k == 1, "Error 404 - page not found: try again later - ").otherwise("")
    named = _t(spark, d, "pages").select("page_id", F.concat(lead, title).alias("t"))
    return named.select("page_id", X.clean_title(F.col("t")).alias("name"))


@_query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_tumbling(spark, d):
    return upsert.tumbling_counts(_t(spark, d, "events")).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


_SIZE_INFO = "CASE p_size % 4 WHEN 0 THEN ' W ' WHEN 1 THEN 'L' WHEN 2 THEN 'Tie ' ELSE 'T ' END || p_size || ' - 7'"


@_query(rf"""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(p_name || ' High School'), '[^a-z0-9 ]', ' ', 'g'), '\b(high\s+school|high|hs|school)\b', ' ', 'g'), '\s+', ' ', 'g')) AS norm,
regexp_extract({_SIZE_INFO}, '^\s*([WLT])\b', 1) AS result, replace(regexp_extract({_SIZE_INFO}, '\b(\d{{1,3}}\s*-\s*\d{{1,3}})\b', 1), ' ', '') AS score,
CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'the longest of all of them' END AS title FROM part""")
def names_in_sql(spark, d):
    names.register(spark)
    return spark.sql(
        """WITH p AS (SELECT *, concat(CASE p_size % 4 WHEN 0 THEN ' W ' WHEN 1 THEN 'L' WHEN 2 THEN 'Tie ' ELSE 'T ' END, p_size, ' - 7') AS info,
          concat('Home | ', p_brand, CASE WHEN p_partkey % 2 = 0 THEN ': page not found on this server' ELSE ' - the longest of all of them' END) AS title FROM {part})
        SELECT p_partkey, normalize_name(concat(p_name, ' High School')) AS norm, result_of(info) AS result, score_of(info) AS score, clean_title(title) AS title FROM p""",
        part=_t(spark, d, "part"),
    )


# Fuzzy tiers: a name with a letter more is nearest to itself, which SQL can say.



def _apart(name: str) -> Column:
    """The name with a digest of it, so that different names are not similar."""
    return F.concat(name, F.lit(" "), F.md5(F.col(name).cast("binary")))


_NEAREST = "n AS (SELECT r.key, r.city, min(c.id) AS id FROM r JOIN c ON r.st = c.st AND r.name = c.name GROUP BY r.key, r.city)"


@_query(f"""WITH {_ROWS}, {_NEAREST} SELECT n.key, CAST(n.id AS VARCHAR) AS match_id FROM n JOIN c ON c.id = n.id WHERE left(n.city, 4) = left(c.city, 4)""")
def fuzzy_suffix(spark, d):
    rows, cat, detail = _ticket_rows(spark, d)
    cat = cat.withColumn("name", F.concat(_apart("name"), F.lit("x")))
    return match.match_tickets(rows.withColumn("name", _apart("name")), cat, detail).where("match_kind = 'fuzzy'").select("key", "match_id")


@_query(f"""WITH {_ROWS}, {_NEAREST} SELECT n.key, CAST(n.id AS VARCHAR) AS match_id FROM n JOIN c ON c.id = n.id WHERE left(n.city, 4) = left(c.city, 4) OR n.key % 5 = 0""")
def network_fuzzy(spark, d):
    cat = _parts(spark, d, 0).select(F.col("key").alias("pos"), F.col("key").cast("string").alias("slug"), F.concat(_apart("name"), F.lit("x")).alias("name"), "city", F.col("state").alias("state_code"), F.lit("").alias("gofan_id"))
    rows = _parts(spark, d, 1).withColumn("name", _apart("name")).withColumn("city", F.when(F.col("key") % 5 != 0, F.col("city")))
    return match.match_network(rows, cat).where("match_kind = 'fuzzy'").select("key", "match_id")


@_query("""SELECT count(*) FILTER (o_orderkey % 3 = 0) AS matched_original, count(*) FILTER (o_orderkey % 3 = 1) AS matched_name,
count(*) FILTER (o_orderkey % 3 < 2 AND o_orderstatus = 'F') AS verified FROM orders""")
def source_counts(spark, d):
    k = F.col("o_orderkey") % 3
    rows = _t(spark, d, "orders").select(F.when(k == 0, "original").when(k == 1, "name").alias("match_source"), F.when((k < 2) & (F.col("o_orderstatus") == "F"), "url").otherwise("").alias(VERIFIED_COLUMN))
    return enrich.source_counts(rows)


# Sinks and streams


_CELL = "c_name || ', \"' || c_mktsegment || '\"' || chr(10) || 'ü'"


@_query(f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, {_CELL} AS c_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def csv_round_trip(spark, d):
    c = _t(spark, d, "customer")
    cell = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nü'))
    path = fresh(spark, "csv")
    sinks.write_csv(c.select("c_custkey", cell.alias("c_name"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("c_mktsegment")), path, ["c_custkey", "c_name", "c_mktsegment"])
    return tables.read_csv(spark, path)


def _customers_csv(spark, d):
    """A CSV file of the customers in the order of their keys."""
    path = f"{fresh(spark, 'csv')}/customers.csv"
    c = _t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    sinks.write_csv_file(c, path, c.columns, "c_custkey")
    return path


@_query("""SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS place, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
CASE WHEN n_regionkey <> 2 THEN n_name ELSE '' END AS nation FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def rewrite_in_order(spark, d):
    from gleanworks import cli  # which imports the plans

    path = _customers_csv(spark, d)
    nations = _t(spark, d, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").cast("string").alias("c_nationkey"), F.col("n_name").alias("nation"))
    cli.enrich_csv(spark, path, lambda rows: rows.join(nations.hint("merge"), "c_nationkey", "left"))
    return tables.read_csv(spark, path, "place")


@_query("""WITH r AS (SELECT row_number() OVER (ORDER BY c_custkey DESC) AS n, count(*) OVER () AS total,
'  {"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || CASE WHEN c_custkey % 5 = 0 THEN 'null' ELSE CAST(c_nationkey AS VARCHAR) END || '}' AS j FROM customer)
SELECT n AS line, j || CASE WHEN n < total THEN ',' ELSE '' END AS text FROM r UNION ALL SELECT 0, '[' UNION ALL SELECT count(*) + 1, ']' FROM customer""")
def json_array_lines(spark, d):
    path = f"{fresh(spark, 'json')}/customers.json"
    c = _t(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("c_nationkey"), (-F.col("c_custkey")).alias("at"))
    sinks.write_json_array(c.repartition(7).sortWithinPartitions("at").drop("at"), path, [F.col("c_custkey").desc()])
    lines = spark.read.text(path, wholetext=True)  # one file, to number its lines
    return lines.select(F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("line", "text")).select(F.col("line").cast("long").alias("line"), "text")


# Catalogs of services, from pages recorded by Spark


def _recorded_slices(spark, d):
    """(address, steps): the customers as a catalog of 25 states, in pages of 500 as a service would give them."""
    codes = [c.upper() for c in tables.STATES][:25]
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), F.col("c_nationkey") + 1)
    slug = F.when(F.col("c_custkey") % 11 != 0, F.concat(F.lit("c"), F.col("c_custkey").cast("string")))
    rows = _t(spark, d, "customer").select("c_custkey", slug.alias("slug"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city"), code.alias("state_code"), F.col("c_nationkey").alias("gofan_id"))
    rows = rows.withColumn("step", F.explode(F.array(F.lit(""), "state_code")))
    part = Window.partitionBy("step")
    rows = rows.withColumn("n", F.row_number().over(part.orderBy("c_custkey")) - 1).withColumn("total", F.count(F.lit(1)).over(part))  # a catalog: as much as a service holds
    item = F.struct("n", "slug", "name", "city", "state_code", "gofan_id")
    pages = rows.groupBy(F.concat(F.lit("of-"), "step").alias("state"), (F.floor(F.col("n") / 500) * 500).alias("start")).agg(F.max("total").alias("total"), F.array_sort(F.collect_list(item)).alias("items"))
    path = fresh(spark, "recorded")
    pages.select("state", "start", F.to_json(F.struct("total", "items")).alias("value")).write.partitionBy("state", "start").text(path)
    return f"{path}/state=of-{{state}}/start={{start}}", ["__full__", *codes]


_SLICES = """c AS (SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN 'c' || c_custkey END AS slug, c_name AS name, c_mktsegment AS city,
  (['AL','AK','AZ','AR','CA','CO','CT','DE','DC','FL','GA','HI','ID','IL','IN','IA','KS','KY','LA','ME','MD','MA','MI','MN','MS'])[c_nationkey + 1] AS state_code, c_nationkey FROM customer),
a AS (SELECT *, 0 AS slice_no, '__full__' AS step, row_number() OVER (ORDER BY c_custkey) AS n FROM c
  UNION ALL SELECT *, c_nationkey + 1, state_code, row_number() OVER (PARTITION BY state_code ORDER BY c_custkey) FROM c),
s AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY n) - 1 AS "at" FROM a WHERE n <= 10000 AND slug IS NOT NULL)"""


@_query(f"""WITH {_SLICES} SELECT CAST(slice_no AS INTEGER) AS slice_no, step, "at", slug, name, city, state_code, CAST(c_nationkey AS VARCHAR) AS gofan_id FROM s WHERE state_code IN ('CA', 'DE')""")
def catalog_states(spark, d):
    address, steps = _recorded_slices(spark, d)
    connectors.register(spark)
    source = spark.read.format("network_catalog").options(address=address, steps=",".join(steps), pause=0).load()
    return source.where("state_code in ('CA', 'DE')")


@_query(f"""WITH {_SLICES}, r AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY slice_no) AS rn FROM s)
SELECT slug, name, city, state_code, CAST(c_nationkey AS VARCHAR) AS gofan_id, CAST(slice_no AS BIGINT) * 1099511627776 + "at" AS pos FROM r WHERE rn = 1""")
def catalog_merged(spark, d):
    address, steps = _recorded_slices(spark, d)
    found, complete = connectors.network_catalog(spark, address, fresh(spark, "network"), steps, pause=0)
    if not complete:
        raise RuntimeError("a slice could not be read")
    return found


def _event_stream(spark, d):
    events = _t(spark, d, "events")
    return spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(d)


@_query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def stream_upsert(spark, d):
    path = fresh(spark, "stream")
    rows = _event_stream(spark, d).select("user_id", "event_id", "event_type")
    upsert.stream_upsert(rows, f"{path}/table", f"{path}/checkpoint", ["user_id"], "event_id").awaitTermination()
    return sinks.read_table(spark, f"{path}/table")


@_query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events WHERE user_id IS NOT NULL) WHERE rn = 1")
def stream_first(spark, d):
    path = fresh(spark, "stream")
    events = _t(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    for k in range(4):  # files whose order of arrival is not that of the events
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k).write.mode("append").parquet(f"{path}/in")
    # Two files at a time; of many, a quarter, so that batches don't grow in number with the table.
    files = sum(n.endswith(".parquet") for n in names_in(spark, f"{path}/in"))
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", max(2, -(-files // 4))).parquet(f"{path}/in")
    upsert.stream_first(rows, f"{path}/table", f"{path}/checkpoint", ["user_id"], "event_id").awaitTermination()
    return sinks.read_table(spark, f"{path}/table")


@_query("""WITH k(kind) AS (VALUES ('view'), ('click'), ('other')) SELECT kind, count(e.event_id) AS n FROM k LEFT JOIN events e
ON (kind = e.event_type AND kind <> 'other') OR (kind = 'other' AND coalesce(e.event_type, '') NOT IN ('view', 'click')) GROUP BY kind""")
def stream_counts(spark, d):
    path, counters, listening = fresh(spark, "stream"), finalise.Counters(), spark.streams
    listening.addListener(counters)
    try:
        items = finalise.counted(_event_stream(spark, d).select("event_id", "event_type", "user_id"), "items", "event_type", ["view", "click"])
        query = items.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
        finalise.finish(query, lambda: None, counters)
    finally:
        listening.removeListener(counters)
    return spark.createDataFrame([(k, n) for k, n in counters.of("items").items()], "kind string, n long")


@_query("SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL")
def stream_emit_once(spark, d):
    path = fresh(spark, "stream")
    once = upsert.emit_once(_event_stream(spark, d).select("user_id", "event_id"), "user_id")  # which row is first depends on arrival
    once.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("user_id")
