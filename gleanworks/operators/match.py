"""Tiered entity resolution against catalogs, blocked by state.

Rows are reduced to the distinct values that decide a match, matched, and joined back; so repeated
rows cost nothing and no row numbers are needed. Catalogs carry ``pos``, their order, which breaks
ties. Each tier sees only what earlier tiers left open. All joins have equality keys: state and
name; state and the rarest word of the smaller set; state and a piece of the name that the partner
must hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanworks.functions import similarity as S
from gleanworks.functions import text as X
from gleanworks.functions.similarity import CUTOFF

_KEY = ["st", "n", "rc", "rz"]


def _keyed(rows: DataFrame) -> DataFrame:
    col = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    return rows.withColumns({"st": F.upper(X.strip(X.nz(F.col("state")))), "n": X.normalize_name(F.col("name")), "rc": F.lower(X.strip(X.nz(col("city")))), "rz": F.substring(X.strip(X.nz(col("zip_code"))), 1, 5)})


def _open(rows: DataFrame) -> DataFrame:
    return _keyed(rows).select(*_KEY).distinct().where((F.col("st") != "") & (F.col("n") != ""))


def _near_names(wanted: DataFrame, names: DataFrame, cutoff: float) -> DataFrame:
    """Pairs of a wanted name (st, n) and a catalog name (st, norm, pos) that may reach ``cutoff``; none that does is missing.

    A wanted name is cut into so many pieces that a partner holds one of them whole, near its place; the catalog's names are indexed by
    their substrings of such lengths. Pairs need as many whole pieces, and as many characters in common, as the cut-off asks of their
    lengths. At cut-offs of 2/3 or less a piece may be empty, so there all lengths in reach are compared.
    """
    n, norm, both = F.col("n"), F.col("norm"), F.length("n") + F.length("norm")
    needed = S.chars_needed(both, cutoff)
    enough = S.chars_shared(n, norm) >= needed
    if cutoff <= 2 / 3:
        lengths = wanted.withColumn("len", F.explode(S.lengths_within(F.length("n"), cutoff)))
        return lengths.join(names.withColumn("len", F.length("norm")), ["st", "len"]).where(enough).select("st", "n", "norm", "pos")
    cut = wanted.select("st", "n", F.inline(S.pieces(n, cutoff)))
    index = names.select("st", "norm", "pos", F.explode(S.grams(norm, cutoff)).alias("gram"))
    first, last = F.greatest(F.col("at") - (F.length("n") - needed), F.lit(1)), F.col("at") + (F.length("norm") - needed)
    placed = F.call_function("locate", F.col("gram"), norm, first)
    in_reach = F.array_contains(S.lengths_within(F.length("n"), cutoff), F.length("norm"))
    whole = cut.join(index, ["st", "gram"]).where(in_reach & (placed > 0) & (placed <= last)).groupBy("st", "n", "norm", "pos").count()
    return whole.where((F.col("count") >= S.pieces_of(F.length("n"), cutoff) - (both - 2 * needed)) & enough).drop("count")


def _closest(keys: DataFrame, cat: DataFrame, cutoff: float) -> DataFrame:
    """For each key the catalog row of the most similar name; equal scores: the largest name, then the first row."""
    names = cat.groupBy("st", "norm").agg(F.min("pos").alias("pos"))
    pairs = _near_names(keys.select("st", "n").distinct(), names, cutoff)
    scored = pairs.withColumn("ratio", S.close_ratio(F.col("norm"), F.col("n"), cutoff)).where(F.col("ratio").isNotNull())
    best = scored.groupBy("st", "n").agg(F.max(F.struct("ratio", "norm", (-F.col("pos")).alias("p"))).alias("b"))
    return keys.join(best.select("st", "n", (-F.col("b.p")).alias("pos")), ["st", "n"])


def _rarest(sets: DataFrame, words: str, times: DataFrame) -> DataFrame:
    """Distinct ``sets`` with ``word``: of its ``words`` the one in the fewest names of the catalog, which any set that holds it must have."""
    each = sets.withColumn("word", F.explode_outer(words)).join(times, ["st", "word"], "left")
    return each.groupBy(*sets.columns).agg(F.min_by("word", F.struct(F.coalesce("times", F.lit(0)), "word")).alias("word"))


def _subset_rows(keys: DataFrame, cat: DataFrame) -> DataFrame:
    """Each key with the catalog rows of which one's set of words holds the other's, nw and nc; rows of nulls as well.

    The smaller set is looked up by its rarest word only, then the sets are compared.
    """
    words = lambda c: F.array_sort(F.filter(F.array_distinct(F.split(c, " ")), lambda w: w != ""))
    rows, held = keys.select(*_KEY, words(F.col("n")).alias("w")), cat.withColumn("cw", words(F.col("norm")))
    sets = held.select("st", "cw").distinct()
    times = sets.select("st", F.explode("cw").alias("word")).groupBy("st", "word").agg(F.count("*").alias("times"))
    by = lambda word, smaller: F.struct(word.alias("word"), F.lit(smaller).alias("smaller"))
    asked = _rarest(rows, "w", times).select(*_KEY, "w", F.inline(F.concat(F.array(by(F.col("word"), True)), F.transform("w", lambda w: by(w, False)))))
    index = sets.select("st", "cw", F.explode("cw").alias("word"), F.lit(True).alias("smaller")).unionAll(_rarest(sets, "cw", times).select("st", "cw", "word", F.lit(False)))
    found = asked.join(index, ["st", "word", "smaller"], "left")
    within = lambda small, large: F.size(F.array_except(small, large)) == 0
    good = F.when(F.col("smaller"), within("w", "cw")).otherwise((F.size("cw") < F.size("w")) & within("cw", "w"))
    found = found.withColumn("cw", F.when(good, F.col("cw")).otherwise(F.array(F.lit(""), F.col("n"))))  # no set: nothing has it, and it is spread
    return found.join(held.select("st", "cw", "pos", "id", "city", "zip"), ["st", "cw"], "left").select(*_KEY, F.size("w").alias("nw"), "pos", "id", "city", "zip", F.size("cw").alias("nc"))


def candidate_ids(rows: DataFrame, catalog: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``id`` of the catalog rows whose place ``match_tickets`` may have to compare, by any tier."""
    cat = catalog.select("pos", F.col("id").cast("string").alias("id"), F.upper(X.nz(F.col("state"))).alias("st"), X.normalize_name(F.col("name")).alias("norm"), F.lit("").alias("city"), F.lit("").alias("zip"))
    keys = _open(rows)
    exact = keys.join(cat.withColumnRenamed("norm", "n"), ["st", "n"])
    left = keys.join(exact.select(*_KEY), _KEY, "left_anti")
    found = exact.select("id").unionAll(_subset_rows(left, cat).where("pos IS NOT NULL").select("id")).unionAll(_closest(left, cat, cutoff).join(cat, ["st", "pos"]).select("id"))
    return found.where(X.nz(F.col("id")) != "").distinct()


def match_tickets(rows: DataFrame, catalog: DataFrame, detail: DataFrame | None = None, cutoff: float = CUTOFF) -> DataFrame:
    """``rows`` (name, state, city, zip_code) with ``match_id`` and ``match_kind``.

    catalog: pos, id, name, state; detail: id, city, zip_code. A missing detail bears out any row; of several for an id the least counts.
    Exact names come first: if there are any and none agrees in place, the row is ``none``. Then
    word sets of which one holds the other, by the fewest words apart; a row of one word needs a
    real agreement in place. Then the one most similar name. Both of these are ``fuzzy``.
    """
    cat = catalog.select("pos", F.col("id").cast("string").alias("id"), F.upper(X.nz(F.col("state"))).alias("st"), X.normalize_name(F.col("name")).alias("norm"))
    if detail is not None:
        place = detail.select(F.col("id").cast("string").alias("id"), "city", "zip_code").groupBy("id").agg(F.min(F.struct("city", "zip_code")).alias("d")).select("id", "d.city", F.col("d.zip_code").alias("zip"))
        cat = cat.join(place, "id", "left")
    else:
        cat = cat.withColumn("city", F.lit("")).withColumn("zip", F.lit(""))
    ok = lambda strict: X.agrees(F.col("city"), F.col("zip"), F.col("rc"), F.col("rz"), strict)
    keys = _open(rows)
    same = keys.join(cat.withColumnRenamed("norm", "n").withColumn("there", F.lit(True)), ["st", "n"], "left")
    best = lambda good, order: F.min_by(F.when(good, F.col("id")), F.when(good, order)).alias("id")
    exact = same.groupBy(*_KEY).agg(best(ok(F.lit(False)), F.col("pos")), F.max("there").alias("hit"))
    near = _subset_rows(exact.where("hit IS NULL").select(*_KEY), cat)
    good = F.col("pos").isNotNull() & ok(F.col("nw") < 2)
    subset = near.groupBy(*_KEY).agg(best(good, F.struct(F.abs(F.col("nc") - F.col("nw")), "pos")), F.max(F.when(good, True)).alias("hit"))
    fuzzy = _closest(subset.where("hit IS NULL").select(*_KEY), cat, cutoff).join(cat, ["st", "pos"]).where(ok(F.lit(False))).select(*_KEY, "id")
    found = exact.where("hit").select(*_KEY, "id", F.lit("exact").alias("kind")).unionByName(subset.where("hit").select(*_KEY, "id").unionByName(fuzzy).withColumn("kind", F.lit("fuzzy")))
    return _answer(rows, found.where(X.nz(F.col("id")) != ""))


def _answer(rows: DataFrame, found: DataFrame) -> DataFrame:
    named = found.select(*_KEY, F.col("id").alias("match_id"), F.col("kind").alias("match_kind"))
    return _keyed(rows).join(named, _KEY, "left").drop(*_KEY).withColumn("match_kind", F.coalesce("match_kind", F.lit("none")))


def match_network(rows: DataFrame, catalog: DataFrame, ticket_id: str = "gofan_school_id", cutoff: float = CUTOFF) -> DataFrame:
    """``rows`` with ``match_id`` (the slug) and ``match_kind``.

    catalog: pos, slug, name, city, state_code, gofan_id. A known ticket id decides, whatever the
    state; its first slug counts. Then exact names: a single one is taken as it is, of several the
    first whose city agrees, else the first. Then the one most similar name if its city agrees.
    """
    cat = catalog.where(X.nz(F.col("slug")) != "").select("pos", F.col("slug").alias("id"), F.upper(X.nz(F.col("state_code"))).alias("st"), X.normalize_name(F.col("name")).alias("norm"), "city", F.col("gofan_id").cast("string").alias("gid"))
    by_id = cat.where(X.nz(F.col("gid")) != "").groupBy("gid").agg(F.min_by("id", "pos").alias("by_id"))
    gid = X.strip(X.nz(F.col(ticket_id).cast("string"))) if ticket_id in rows.columns else F.lit("")
    keyed = rows.withColumn("gid", F.when(gid != "", gid)).join(by_id, "gid", "left").drop("gid")
    keys = _open(keyed.where(F.col("by_id").isNull()))
    near = keys.join(cat.withColumnRenamed("norm", "n"), ["st", "n"])
    good = F.when(X.city_agrees(F.col("city"), F.col("rc")), F.col("pos"))
    exact = near.groupBy(*_KEY).agg(F.coalesce(F.min_by("id", good), F.min_by("id", "pos")).alias("id"))
    rest = keys.join(exact, _KEY, "left_anti")
    fuzzy = _closest(rest, cat, cutoff).join(cat, ["st", "pos"]).where(X.city_agrees(F.col("city"), F.col("rc"))).select(*_KEY, "id")
    answered = _answer(keyed, exact.withColumn("kind", F.lit("exact")).unionByName(fuzzy.withColumn("kind", F.lit("fuzzy"))))
    known = F.col("by_id").isNotNull()
    return answered.withColumn("match_kind", F.when(known, "gofan_id").otherwise(F.col("match_kind"))).withColumn("match_id", F.coalesce("by_id", "match_id")).drop("by_id")


def match_twice(rows: DataFrame, catalog: DataFrame, detail: DataFrame | None = None) -> DataFrame:
    """``match_tickets`` by ``original_name`` where that is set and differs, then by ``name``; with ``match_source``."""
    own, name = X.strip(X.nz(F.col("original_name"))), X.strip(X.nz(F.col("name")))
    tried = match_tickets(rows.withColumn("name_", F.col("name")).withColumn("name", F.when((own != "") & (own != name), own)), catalog, detail)
    tried = tried.withColumn("name", F.col("name_")).drop("name_").withColumnsRenamed({"match_id": "id1_", "match_kind": "kind1_"})
    both = match_tickets(tried, catalog, detail)
    second = F.when(F.col("match_id").isNotNull(), F.when((own != "") & (own == name), "original").otherwise("name"))
    both = both.withColumn("match_source", F.when(F.col("id1_").isNotNull(), "original").otherwise(second))
    return both.withColumn("match_kind", F.when(F.col("id1_").isNotNull(), F.col("kind1_")).otherwise(F.col("match_kind"))).withColumn("match_id", F.coalesce("id1_", "match_id")).drop("id1_", "kind1_")
