"""Matching, graph, deduplication, sinks, sources, streaming, jobs and the whole plan."""

from __future__ import annotations

import difflib
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from gleanworks import cli, jobs, storage
from gleanworks.operators import dedup, enrich, graph, match, sinks
from gleanworks.plans import catalog as plan_catalog
from gleanworks.plans.crawl import Options, collect
from gleanworks.sources import catalog, tables
from gleanworks.streaming import upsert

BASE = "https://x.org"


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


CAT = [(0, "a", "East High School", "WY"), (1, "b", "Cheyenne East High School", "WY"), (2, "c", "Oak High", "tx"), (3, "d", "Oak HS", "TX"), (4, "e", "Lincolnshire", "TX"), (5, None, "Blank Id", "TX"), (6, "g", "", "TX")]
DETAIL = [("a", "Elsewhere", "11111"), ("b", "Cheyenne", "82001"), ("c", "Dallas", ""), ("d", "Fleming", None)]


def test_ticket_tiers(spark):
    cat, detail = spark.createDataFrame(CAT, "pos long, id string, name string, state string"), spark.createDataFrame(DETAIL, "id string, city string, zip_code string")
    asked = [
        (1, "East", "wy ", "Cheyenne", ""), (2, "Oak", "TX", "Flemington", ""), (3, "Oak School", "TX", "Austin", ""), (4, "Lincolnshird", "TX", "any", "5"), (5, "Lincolnshire", "", "", ""),
        (6, "Blank Id", "TX", "", ""), (7, None, "TX", "", ""), (8, "Big Cheyenne East", "WY", "", "82001"), (9, "Oak", "TX", None, None), (9, "Oak", "TX", None, None),
    ]
    rows = spark.createDataFrame(asked, "k int, name string, state string, city string, zip_code string")
    got = {r.k: (r.match_id, r.match_kind) for r in match.match_tickets(rows, cat, detail).collect()}
    # East: the exact name is elsewhere, so lower tiers are not tried.
    assert got == {1: (None, "none"), 2: ("d", "exact"), 3: (None, "none"), 4: ("e", "fuzzy"), 5: (None, "none"), 6: (None, "none"), 7: (None, "none"), 8: ("b", "fuzzy"), 9: ("c", "exact")}
    assert match.match_tickets(rows, cat, detail).count() == len(asked)
    out = enrich.add_tickets(enrich.add_tickets(rows, cat, detail), cat, detail)
    assert out.columns[-3:] == ["gofan_ticket_url", "gofan_school_id", "gofan_match"]
    assert rows_of(enrich.kind_counts(out, "gofan_match", ["exact", "fuzzy", "none"]), "gofan_match", "n", "matched_percent") == [("exact", 3, 50), ("fuzzy", 2, 50), ("none", 5, 50)]


def test_one_word_needs_a_place(spark):
    cat = spark.createDataFrame([(1, "b", "Cheyenne East High School", "WY")], "pos long, id string, name string, state string")
    detail = spark.createDataFrame([("b", "Cheyenne", "")], "id string, city string, zip_code string")
    rows = spark.createDataFrame([(1, "East", "WY", "Cheyenne"), (2, "East", "WY", None), (3, "Cheyenne East North", "WY", None)], "k int, name string, state string, city string")
    assert rows_of(match.match_tickets(rows, cat, detail), "k", "match_id") == [(1, "b"), (2, None), (3, "b")]


def test_network_tiers(spark):
    cat = spark.createDataFrame([(0, "s0", "Oak", "Waco", "TX", "77"), (1, "s1", "Oak", "Dallas", "tx", "77"), (2, "s2", "Elm High", "Reno", "TX", None), (3, None, "No Slug", "", "TX", "9"), (4, "s4", "Birchwood", "", "TX", "")], "pos long, slug string, name string, city string, state_code string, gofan_id string")
    asked = [(1, "x", "", "", "77 "), (2, "Oak", "TX", "Dallas", None), (3, "Oak", "TX", "Austin", ""), (4, "Elm", "TX", "Austin", ""), (5, "Birchwoos", "TX", "q", ""), (6, "No Slug", "TX", "", "9")]
    rows = spark.createDataFrame(asked, "k int, name string, state string, city string, gofan_school_id string")
    got = {r.k: (r.match_id, r.match_kind) for r in match.match_network(rows, cat).collect()}
    assert got == {1: ("s0", "gofan_id"), 2: ("s1", "exact"), 3: ("s0", "exact"), 4: ("s2", "exact"), 5: ("s4", "fuzzy"), 6: (None, "none")}
    assert enrich.add_network(rows, cat).where("nfhs_url like '%/schools/s0'").count() == 2


def test_fuzzy_equals_difflib_over_all_pairs(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet").select(F.col("p_partkey").alias("pos"), F.concat("p_name", F.substring("p_type", 1, 5)).alias("name"))
    cat = part.where("pos % 2 = 0").select("pos", F.col("pos").alias("id"), F.concat("name", F.lit("x")).alias("name"), F.lit("A").alias("state"))
    rows = part.where("pos % 2 = 1").select(F.col("pos").alias("k"), "name", F.lit("A").alias("state"), F.lit("").alias("city"), F.lit("").alias("zip_code"))
    names = [(r.id, r.name.lower()) for r in cat.orderBy("pos").collect()]
    got = {r.k: (r.match_id, r.match_kind) for r in match.match_tickets(rows, cat).collect()}
    norm = lambda s: " ".join("".join(c if c.isalnum() and c.isascii() else " " for c in s.lower()).split())
    names = [(i, norm(n)) for i, n in names]
    for r in rows.collect():
        n = norm(r.name)
        if any(c == n for _, c in names) or any(set(n.split()) <= set(c.split()) or set(c.split()) <= set(n.split()) for _, c in names):
            continue
        best = difflib.get_close_matches(n, [c for _, c in names], n=1, cutoff=0.87)
        want = (str(next(i for i, c in names if c == best[0])), "fuzzy") if best else (None, "none")
        assert got[r.k] == want


def test_two_attempts_and_verification(spark):
    cat = spark.createDataFrame([(0, "a", "Oak", "TX"), (1, "b", "Elm", "TX")], "pos long, id string, name string, state string")
    rows = spark.createDataFrame([(1, "Oak", "Elm", "TX"), (2, "Oak", "Nothing", "TX"), (3, "Oak", "Oak", "TX"), (4, "Zzz", " ", "TX")], "k int, name string, original_name string, state string")
    got = match.match_twice(rows, cat)
    assert rows_of(got, "k", "match_id", "match_source") == [(1, "b", "original"), (2, "a", "name"), (3, "a", "original"), (4, None, None)]
    status = spark.createDataFrame([("https://gofan.co/app/school/a", 200), ("https://gofan.co/app/school/b", 404)], "url string, status int")
    out = enrich.add_verified_ticket(rows, cat, status)
    assert rows_of(out, "k", "go_fan_ticket_url") == [(1, ""), (2, "https://gofan.co/app/school/a"), (3, "https://gofan.co/app/school/a"), (4, "")]
    assert tuple(enrich.source_counts(out).first()) == (2, 1, 2)


def test_dedup(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "p"), (None, 1, "p"), ("b", 5, None)], "k string, seq int, v string")
    assert rows_of(dedup.last_wins(df, ["k"], F.col("seq")), "k", "v") == [("a", "y"), ("b", None), (None, "p"), (None, "p")]
    assert rows_of(dedup.first_wins(df, ["k"], F.col("seq")), "k", "v") == [("a", "x"), ("b", None)]
    s = spark.createDataFrame([("a", 1, 0), ("a", 1, 1), ("a", 0, 9), ("", 0, 1)], "slug string, no int, at int")
    assert rows_of(dedup.merge_slices(s, "slug", "no", "at"), "slug", "no", "at") == [("a", 0, 9)]


def test_graph_with_cycle_and_scope(spark):
    edges = spark.createDataFrame([(1, 2, "nearby"), (2, 3, "opponent"), (3, 1, "nearby"), (1, 3, "opponent"), (3, 9, "nearby"), (None, 4, "nearby"), (2, None, "nearby")], "src long, dst long, via string")
    seeds = spark.createDataFrame([(1, "directory:tx"), (1, "directory:ca")], "id long, via string")
    got = graph.expand(seeds, edges, F.col("dst") < 9)
    assert rows_of(got, "id", "depth", "via") == [(1, 0, "directory:ca"), (2, 1, "nearby"), (3, 1, "opponent")]


def test_sinks_round_trip(spark, tmp_path):
    schools = spark.createDataFrame([("1", 'a "q",\n x', ["s1", "s2"], 2), (None, "ü", None, None)], "school_id string, name string, sports array<string>, sports_count int")
    store, out = f"{tmp_path}/store", f"{tmp_path}/out"
    with pytest.raises(FileNotFoundError):
        sinks.export(spark, store, out)
    os.makedirs(out)
    sinks.write_table(schools, f"{store}/schools")
    assert sinks.export(spark, store, out) == (2, 0) and sinks.export(spark, store, out) == (2, 0)
    back = tables.read_csv(spark, f"{out}/schools.csv")
    assert rows_of(back, "school_id", "name", "sports", "sports_count") == [("", "ü", "", ""), ("1", 'a "q",\n x', "s1; s2", "2")]
    with open(f"{out}/schools.json", encoding="utf-8") as f:
        text = f.read()
    data = json.loads(text)
    assert text.startswith("[\n  {") and {d["name"]: d["sports"] for d in data} == {'a "q",\n x': ["s1", "s2"], "ü": None} and "ü" in text
    with open(f"{out}/schedule.json") as f:
        assert f.read() == "[]\n"
    sinks.write_csv(schools, f"{out}/more.csv", ["school_id"], mode="append")
    sinks.write_csv(schools, f"{out}/more.csv", ["school_id"], mode="append")
    assert tables.read_csv(spark, f"{out}/more.csv").count() >= 2


def test_upserts_are_idempotent_and_streams_equal_batches(spark, tmp_path):
    src, path = f"{tmp_path}/src", f"{tmp_path}/t"
    for seqs in ([5, 1], [9, 2], [3]):
        spark.createDataFrame([(f"k{s % 2}", s) for s in seqs], "k string, seq int").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("k string, seq int").option("maxFilesPerTrigger", 1).parquet(src)
    for _ in range(2):
        upsert.stream_upsert(stream, path, f"{tmp_path}/cp", ["k"], "seq").awaitTermination(120)
    want = rows_of(dedup.last_wins(spark.read.parquet(src), ["k"], F.col("seq")), "k", "seq")
    assert rows_of(sinks.read_table(spark, path), "k", "seq") == want
    sinks.upsert_table(spark.read.parquet(src), path, ["k"], "seq")
    assert rows_of(sinks.read_table(spark, path), "k", "seq") == want
    assert upsert.emit_once(stream, "k").isStreaming


def faker():
    """A reader that is sent to executors by value."""

    def fake(params, start, size):
        if params.get("state") == "BAD":
            raise OSError("no")
        n = 700 if not params else 3
        return {"total": n, "items": [{"slug": f"{params.get('state', 'f')[:1]}{k}" if k else None, "name": "n", "city": 1, "state_code": "TX", "gofan_id": k} for k in range(start, min(start + size, n))]}

    return fake


def test_sliced_catalog_resumes(spark, tmp_path):
    path, fake = f"{tmp_path}/cat", faker()
    part, complete = catalog.build_sliced(spark, fake, path, ["__full__", "TX", "BAD"])
    assert not complete and part.count() == 701 and catalog.missing(spark, path, ["__full__", "TX", "BAD"]) == ["BAD"]
    whole, complete = catalog.build_sliced(spark, lambda p, s, n: fake({"state": "OK"}, s, n), path, ["__full__", "TX", "BAD"])
    assert complete and whole.count() == 703
    assert catalog.build_sliced(spark, fake, path)[1] and not storage.exists(spark, f"{path}/progress")


def test_paging_and_retries():
    pages = [{"content": [1, 2]}, {"content": [3], "last": True}]
    assert list(catalog.numbered_pages(lambda p, _: pages[p])) == [1, 2, 3]
    assert len(list(catalog.offset_pages(lambda p, s, n: faker()({}, s, n), {}))) == 699
    assert len(list(catalog.offset_pages(lambda p, s, n: {"items": [{"slug": "x"}] * n}, {}))) == 10_000
    waits, left = [], [2]

    def get():
        left[0] -= 1
        if left[0] >= 0:
            raise OSError("again")
        return 7

    assert catalog.with_retries(get, 4, catalog.linear, waits.append)() == 7 and waits == [1.5, 3.0]
    with pytest.raises(OSError):
        catalog.with_retries(lambda: (_ for _ in ()).throw(OSError()), 2, catalog.capped, waits.append)()


def doc(props):
    return f'<script id="__NEXT_DATA__" crossorigin="x">{json.dumps({"props": {"pageProps": props}})}</script>'


def school(i, near=(), sport="Football", url=None):
    ctx = {"schoolId": f"id{i}", "schoolInfo": {"name": "", "formattedNameWithoutState": f"School {i}", "stateCode": "TX", "color1": " red ", "zip": 5}, "sportSeasons": [{"sport": sport, "gender": "Boys", "level": "Varsity", "season": "Fall", "year": "24", "canonicalUrl": f"{BASE}/tx/c/s{i}/team/"}, {"sport": "Golf", "level": "JV", "canonicalUrl": "u"}]}
    return (f"{BASE}/tx/c/s{i}/", "school", 200, "text/html", doc({"schoolContext": ctx, "nearbySchools": [{"canonicalUrl": u} for u in near]}), "tx")


@pytest.fixture(scope="module")
def pages(spark):
    sched = '<table><tr><th>Date<th>Opponent</tr><tbody><tr><td>1/1<td><a href="/tx/c/s3/team/x/">@S3*</a><td>W 3 - 1</tr><tr><td>x</tr><tr><td>1/2<td>vs B<td></tr></tbody></table>'
    rows = [
        (f"{BASE}/tx/schools/", "directory", 200, "text/html", doc({"groupings": [{"canonicalUrl": f"{BASE}/tx/c/s1/"}, {"canonicalUrl": ""}]}), "tx"),
        school(1, [f"{BASE}/tx/c/s2/", f"{BASE}/ca/c/s9/"]), school(2, sport="Golf"), school(3), school(4),
        (f"{BASE}/tx/c/s1/team/schedule/", "schedule", 200, "text/html", sched, None), ("bad", "school", 200, "text/html", '<script id="__NEXT_DATA__">{oops</script>', "tx"),
    ]
    return spark.createDataFrame(rows, "url string, kind string, status int, content_type string, html string, state_code string").cache()


def test_collection(spark, pages):
    schools, games = collect(spark, pages, Options.parse(BASE, "tx"))
    assert rows_of(schools, "school_id", "name", "zip_code", "color1", "discovered_via") == [("id1", "School 1", "5", "red", "directory:tx"), ("id2", "School 2", "5", "red", "nearby"), ("id3", "School 3", "5", "red", "opponent")]
    assert rows_of(games, "school_id", "game_index", "home_away", "opponent", "result", "score", "opponent_url", "season") == [("id1", 0, "away", "S3", "W", "3-1", f"{BASE}/tx/c/s3/team/x/", "Fall 24"), ("id1", 2, "home", "B", "", "", "", "Fall 24")]
    only, _ = collect(spark, pages, Options.parse(BASE, "tx", sports="football"))
    assert rows_of(only, "school_id") == [("id1",), ("id3",)]
    assert rows_of(collect(spark, pages, Options.parse(BASE, "tx", schedules="0"))[0], "school_id") == [("id1",), ("id2",)]
    assert rows_of(collect(spark, pages, Options.parse(BASE, "all", discover="0"))[0], "school_id") == [("id1",)]


def test_site_names(spark):
    html = "<meta name='og:title' content='Error'><title>Home | Oak High School</title>"
    sites = spark.createDataFrame([("http://a", 200, "text/html", html), ("http://b", 404, "text/html", html), ("http://c", 200, "application/pdf", html), ("http://d", 200, None, html)], "website string, status int, content_type string, html string")
    rows = spark.createDataFrame([("A ", " http://a"), ("B", "http://b"), ("C", "http://c"), ("D", "http://d"), ("E", "ftp://a"), ("F", None)], "name string, website string")
    out = enrich.add_site_name(rows, sites)
    assert rows_of(out, "name", "original_name") == [("A ", "Oak High School"), ("B", "B"), ("C", "C"), ("D", "D"), ("E", "E"), ("F", "F")]
    assert tuple(enrich.fallback_counts(out).first()) == (1, 5)


def test_command_line(spark, pages, tmp_path):
    src, out = f"{tmp_path}/pages", f"{tmp_path}/out"
    pages.write.parquet(src)
    os.makedirs(out)
    assert cli.main(["crawl", src, out, "--base", BASE, "--states", "tx"], spark) == 0
    assert cli.main(["export", f"{out}/store", out], spark) == 0
    with open(f"{tmp_path}/cat.json", "w") as f:
        json.dump([{"huddleId": 7, "name": "School 1", "state": "TX"}], f)
    assert cli.main(["tickets", f"{out}/schools.csv", f"{tmp_path}/cat.json"], spark) == 3
    with open(f"{tmp_path}/detail.json", "w") as f:
        json.dump([{"huddleId": 7, "city": "Elsewhere", "zipCode": "99999"}], f)
    with_detail = ["tickets", f"{out}/schools.csv", f"{tmp_path}/cat.json", "--detail", f"{tmp_path}/detail.json"]
    assert cli.main(with_detail, spark) == 0
    assert tables.read_csv(spark, f"{out}/schools.csv").where("gofan_school_id = '7'").count() == 0  # its zip code is 5
    with open(f"{tmp_path}/detail.json", "w") as f:
        json.dump([{"huddleId": 7, "city": "", "zipCode": "5"}], f)
    assert cli.main(with_detail, spark) == cli.main(with_detail, spark) == 0
    spark.createDataFrame([("https://gofan.co/app/school/7", 200)], "url string, status int").write.parquet(f"{tmp_path}/status")
    assert cli.main(["verified", *with_detail[1:], "--status", f"{tmp_path}/status"], spark) == 0
    assert tables.read_csv(spark, f"{out}/schools.csv").where("go_fan_ticket_url like '%/7'").count() == 1
    back = tables.read_csv(spark, f"{out}/schools.csv")
    assert back.where("gofan_school_id = '7'").count() == 1 and back.count() == 3 and len(set(back.columns)) == len(back.columns)
    assert cli.main(["network", "no-such.csv", "x"], spark) == 1 and cli.main(["network", f"{out}/schools.csv", "no-such.json"], spark) == 3


def test_jobs(spark, tmp_path):
    def work(folder, states, sports, levels, discover):
        if sports == "fail":
            raise RuntimeError("broken")
        time.sleep(0.5 if sports == "slow" else 0)
        sinks.write_csv(spark.createDataFrame([("1", "line\nend")], "school_id string, name string"), f"{folder}/{jobs.FILES['teams']}", ["school_id", "name"])

    j = jobs.Jobs(spark, f"{tmp_path}/jobs", work, cap=1)
    for bad in ({}, {"states": "zz", "sports": "x"}, {"states": ",", "sports": "x"}, {"states": "tx"}):
        with pytest.raises(jobs.JobError) as why:
            j.submit(bad)
        assert why.value.code == 400
    name = j.submit({"states": "TX, ca", "sports": "slow"})["job_id"]
    for call, code in ((lambda: j.submit({"states": "all", "sports": "x"}), 429), (lambda: j.results(name), 409), (lambda: j.status("no"), 404)):
        with pytest.raises(jobs.JobError) as why:
            call()
        assert why.value.code == code
    j.jobs[name].future.result()
    assert j.status(name)["counts"] == {"teams": 1, "schedule": 0} and list(j.results(name)) == [{"school_id": "1", "name": "line\nend"}]
    assert os.path.exists(j.download(name)) and list(j.results(name, "schedule")) == []
    failed = j.submit({"states": "all", "sports": "fail"})["job_id"]
    with pytest.raises(RuntimeError):
        j.jobs[failed].future.result()
    assert j.status(failed)["status"] == "error" and j.delete(failed) == j.delete("no") == {"deleted": True}
    j.seconds = -1
    late = j.submit({"states": "wy", "sports": "slow"})["job_id"]
    assert j.status(late)["error"].startswith("stopped")
    assert j.health() == {"ok": True} and len(j.states()) == 51 and len(j.sports()) == 16


def test_dimensions(spark):
    assert tables.seeds(spark, BASE, ["TX"]).collect()[0].url == f"{BASE}/tx/schools/" and tables.seeds(spark, BASE).count() == 51
    assert tables.sports(spark).count() == 16 and len(catalog.slices()) == 52


def test_queries_run_and_have_sql(spark, sf_dir):
    sql = plan_catalog.oracle_sql()
    for name, q in plan_catalog.queries().items():
        assert q(spark, sf_dir).count() >= 0
        assert name in sql, name


def test_expansion_beyond_its_rounds_is_an_error(spark):
    seeds = spark.createDataFrame([(0, "directory")], "id long, via string")
    edges = spark.createDataFrame([(k, k + 1, "nearby") for k in range(4)], "src long, dst long, via string")
    assert graph.expand(seeds, edges, max_rounds=4).count() == 5
    with pytest.raises(RuntimeError):
        graph.expand(seeds, edges, max_rounds=3)


def test_more_than_a_thousand_slices(spark, tmp_path):
    rows = [(k, k, f"type{k:05d}" if k < 1499 else None) for k in range(1500)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = plan_catalog.queries()["slice_first_wins"](spark, str(tmp_path)).collect()
    assert sorted((r.user_id, r.slice_no) for r in got) == [(k, k + 1) for k in range(1500)]


def test_wrong_place_gives_no_ticket_and_lookups_are_remembered(spark, tmp_path):
    cat = spark.createDataFrame(CAT, "pos long, id string, name string, state string")
    rows = spark.createDataFrame([(1, "Oak", "TX", "Austin", ""), (2, "Lincolnshird", "TX", "Waco", ""), (3, "Nothing Alike", "TX", "Waco", "")], "k int, name string, state string, city string, zip_code string")
    ids = match.candidate_ids(rows, cat)
    assert rows_of(ids, "id") == [("c",), ("d",), ("e",)]
    asked = f"{tmp_path}/asked"
    os.makedirs(asked)

    def get(i):
        with open(f"{asked}/{i}", "a") as f:
            f.write("x")
        if i == "e":
            raise OSError("down")
        return {"city": "Dallas" if i == "c" else "Fleming", "zipCode": 75001}

    for _ in range(2):
        detail = catalog.lookup_details(ids, get, f"{tmp_path}/detail")
        assert rows_of(detail, "id", "city", "zip_code") == [("c", "Dallas", "75001"), ("d", "Fleming", "75001"), ("e", None, None)]
    assert {n: os.path.getsize(f"{asked}/{n}") for n in os.listdir(asked)} == {"c": 1, "d": 1, "e": 2}
    got = {r.k: (r.match_id, r.match_kind) for r in match.match_tickets(rows, cat, detail).collect()}
    assert got == {1: (None, "none"), 2: ("e", "fuzzy"), 3: (None, "none")}  # a failed lookup bears out any row


def test_ticket_catalog_download_is_cached(spark, tmp_path):
    def get(page, size):
        return {"content": [{"huddleId": page, "name": f"n{page}", "state": "TX"}], "last": page == 2}

    got = catalog.download_tickets(spark, get, f"{tmp_path}/c")
    assert rows_of(got, "pos", "id", "name", "state") == [(k, str(k), f"n{k}", "TX") for k in range(3)]
    assert catalog.download_tickets(spark, None, f"{tmp_path}/c").count() == 3


def test_upserts_rewrite_only_touched_buckets(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = lambda rows: spark.createDataFrame(rows, "k string, seq int, v string")
    sinks.write_table(df([(f"k{i}", 1, "a") for i in range(300)] + [(None, 1, "n"), (None, 1, "n")]), path, ["k"])
    before = sinks._state(spark, path)["parts"]
    held = sinks.read_table(spark, path)
    sinks.upsert_table(df([("k1", 2, "b"), ("new", 1, "c"), ("k2", 0, "old")]), path, ["k"], "seq")
    after = sinks._state(spark, path)["parts"]
    assert sum(before[b] != after[b] for b in before) <= 3 and held.count() == 302  # the version before is still there
    now = {r.k: r.v for r in sinks.read_table(spark, path).collect()}
    assert now["k1"] == "b" and now["new"] == "c" and now["k2"] == "a" and len(now) == 302 and sinks.read_table(spark, path).count() == 303
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, f"{tmp_path}/none")


def test_cancelled_jobs_stop_their_spark_work(spark, tmp_path):
    def work(folder, *_):
        spark.range(64, numPartitions=64).mapInPandas(slow, "id long").count()

    def slow(batches):
        import time as t

        for b in batches:
            t.sleep(2)
            yield b

    j = jobs.Jobs(spark, f"{tmp_path}/jobs", work, cap=1)
    name = j.submit({"states": "tx", "sports": "x"})["job_id"]
    time.sleep(4)
    future = j.jobs[name].future
    assert j.delete(name) == {"deleted": True}
    assert future.exception(timeout=30) is not None
