"""Catalog data sources and polite fetching against a server on this machine, and the commands that use them."""

from __future__ import annotations

import csv
import json
import os
import re
import threading
import time
from collections import Counter, defaultdict
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from gleanworks import cli
from gleanworks.operators import enrich
from gleanworks.sources import connectors, fetch, tables
from gleanworks.sources.catalog import FULL

NETWORK = [{"slug": f"{st.lower()}-{k}" if k != 3 else "", "name": f"School {k}", "city": "Waco", "state_code": st, "gofan_id": k} for st in ("TX", "WY", "OK") for k in range(7)]
TICKETS = [{"huddleId": k, "name": f"School {k}", "state": "TX"} for k in range(25)]


class Site:
    """Answers by path; ``asked`` holds (time, host, path) of each request, ``open`` the most that were open at once by host."""

    def __init__(self):
        self.asked, self.fails, self.slow, self.pages = [], Counter(), {}, {}
        self.open, self.most, self.lock = Counter(), Counter(), threading.Lock()
        site = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                host = self.headers["Host"].split(":")[0]
                with site.lock:
                    site.asked.append((time.monotonic(), host, self.path))
                    site.open[host] += 1
                    site.most[host] = max(site.most[host], site.open[host])
                time.sleep(site.slow.get(host, 0))
                code, kind, body = site.answer(host, self.path)
                with site.lock:
                    site.open[host] -= 1
                self.send_response(code)
                if code in (301, 302):
                    self.send_header("Location", body)
                    body = ""
                self.send_header("Content-Type", kind)
                self.end_headers()
                self.wfile.write(body.encode())

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("0.0.0.0", 0), Handler)
        self.port = self.server.server_address[1]
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def at(self, path, host="127.0.0.1"):
        return f"http://{host}:{self.port}{path}"

    def answer(self, host, path):
        with self.lock:
            if self.fails[path] > 0:
                self.fails[path] -= 1
                return 503, "text/plain", "again"
        q = {k: v[0] for k, v in parse_qs(urlsplit(path).query).items()}
        if path.startswith("/tickets"):
            page, size = int(q["page"]), int(q["size"])
            return 200, "application/json", json.dumps({"content": TICKETS[page * size : (page + 1) * size], "last": (page + 1) * size >= len(TICKETS)})
        if path.startswith("/network"):
            held = [x for x in NETWORK if q.get("state") in (None, "", x["state_code"])]
            start, size = int(q["start"]), int(q["size"])
            return 200, "application/json", json.dumps({"total": len(held), "items": held[start : start + size]})
        if path.startswith("/place"):
            i = path.rpartition("/")[2]
            return (404, "text/plain", "") if i == "4" else (200, "application/json", json.dumps({"huddleId": i, "city": "Waco" if i == "1" else "Elsewhere", "zipCode": 1}))
        return self.pages.get((host, path)) or self.pages.get(path) or (404, "text/html", "<title>nothing</title>")


@pytest.fixture
def site():
    s = Site()
    yield s
    s.server.shutdown()


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("readers", [1, 3])
def test_ticket_catalog(spark, site, readers):
    connectors.register(spark)
    site.fails["/tickets?page=1&size=10"] = 2
    got = spark.read.format("ticket_catalog").options(address=site.at("/tickets?page={page}&size={size}"), size=10, readers=readers, pause=0, wait=0.01).load()
    assert got.rdd.getNumPartitions() == readers
    rows = sorted(got.collect(), key=lambda r: r.pos)
    assert [(r.id, r.name, r.state) for r in rows] == [(str(t["huddleId"]), t["name"], t["state"]) for t in TICKETS]
    pages = Counter(p for _, _, p in site.asked)
    assert pages["/tickets?page=1&size=10"] == 3 and pages["/tickets?page=0&size=10"] == 1 and pages["/tickets?page=2&size=10"] == 1
    site.fails["/tickets?page=0&size=10"] = 9
    with pytest.raises(Exception, match="503"):
        got.collect()
    with pytest.raises(Exception, match="address"):
        spark.read.format("ticket_catalog").load().collect()


def test_network_catalog_reads_only_the_wanted_slices(spark, site):
    connectors.register(spark)
    source = spark.read.format("network_catalog").options(address=site.at("/network?state={state}&start={start}&size={size}"), steps=f"{FULL},TX,WY,OK", pause=0, wait=0.01).load()
    got = source.where("at >= 0")
    assert rows_of(got, "step", "slug") == sorted([(s, x["slug"]) for s in (FULL, "TX", "WY", "OK") for x in NETWORK if x["slug"] and s in (FULL, x["state_code"])], key=repr)
    states = lambda: {parse_qs(urlsplit(p).query).get("state", [""])[0] for _, _, p in site.asked}
    assert states() == {"", "TX", "WY", "OK"}
    for cond, want in (("step = 'TX'", {"TX"}), ("step in ('TX', 'OK')", {"TX", "OK"}), ("state_code = 'WY'", {"", "WY"}), ("slice_no = 2", {"WY"}), ("state_code = 'WY' and step <> 'x'", {"", "WY"}), ("step = 'none'", set())):
        whole = [tuple(r) for r in source.collect()]
        site.asked.clear()
        part = rows_of(source.where(cond), *source.columns)
        assert states() == want, cond
        view = spark.createDataFrame(whole, source.schema)
        assert part == rows_of(view.where(cond), *source.columns), cond


def test_network_catalog_resumes_and_merges(spark, site, tmp_path):
    address, steps = site.at("/network?state={state}&start={start}&size={size}"), [FULL, "TX", "WY", "OK"]
    site.fails["/network?state=WY&start=0&size=500"] = 2
    part, complete = connectors.network_catalog(spark, address, f"{tmp_path}/s", steps, wave=2, pause=0, wait=0.01, tries=2)
    assert not complete and part.count() == 18
    before = len(site.asked)
    whole, complete = connectors.network_catalog(spark, address, f"{tmp_path}/s", steps, wave=2, pause=0, wait=0.01, tries=2)
    assert complete and {p for _, _, p in site.asked[before:]} == {"/network?state=WY&start=0&size=500"}
    assert rows_of(whole, "slug", "state_code") == sorted([(x["slug"], x["state_code"]) for x in NETWORK if x["slug"]])
    assert whole.agg(F.max("pos")).first()[0] < 1 << 40  # the slice of all came first for each
    before = len(site.asked)
    assert connectors.network_catalog(spark, address, f"{tmp_path}/s", steps)[1] and len(site.asked) == before


def test_recorded_pages(spark, tmp_path):
    connectors.register(spark)
    for k in range(3):
        spark.createDataFrame([(json.dumps({"content": TICKETS[k * 10 : k * 10 + 10], "last": k == 2}),)], "value string").coalesce(1).write.text(f"{tmp_path}/page={k}")
    got = spark.read.format("ticket_catalog").options(address=f"file://{tmp_path}/page={{page}}", pause=0).load()
    assert [r.id for r in got.orderBy("pos").collect()] == [str(k) for k in range(25)]


def test_limits_hold_for_each_host_while_others_go_on(spark, site):
    hosts = ["127.0.0.1", "127.0.0.2", "127.0.0.3"]
    for h in hosts:
        for k in range(6):
            site.pages[h, f"/p{k}"] = 200, "text/html; charset=utf-8", f"<title>{h} {k} ü</title>"
    site.slow["127.0.0.2"] = 0.4
    limits = fetch.Limits(delay=0.15, target=100.0, per_host=1, tries=2, concurrency=6, robots=False)
    asked = spark.createDataFrame([(site.at(f"/p{k}", h),) for h in hosts for k in range(6)] * 2 + [(None,), ("ftp://x",), (site.at("/none"),)], "url string").repartition(4)
    got = fetch.fetch(asked, limits, tasks=1).collect()
    assert len(got) == 19 and Counter(r.status for r in got) == {200: 18, 404: 1} and any("ü" in r.html for r in got)
    by_host = defaultdict(list)
    for t, h, _ in site.asked:
        by_host[h].append(t)
    for h in ("127.0.0.1", "127.0.0.3"):
        times = sorted(by_host[h])
        assert all(b - a >= 0.13 for a, b in zip(times, times[1:], strict=False)), h
        assert times[-1] < max(by_host["127.0.0.2"])  # the slow host held nobody up
    assert site.most["127.0.0.2"] == 1


def test_bucket_and_adaptive_delay():
    now = [0.0]
    host = fetch.Host(fetch.Limits(delay=1.0, max_delay=8.0, target=2.0, burst=3, per_host=2), 1, lambda: now[0])
    host.start()
    host.start()
    assert host.ready_in() == float("inf")  # two are open
    host.done(0.2, True)
    assert host.ready_in() == 0 and host.delay == 1.0
    host.start()
    host.done(0.2, True)
    assert host.ready_in() == pytest.approx(1.0)
    for _ in range(6):
        host.start()
        host.done(20.0, True)
    assert 7.0 < host.delay <= 8.0
    slow = host.delay
    host.start()
    host.done(0.1, False)
    assert host.delay == slow  # an error does not lower it
    host.start()
    host.done(0.1, True)
    assert host.delay < slow
    shared = fetch.Host(fetch.Limits(delay=1.0), 4, lambda: now[0])
    shared.start()
    assert shared.ready_in() == pytest.approx(4.0)  # a quarter of the host's rate


def test_robots_retries_redirects_and_failures(spark, site):
    site.pages["/robots.txt"] = 200, "text/plain", "User-agent: *\nDisallow: /private"
    site.pages["/a"] = 200, "text/html", "<title>A</title>"
    site.pages["/moved"] = 302, "text/html", "/a"
    site.pages["/pdf"] = 200, "application/pdf", "not read"
    site.fails["/a"] = 1
    asked = spark.createDataFrame([(site.at(p),) for p in ("/a", "/private/x", "/moved", "/pdf")] + [("http://127.0.0.1:1/x",), ("http://no such host/",)], "url string")
    got = {r.request_url.partition(str(site.port))[2] or r.request_url: r for r in fetch.fetch(asked, fetch.Limits(delay=0.01, tries=2, timeout=5)).collect()}
    assert len(got) == 6 and got["/a"].html == "<title>A</title>" and got["/moved"].url.endswith("/a") and got["/pdf"].html == ""
    assert got["/private/x"].status is None and "robots" in got["/private/x"].error and got["http://127.0.0.1:1/x"].error
    assert not any(p.startswith("/private") for _, _, p in site.asked) and Counter(p for _, _, p in site.asked)["/robots.txt"] <= 4


def test_many_addresses_of_one_host_are_dealt_to_tasks(spark, site):
    site.pages["/x"] = 200, "text/html", "x"
    asked = spark.createDataFrame([(site.at(f"/x?{k}"),) for k in range(40)], "url string")
    began = time.monotonic()
    got = fetch.fetch(asked, fetch.Limits(delay=0.02, target=1e9, tries=1, robots=False), host_rows=10, tasks=4)
    assert got.withColumn("task", F.spark_partition_id()).select("task").distinct().count() > 1
    assert time.monotonic() - began > 0.02 * 20


def test_sites_that_fail_leave_names_empty(spark, site, tmp_path):
    site.pages["/good"] = 200, "text/html", "<title>Home | Oak High School</title>"
    site.pages["/bad"] = 500, "text/html", "<title>Oak Elementary</title>"
    path = f"{tmp_path}/schools.csv"
    with open(path, "w") as f:
        csv.writer(f).writerows([["name", "website"], ["A", site.at("/good")], ["B", site.at("/bad")], ["C", "http://127.0.0.1:1/"], ["D", ""], ["E", site.at("/good")]])
    cli.names(spark, path, "live", fetch.Limits(delay=0.01, tries=1, timeout=5))
    assert [(r.name, r.original_name) for r in tables.read_csv(spark, path).collect()] == [("A", "Oak High School"), ("B", "B"), ("C", "C"), ("D", "D"), ("E", "Oak High School")]
    assert Counter(p for _, _, p in site.asked)["/good"] == 1
    assert enrich.fallback_counts(tables.read_csv(spark, path)).first().scraped == 2


def test_commands_build_their_catalogs(spark, site, tmp_path, capsys):
    path = f"{tmp_path}/schools.csv"
    rows = [[f"School {k}", "TX", "Waco", ""] for k in (1, 2, 4)] + [["Nobody", "TX", "Waco", ""]]
    with open(path, "w") as f:
        csv.writer(f, lineterminator="\n").writerows([["name", "state", "city", "zip_code"], *rows])
    at = site.at("/tickets?page={page}&size={size}"), site.at("/place/{id}")
    common = ["--store", f"{tmp_path}/store", "--pause", "0", "--wait", "0.01"]
    assert cli.main(["tickets", path, at[0], "--detail", at[1], *common], spark) == 0
    got = [(r.name, r.gofan_school_id, r.gofan_match) for r in tables.read_csv(spark, path).collect()]
    assert got == [("School 1", "1", "exact"), ("School 2", "", "none"), ("School 4", "4", "exact"), ("Nobody", "", "none")]  # 2 is elsewhere; of 4 nothing is known
    places = Counter(p for _, _, p in site.asked if p.startswith("/place"))
    assert places["/place/1"] == 1 and set(places) == {"/place/1", "/place/2", "/place/4"}

    with open(path) as f:
        before = f.read()
    network = ["network", path, site.at("/network?state={state}&start={start}&size={size}"), "--steps", f"{FULL},TX,WY", *common]
    site.fails["/network?state=WY&start=0&size=500"] = 8
    assert cli.main(network, spark) == 3 and "WY" in capsys.readouterr().err
    with open(path) as f:
        assert f.read() == before
    assert cli.main(network, spark) == 0
    assert [r.nfhs_match for r in tables.read_csv(spark, path).collect()] == ["gofan_id", "exact", "gofan_id", "none"]
    assert cli.main(["tickets", path, f"{tmp_path}/none.json"], spark) == 3 and cli.main(["names", f"{tmp_path}/none.csv", "live"], spark) == 1


def test_the_whole_job_and_a_crawl_in_rounds(spark, site, tmp_path):
    base = site.at("")
    doc = lambda props: f'<script id="__NEXT_DATA__">{json.dumps({"props": {"pageProps": props}})}</script>'
    team = {"sport": "Football", "gender": "Boys", "level": "Varsity", "season": "Fall", "year": "24"}
    site.pages["/tx/schools/"] = 200, "text/html", doc({"groupings": [{"canonicalUrl": f"{base}/tx/c/s1/"}]})
    for k in (1, 2):
        info = {"name": f"School {k}", "stateCode": "TX", "city": "Waco", "websiteUrl": site.at(f"/home{k}")}
        site.pages[f"/tx/c/s{k}/"] = 200, "text/html", doc({"schoolContext": {"schoolId": f"id{k}", "schoolInfo": info, "sportSeasons": [team | {"canonicalUrl": f"{base}/tx/c/s{k}/team/"}]}, "nearbySchools": [{"canonicalUrl": f"{base}/tx/c/s{k + 1}/"}]})
        site.pages[f"/tx/c/s{k}/team/schedule/"] = 200, "text/html", "<table><tr><th>Date<th>Opponent</tr><tbody><tr><td>1/1<td>@S<td>W 3 - 1</tr></tbody></table>"
    site.pages["/home1"] = 200, "text/html", "<title>School 1 | Home</title>"
    limits = fetch.Limits(delay=0.01, tries=1, timeout=5)
    o = cli.Options.parse(base, "tx")
    out = f"{tmp_path}/out"
    os.makedirs(out)
    assert cli.crawl(spark, "live", out, o, rounds=1, limits=limits) is None
    seen = Counter(p for _, _, p in site.asked if p != "/robots.txt")
    assert cli.crawl(spark, "live", out, o, resume=True, limits=limits) == (2, 2)
    after = Counter(p for _, _, p in site.asked if p != "/robots.txt")
    assert all(after[p] == n == 1 for p, n in seen.items()) and seen["/tx/c/s1/"] == 1

    pages = spark.createDataFrame([(site.at(p), "directory" if p == "/tx/schools/" else "schedule" if "team" in p else "school", 200, "text/html", b, "tx") for p, (_, _, b) in ((p, v) for p, v in site.pages.items() if re.match("/tx", p))], "url string, kind string, status int, content_type string, html string, state_code string")
    pages.write.parquet(f"{tmp_path}/pages")
    sites = spark.createDataFrame([(site.at("/home1"), 200, "text/html", "<title>School 1 | Home</title>")], "website string, status int, content_type string, html string")
    sites.write.parquet(f"{tmp_path}/sites")
    with open(f"{tmp_path}/cat.json", "w") as f:
        json.dump(TICKETS, f)
    with open(f"{tmp_path}/places.json", "w") as f:
        json.dump([{"huddleId": k, "city": "Waco"} for k in range(3)], f)
    spark.createDataFrame([("https://gofan.co/app/school/1", 200)], "url string, status int").write.parquet(f"{tmp_path}/status")
    argv = ["work", f"{tmp_path}/pages", f"{tmp_path}/job", "--base", base, "--states", "tx", "--sites", f"{tmp_path}/sites", "--catalog", f"{tmp_path}/cat.json", "--detail", f"{tmp_path}/places.json", "--status", f"{tmp_path}/status"]
    os.makedirs(f"{tmp_path}/job")
    assert cli.main(argv, spark) == 0
    done = tables.read_csv(spark, f"{tmp_path}/job/schools.csv")
    assert rows_of(done, "name", "original_name", "go_fan_ticket_url") == [("School 1", "School 1", "https://gofan.co/app/school/1"), ("School 2", "School 2", "")]
    argv[-1] = f"{tmp_path}/no-such-table"
    assert cli.main(argv, spark) == 0  # a step that fails does not fail the job
    assert "go_fan_ticket_url" not in tables.read_csv(spark, f"{tmp_path}/job/schools.csv").columns

    def slow(batches):
        for b in batches:
            time.sleep(30)
            yield b

    with pytest.raises(TimeoutError):
        cli.limited(spark, 2, lambda: spark.range(8, numPartitions=8).mapInPandas(slow, "id long").count())
    assert cli.main([*argv[:7], *argv[7:], "--rounds", "1"], spark) == 4
