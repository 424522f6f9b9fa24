"""The durable frontier: rounds, resumption, the Bloom filter, and a crawl that is stopped anywhere."""

from __future__ import annotations

import json
import random

import pytest

from gleanworks.operators import graph
from gleanworks.operators.frontier import Bloom, Store
from gleanworks.plans.crawl import Options, collect, crawl, recorded

BASE = "https://x.org"


def brute(edges, seeds):
    depth, now, k = dict.fromkeys(seeds, 0), set(seeds), 0
    while now:
        k += 1
        now = {b for a, b in edges if a in now and b not in depth}
        depth |= dict.fromkeys(now, k)
    return depth


@pytest.mark.parametrize("bloom_from", [0, 10**9])
def test_expansion_in_any_number_of_calls(spark, tmp_path, bloom_from):
    r = random.Random(1)
    edges = {(r.randrange(300), r.randrange(300)) for _ in range(900)} | {(k, k + 1) for k in range(500, 505)} | {(1, 500), (0, 0)}
    df = spark.createDataFrame([(a, b, "nearby") for a, b in edges] + [(None, 3, "nearby"), (3, None, "nearby")], "src long, dst long, via string")
    seeds = spark.createDataFrame([(1, "directory:tx"), (1, "directory:ca"), (None, "x")], "id long, via string")
    want = brute(edges, [1])
    whole = graph.expand(seeds, df, bloom_from=bloom_from)
    assert {x.id: x.depth for x in whole.collect()} == want and whole.count() == len(want)
    path, sizes = f"{tmp_path}/store", []
    for _ in range(max(want.values()) + 2):
        part = graph.expand(seeds, df, store=path, stop_after=1, bloom_from=bloom_from)
        sizes.append(part.count())
    assert {x.id: x.depth for x in part.collect()} == want and sizes == sorted(sizes) and len(set(sizes)) == max(want.values()) + 1 - (sizes[0] != 1)
    with pytest.raises(ValueError, match="another expansion"):
        graph.expand(seeds, df, store=path, signature="other")


def test_edges_are_computed_once(spark, tmp_path):
    calls = f"{tmp_path}/calls"

    def count(batches):
        for b in batches:
            with open(calls, "a") as f:
                f.write("x" * b.num_rows)
            yield b

    df = spark.createDataFrame([(k, k + 1, "nearby") for k in range(7)], "src long, dst long, via string").mapInArrow(count, "src long, dst long, via string")
    assert graph.expand(spark.createDataFrame([(0, "directory")], "id long, via string"), df).count() == 8
    with open(calls) as f:
        assert len(f.read()) == 7


def test_bloom_filter_is_sized_and_never_wrong(spark):
    held, others = spark.range(0, 3000), spark.range(10_000, 40_000)
    bloom = Bloom(held, "id", 3000)
    assert bloom.bits >= 12 * 3000 and len(bloom.words) * 64 == bloom.bits
    assert held.where(bloom.may_hold("id")).count() == 3000
    assert others.where(bloom.may_hold("id")).count() < 0.02 * 30_000
    names = spark.createDataFrame([(f"https://x/{k}",) for k in range(50)] + [(None,)], "id string")
    assert names.where(Bloom(names, "id", 51).may_hold("id")).count() == 51


def test_two_runs_on_one_store_are_told(spark, tmp_path):
    one, two = Store(spark, f"{tmp_path}/s", "a"), Store(spark, f"{tmp_path}/s", "a")
    rows = spark.createDataFrame([(1, 0, "x")], "id long, depth int, via string")
    one.commit(0, rows)
    with pytest.raises(RuntimeError, match="another run"):
        two.commit(0, rows)
    assert len(two.rounds()) == 1


def doc(props):
    return f'<script id="__NEXT_DATA__">{json.dumps({"props": {"pageProps": props}})}</script>'


def site(n=4):
    """A chain of schools: even ones lead on by a nearby link, odd ones by an opponent's."""
    rows = [(f"{BASE}/tx/schools/", "directory", doc({"groupings": [{"canonicalUrl": f"{BASE}/tx/c/s0/"}]}))]
    for k in range(n):
        team = {"sport": "Football" if k % 3 else "Golf", "gender": "Boys", "level": "Varsity", "season": "Fall", "year": "24", "canonicalUrl": f"{BASE}/tx/c/s{k}/team/"}
        near = [{"canonicalUrl": f"{BASE}/tx/c/s{k + 1}/"}, {"canonicalUrl": f"{BASE}/ca/c/s9/"}] if k % 2 == 0 else []
        rows.append((f"{BASE}/tx/c/s{k}/", "school", doc({"schoolContext": {"schoolId": f"id{k}", "schoolInfo": {"name": f"School {k}", "stateCode": "TX"}, "sportSeasons": [team]}, "nearbySchools": near})))
        link = f'<a href="/tx/c/s{k + 1}/x/">@S</a>' if k % 2 else "@S"
        rows.append((f"{BASE}/tx/c/s{k}/team/schedule/", "schedule", f"<table><tr><th>Date<th>Opponent</tr><tbody><tr><td>1/1<td>{link}<td>W 3 - 1</tr></tbody></table>"))
    return rows


def rows_of(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_a_crawl_stopped_anywhere_gives_the_same_rows(spark, tmp_path):
    pages = spark.createDataFrame([(u, k, 200, "text/html", h, "tx" if k == "directory" else None) for u, k, h in site()], "url string, kind string, status int, content_type string, html string, state_code string").cache()
    o = Options.parse(BASE, "tx", sports="football")
    want = [rows_of(x) for x in collect(spark, pages, o)]
    asked, fail_at = [], [None]

    def reader(urls, kind):
        if fail_at[0] is not None and len(asked) >= fail_at[0]:
            fail_at[0] = None
            raise OSError("the network is down")
        asked.extend(r.url for r in urls.collect())
        return recorded(pages)(urls, kind)

    schools, games, complete = crawl(spark, reader, o, f"{tmp_path}/unbroken")
    assert complete and [rows_of(schools), rows_of(games)] == want and len(asked) == len(set(asked)) == 10  # the last school leads to one without a page

    for path, failures in (("stopped", []), ("broken", [2, 5, 8])):
        asked.clear()
        complete, tries = False, 0
        while not complete:
            fail_at[0] = failures.pop(0) if failures else None
            try:
                schools, games, complete = crawl(spark, reader, o, f"{tmp_path}/{path}", stop_after=1 if path == "stopped" else None)
            except OSError:
                pass
            tries += 1
            assert tries < 12
        assert [rows_of(schools), rows_of(games)] == want and sorted(asked) == sorted(set(asked)) and len(asked) == 10
        assert tries > 3
    before = len(asked)
    assert [rows_of(x) for x in crawl(spark, reader, o, f"{tmp_path}/stopped")[:2]] == want and len(asked) == before  # nothing is left to read


def test_a_crawl_without_discovery_or_schedules(spark, tmp_path):
    pages = spark.createDataFrame([(u, k, 200, "text/html", h, "tx" if k == "directory" else None) for u, k, h in site()], "url string, kind string, status int, content_type string, html string, state_code string").cache()
    for k, (discover, schedules) in enumerate([("0", "1"), ("1", "0")]):
        o = Options.parse(BASE, "tx", discover=discover, schedules=schedules)
        schools, games, complete = crawl(spark, recorded(pages), o, f"{tmp_path}/{k}")
        want = collect(spark, pages, o)
        assert complete and rows_of(schools) == rows_of(want[0]) and rows_of(games) == rows_of(want[1])
