"""Text, URL, HTML and similarity functions against plain Python."""

from __future__ import annotations

import difflib
import gc
import random

import pytest
from pyspark.sql import functions as F

from gleanworks.functions import html as H
from gleanworks.functions import similarity as S
from gleanworks.functions import text as X


def run(spark, make, values, kind="string"):
    """``make`` applied to each value, in order."""
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}").coalesce(1)
    return [r.o for r in df.select("k", make(F.col("v")).alias("o")).orderBy("k").collect()]


def test_strip_and_first_truthy(spark):
    assert run(spark, X.strip, [" a \t", " ", None]) == ["a", "", None]
    assert run(spark, lambda c: X.first_truthy(c, F.lit("b")), ["", None, "a"]) == ["b", "b", "a"]
    assert run(spark, lambda c: X.first_truthy(F.lit(""), c), ["", None]) == ["", None]


def test_normalize_name(spark):
    pairs = {"The East High School": "east", "THE": "the", "high_school": "", "St. Mary's  HS": "st mary s", "Éa": "a", None: "", "Theodore High": "theodore", "The  High  School the": "the", "Highland": "highland"}
    assert run(spark, X.normalize_name, list(pairs)) == list(pairs.values())


def test_titles_and_junk(spark):
    pairs = {
        "Cokeville High School - Just another Sites site": "Cokeville High School", "Home | Lincoln High": "Lincoln High", "Welcome to: Oak School": "Oak School",
        "St-Mary": "Mary", "Error": "Error", "a.b.com": "a.b.com", None: "", "  ": "", "Ab | Cd": "Ab",
    }
    assert run(spark, X.clean_title, list(pairs)) == list(pairs.values())
    assert run(spark, X.is_junk, ["", None, "Terrorer", "school.org/x", "Page Not Found", "x (404)", "Plain High"]) == [False, False, True, True, True, True, False]


def test_results_opponents_and_urls(spark):
    infos = ["W 34 - 20", "2024-10-12", " L", "Won 3-2", "T 1–1", None, ""]
    assert run(spark, X.result_of, infos) == ["W", "", "L", "", "T", "", ""]
    assert run(spark, X.score_of, infos) == ["34-20", "10-12", "", "3-2", "1–1", "", ""]
    assert run(spark, X.clean_opponent, ["@Foo*", "vs Bar", "Foo * *", "@@ VS X**", None]) == ["Foo", "Bar", "Foo *", "X", ""]
    assert run(spark, X.home_away, ["@Foo", "Foo", None]) == ["away", "home", "home"]
    assert run(spark, X.schedule_url, ["b/t/", "b/t/schedule", "b/schedule/", "", None]) == ["b/t/schedule/", "b/t/schedule/", "b/schedule/", None, None]
    base = "https://x.org"
    assert run(spark, lambda c: X.school_root(c, base), [f"{base}/tx/a/b/c/", f"{base}/tx/a", None]) == [f"{base}/tx/a/b/", None, None]
    scope = lambda states: run(spark, lambda c: X.in_scope(c, base, states), [f"{base}/tx/a/b", f"{base}/ca/a/b", f"{base}/tx/a", None])
    assert scope(["tx"]) == [True, False, False, False] and scope([]) == [True, True, False, False]


def test_labels_lists_and_options(spark):
    seasons = [[("Golf", None), ("Golf", None), ("", "x"), (None, "x"), ("Ball", "Boys")], None]
    assert run(spark, X.sport_labels, seasons, "array<struct<sport:string,gender:string>>") == [["Ball (Boys)", "Golf (None)"], []]
    lists = [["Football (Boys)"], ["Flag Football (Girls)"], None]
    assert run(spark, lambda c: X.offers(c, ["football"]), lists, "array<string>") == [True, False, False]
    assert run(spark, X.joined, [["a", "b"], [], None], "array<string>") == ["a; b", "", None]
    assert run(spark, X.unjoined, ["a; b", "", None]) == [["a", "b"], [], None]
    assert [X.truthy(v) for v in (None, "0", " No ", "off", "", "yes", True)] == [True, False, False, False, False, True, True]
    assert X.listed(" A, b,,") == ["a", "b"] and X.listed(None) == []
    assert run(spark, lambda c: X.percent(c, F.lit(3).cast("long")), [2, 0], "long") == [66, 0]
    assert run(spark, lambda c: X.season_label(c, F.lit("2024")), ["Fall", None]) == ["Fall 2024", "2024"]


@pytest.mark.parametrize(
    ("city", "zip_code", "row_city", "row_zip", "positive", "want"),
    [("Flemington", "", "Fleming", "", True, True), ("", "12345-6", "x", "12345", True, True), ("a", "", "", "", False, True), ("", "", "b", "1", False, True), ("", "", "b", "1", True, False), ("a", "1", "b", "2", False, False), (None, None, None, None, True, False)],
)
def test_agreement(spark, city, zip_code, row_city, row_zip, positive, want):
    lit = lambda v: F.lit(v).cast("string")
    assert spark.range(1).select(X.agrees(lit(city), lit(zip_code), lit(row_city), lit(row_zip), F.lit(positive))).first()[0] is want


PAGE = """<html><head><title>T &amp; U</title><meta property="og:title" content="Oak High"></head><body><h1><b>Head</b> x</h1>
<div><table><thead><tr><th>Date</th><th>Opponent</th></tr></thead><tbody><tr><td>1/2<br>x<td><a href="/tx/a/b/t/">@Foo*</a><td>W 3 - 1</tr>
<tr><td>only</td></tr><tr><td>1/3</td><td>Bar</td></tr></tbody></table></div><table><tr><td>n<td>o</table></body></html>"""


def test_html(spark):
    got = H.schedule_rows(PAGE)
    assert got["rows"] == [{"game_index": 0, "cells": ["1/2 x", "@Foo*", "W 3 - 1"], "opp_href": "/tx/a/b/t/"}, {"game_index": 2, "cells": ["1/3", "Bar"], "opp_href": None}]
    assert got["links"] == ["/tx/a/b/t/"]
    assert H.titles_of(PAGE) == {"og_site": None, "og_title": "Oak High", "name_site": None, "name_title": None, "title": "T & U", "h1": "Head"}
    assert H.schedule_rows(None) == {"rows": [], "links": []} and H.titles_of("<")["title"] is None
    assert run(spark, lambda c: H.url_join(F.lit("https://x.org/a/b"), c), ["/c", "../d", None]) == ["https://x.org/c", "https://x.org/d", None]


def test_row_index_of_body_rows():
    body = "<table><tr><th>Date<th>Opponent</tr><tbody><tr><td>a<td>b</tr><tr><td>c</tr><tr><td>d<td>e</tr></tbody></table>"
    assert [(r["game_index"], r["cells"]) for r in H.schedule_rows(body)["rows"]] == [(0, ["a", "b"]), (2, ["d", "e"])]


def test_close_ratio_is_difflib(spark):
    r = random.Random(1)
    names = ["".join(r.choice("abcde ") for _ in range(r.randint(1, 14))) for _ in range(40)]
    pairs = [(a, b) for a in names for b in names[:12]]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    got = {x.k: x.o for x in df.select("k", S.close_ratio(F.col("a"), F.col("b"), 0.6).alias("o")).collect()}
    within = {x.k for x in df.where(F.array_contains(S.lengths_within(F.length("b"), 0.6), F.length("a"))).collect()}
    for k, (a, b) in enumerate(pairs):
        want = difflib.SequenceMatcher(None, a, b).ratio()
        assert got[k] == (pytest.approx(want) if want >= 0.6 else None)
        assert want < 0.6 or k in within


def test_plain_pages_have_the_standard_library_s_tree(monkeypatch):
    def tree(n):
        return n if isinstance(n, str) else (n.tag, n.attrs, [tree(k) for k in n.kids])

    def slow(page):
        b = H._Builder()
        b.feed(page)
        b.close()
        return b.root

    bits = ["<table>", "</table>", "<tr>", "<td>", "</td>", "</ td>", "<td class=x>", '<a href="/s/a&amp;b">', "<A HREF='q>r' b>", "</A>", "<br/>", "<br />", "<p/ >", "<a b= \"x>", "text", " &amp; ", "&am", "p;", "&#65", "<", ">", "<!-- <b> -->", "<!DOCTYPE html>", "<!x>", "<?p>", "</>", "<b c=d/>", '<i a="">', '<i a="1"b="2">', "<script>", "</script>", "<title>", "</title>", "\n", "é ", '"', "<a\x0bb>", "<x-y>", "<td\tz>"]
    r = random.Random(2)
    for _ in range(6000):
        page = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert tree(H.parse(page)) == tree(slow(page)), page
    plain = PAGE.replace("<title>T &amp; U</title>", "")
    want = tree(slow(plain))
    monkeypatch.setattr(H._Builder, "feed", None)  # a plain page is not read by it at all
    assert tree(H.parse(plain)) == want


def test_a_read_page_leaves_no_cycles_and_repeated_tags_are_told_once():
    plain = PAGE.replace("<title>T &amp; U</title>", "")
    want = H.schedule_rows(plain)
    told = H._known_step.cache_info().misses
    gc.collect()
    gc.disable()
    try:
        assert H.schedule_rows(plain) == want
        assert gc.collect() == 0  # the tree has gone with its last reader
    finally:
        gc.enable()
    assert H._known_step.cache_info().misses == told
    nested = "<div><table><tr><th>Date<th>Opponent<tbody><tr><td>1<td>a<b>b</b>c<table><tr><td><a href='/x'>y</table><td>d</table></div>tail"
    rows = H.schedule_rows(nested)["rows"]
    assert [(r["game_index"], r["cells"], r["opp_href"]) for r in rows] == [(0, ["1", "a b c y", "d"], "/x")] and H.schedule_rows(nested)["links"] == ["/x"]
