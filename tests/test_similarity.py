from __future__ import annotations

import difflib
import random
import string

import pytest
from pyspark.sql import functions as F

from gleanworks.functions import similarity as S
from gleanworks.functions import text as X
from gleanworks.operators import match


def ratio(candidate: str, name: str) -> float:
    return difflib.SequenceMatcher(None, candidate, name).ratio()


def edited(r: random.Random, text: str, times: int, letters: str) -> str:
    out = list(text)
    for _ in range(times):
        if out and r.random() < 0.5:
            out.pop(r.randrange(len(out)))
        else:
            out.insert(r.randint(0, len(out)), r.choice(letters))
    return "".join(out)


def random_names(r: random.Random, count: int, letters: str, longest: int) -> list[str]:
    return ["".join(r.choice(letters) for _ in range(r.randint(1, longest))) for _ in range(count)]


@pytest.mark.parametrize("letters", ["ab", "abcd ", string.ascii_lowercase + " é😀"])
def test_ratios_equal_difflib(letters):
    r = random.Random(len(letters))
    names = ["", *random_names(r, 700, letters, 40)]
    others = [edited(r, n, r.randint(0, 6), letters) if r.random() < 0.7 else r.choice(names) for n in names]
    assert S.ratios(others, names).tolist() == [ratio(a, b) for a, b in zip(others, names, strict=True)]


def test_popular_characters_of_long_names():
    r = random.Random(5)
    names = ["".join(r.choice("abcdefghij klmnop"[: r.choice([3, 17])]) for _ in range(r.randint(195, 320))) for _ in range(40)]
    others = [edited(r, n[r.randint(0, 30) :], r.randint(0, 60), "abcxyzäöü") for n in names]
    assert S.ratios(others, names).tolist() == [ratio(a, b) for a, b in zip(others, names, strict=True)]
    assert S.ratios(["a" * 300], ["a" * 300]).tolist() == [ratio("a" * 300, "a" * 300)]


def test_no_pairs_and_nulls(spark):
    assert S.ratios([], []).tolist() == []
    rows = spark.createDataFrame([(1, None, "a"), (2, "a", None), (3, "", ""), (4, "a", ""), (5, "ab", "ab")], "k int, a string, b string")
    got = {x.k: x.o for x in rows.select("k", S.close_ratio(F.col("a"), F.col("b"), 0.5).alias("o")).collect()}
    assert got == {1: None, 2: None, 3: 1.0, 4: None, 5: 1.0}
    assert rows.where("k < 0").select(S.close_ratio(F.col("a"), F.col("b"))).count() == 0


@pytest.mark.parametrize("cutoff", [0.5, 0.7, 0.87, 0.97, 1.0])
def test_no_near_name_is_missing(spark, cutoff):
    r = random.Random(int(cutoff * 100))
    names = sorted(set(random_names(r, 60, "abcé", 5) + random_names(r, 120, string.ascii_lowercase + " ", 45)))
    asked = sorted({m for n in names for m in (n, edited(r, n, r.randint(1, 1 + len(n) // 4), "abcxyz ")) if m})
    index = spark.createDataFrame([("S", n, i) for i, n in enumerate([*names, ""])], "st string, norm string, pos int")
    wanted = spark.createDataFrame([("S", n) for n in asked], "st string, n string")
    near = match._near_names(wanted, index, cutoff).withColumn("ratio", S.close_ratio(F.col("norm"), F.col("n"), cutoff)).where("ratio IS NOT NULL")
    got = sorted((x.n, x.norm, x.ratio) for x in near.collect())
    assert got == sorted((n, c, ratio(c, n)) for n in asked for c in names if ratio(c, n) >= cutoff)


def test_candidates_stay_flat_when_the_block_grows(spark):
    r = random.Random(9)
    large = list(dict.fromkeys("".join(r.choice(string.ascii_lowercase) for _ in range(r.randint(14, 24))) for _ in range(4000)))
    wanted = spark.createDataFrame([("S", edited(r, n, 2, string.ascii_lowercase)) for n in large[:300]], "st string, n string").distinct()

    def candidates(names):
        return match._near_names(wanted, spark.createDataFrame([("S", n, i) for i, n in enumerate(names)], "st string, norm string, pos int"), 0.87).count()

    small, tenfold = candidates(large[:400]), candidates(large)
    assert small >= 290 and tenfold <= 1.1 * small


def test_word_sets_equal_all_pairs(spark):
    r = random.Random(2)
    words = ["north", "south", "st", "mary", "central", "lake", "hill"]
    draw = lambda most: " ".join(r.choice(words[: r.choice([3, 7])]) for _ in range(r.randint(1, most)))
    asked, held = [(k, draw(4), r.choice("AB")) for k in range(80)], [(k, r.choice(["", draw(3), draw(5)]), r.choice("AB")) for k in range(80)]
    keys = match._open(spark.createDataFrame([(*x, f"c{x[0]}", "") for x in asked], "k int, name string, state string, city string, zip_code string"))
    cat = spark.createDataFrame([(k, str(k), s, n, None, None) for k, n, s in held], "pos int, id string, st string, norm string, city string, zip string")
    normal = {x.name: x.n for x in spark.createDataFrame([(n,) for _, n, _ in asked], "name string").select("name", X.normalize_name(F.col("name")).alias("n")).collect()}
    rows = match._subset_rows(keys, cat)
    got = sorted((x.rc, x.pos, x.nw, x.nc) for x in rows.where("pos IS NOT NULL").collect())
    want = []
    for k, n, s in asked:
        a = set(normal[n].split())
        want += [(f"c{k}", p, len(a), len(set(m.split()))) for p, m, t in held if s == t and a and m and (a <= set(m.split()) or set(m.split()) <= a)]
    assert got == sorted(want)
    assert rows.select(*match._KEY).distinct().count() == keys.count()
