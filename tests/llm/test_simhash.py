"""SimHash: fingerprints, BK-trees, shards and components against brute force."""

from __future__ import annotations

import random
import re

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanworks.llm import simhash


def brute_fingerprint(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not found:
        return 0
    pieces = [" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1))]
    hs = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in pieces]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(rows, radius=3):
    """rows: (id, fingerprint); smallest id reachable for each row."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(rows))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAbZé \t\n\x0b\x0c\r İ"), max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_fingerprint_of_long_text_and_none():
    text = " ".join(random.Random(1).choice(["Alpha", "beta", "γ", "d"]) for _ in range(90_000))
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \t ") == 0


def test_tree_finds_all_within_radius():
    r = random.Random(2)
    base = [r.getrandbits(64) for _ in range(40)]
    values = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(8)}
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values:
        assert set(tree.within(q, 3)) == {v for v in values if (v ^ q).bit_count() <= 3}


def test_masks_cover_and_bound():
    masks = simhash.child_masks(0, 4)
    assert sum(masks) == (1 << 64) - 1
    for _ in range(4):
        masks = [x for m in masks[:4] for x in simhash.child_masks(m, 4)]
    assert max(64 - m.bit_count() for m in masks) <= 16


def test_stars_with_crowded_shards(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(15)] + [r.getrandbits(16) for _ in range(15)]  # half share their upper bits
    values = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 6))) for b in base for _ in range(12)})
    df = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    want = brute_components([(v, v) for v in values])
    for shard_rows in (3, 512):
        stars = [(x.a & simhash._U64, x.b & simhash._U64) for x in simhash.fingerprint_stars(df, 3, shard_rows).collect()]
        parent = {v: v for v in values}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in stars:
            parent[find(a)] = find(b)
        groups = {}
        for v, w in zip(values, want, strict=True):
            groups.setdefault(w, set()).add(find(v))
        assert all(len(g) == 1 for g in groups.values()) and len({x for g in groups.values() for x in g}) == len(groups)


def rows_with_edges():
    r = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(r.choice(words) for _ in range(120)) for _ in range(30)]
    near = [t + " tail" for t in texts[:10]] + [t.replace(" ", "  ").upper() for t in texts[:5]]
    odd = [None, "", "  ", "one", "one", "one two", "x" * 100_000]
    rows = [(k, t) for k, t in enumerate([*texts, *near, *odd, *texts[:3]])]
    return [*rows, (None, texts[0]), (None, "nobody else has this"), (None, "nobody else has this"), (5, texts[5])]


def test_components_against_brute_force(spark):
    rows = rows_with_edges()
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, fp string, label int")
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    want = sorted(((i, f, c) for (i, f), c in zip(prints, brute_components(prints), strict=True)), key=repr)
    got = sorted(((x.doc_id, x.fp & simhash._U64, x.component_id) for x in simhash.simhash_components(df).collect()), key=repr)
    assert got == want


def test_empty_table(spark):
    assert simhash.simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    prints = [(i, brute_fingerprint(t)) for i, t in docs]
    want = {i: (f"{f:016x}", c) for (i, f), c in zip(prints, brute_components(prints), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op2_simhash(spark, sf_dir).collect()} == want
