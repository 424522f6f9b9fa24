"""Near duplicates at a similarity of five-word shingles against brute force."""

from __future__ import annotations

import random

import numpy as np

from gleanworks.llm import similar


def shingles(text, words=5):
    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(found[k : k + words]) for k in range(max(1, len(found) - words + 1))} if found else set()


def brute_survivors(rows, similarity=0.8):
    """The smallest id of each group."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = {}
    for i, s in enumerate(sets):
        close = {j for x in s for j in at.get(x, ())}
        for j in close:
            both = len(s & sets[j])
            if both >= similarity * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
        for x in s:
            at.setdefault(x, []).append(i)
    blank = [i for i, s in enumerate(sets) if not s]
    for i in blank[1:]:
        parent[find(i)] = find(blank[0])
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted(least.values())


def edited(r, text, edits):
    found = text.split()
    for k in r.sample(range(len(found)), edits):
        found[k] = f"new{r.random()}"
    return " ".join(found)


def made(n=60, copies=8):
    r = random.Random(9)
    rows = []
    for _ in range(n):
        base = " ".join(f"w{r.randint(0, 5000)}" for _ in range(r.randint(80, 250)))
        rows.append(base)
        rows += [edited(r, base, r.randint(0, 14)) for _ in range(r.randint(0, copies))]
    hot = " ".join(f"h{r.randint(0, 5000)}" for _ in range(150))
    rows += [edited(r, hot, r.randint(1, 5)) for _ in range(150)] + [None, "", " \n", "one", "ONE", "two words", "a b c d e", "a b c d e f"]
    return list(enumerate(rows))


def test_groups_against_brute_force(spark):
    rows = made()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, rid int, f0 string")
    out = similar.near_duplicate_survivors(df)
    assert out.columns == df.columns
    got, want = {r.doc_id for r in out.collect()}, set(brute_survivors(rows))
    assert len(got - want) <= 0.02 * len(rows) and not want - got


def test_copies_that_link_only_to_their_original(spark):
    r = random.Random(11)
    base = " ".join(f"w{k}" for k in range(204))
    copies = []
    for _ in range(500):
        found = base.split()
        for k in r.sample(range(4, 200, 5), 4):
            found[k] = f"new{r.random()}"
        copies.append(" ".join(found))
    rows = list(enumerate([base, *copies]))
    a, b = shingles(copies[0]), shingles(copies[1])
    assert len(a & b) < 0.8 * len(a | b) and brute_survivors(rows) == [0]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = similar.near_duplicate_survivors(df).count()
    assert got <= 1 + 0.002 * len(rows)


def test_repeated_rows_and_null_ids(spark):
    text = "the same words again and again in this one"
    rows = [(5, text), (5, text), (3, text.upper()), (None, text), (None, "only this one has no id at all"), (None, "only this one has no id at all")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id or -1) for r in similar.near_duplicate_survivors(df).collect()) == [-1, 3]
    assert similar.near_duplicate_survivors(df.limit(0)).count() == 0


def test_neighbours_connect_all_that_is_near():
    r = random.Random(3)
    values = []
    for _ in range(40):
        base = r.getrandbits(128)
        values += [base ^ sum(1 << k for k in r.sample(range(128), r.randint(0, 25))) for _ in range(8)]
    radius, parent = 32, list(range(len(values)))
    near = similar.Neighbours(radius)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, v in enumerate(values):
        for other in near.add(v, k):
            assert (values[other] ^ v).bit_count() <= radius + 2
            parent[find(k)] = find(other)
    for i, v in enumerate(values):
        for j in range(i):
            assert find(i) == find(j) or (values[j] ^ v).bit_count() > radius


def test_tiles_link_like_brute_force():
    r = random.Random(8)
    rows = [t for _, t in made(12)]
    sets = [similar.short_hashes(similar.shingle_hashes((t or "").encode())) for t in rows]
    fps = np.array([similar.wide_fingerprint(similar.shingle_hashes((t or "").encode()))[:2] for t in rows])
    some = [k for k, x in enumerate(sets) if len(x)]
    r.shuffle(some)
    for split in (len(some), len(some) // 3):
        links = similar.link_tile(np.array(some), fps[some], [sets[k] for k in some], split, 128, 0.8)
        parent = {k: k for k in some}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            assert similar.similar_enough(sets[a], sets[b], 0.8) and find(a) != find(b)
            parent[find(a)] = find(b)
        for i in range(split):
            for j in range(i + 1 if split == len(some) else split, len(some)):
                assert find(some[i]) == find(some[j]) or not similar.similar_enough(sets[some[i]], sets[some[j]], 0.8)


def test_small_blocks_and_shuffled_ids_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame(made(30), "doc_id long, text string")
    want = sorted(r.doc_id for r in similar.near_duplicate_survivors(df).collect())
    assert sorted(r.doc_id for r in similar.near_duplicate_survivors(df, block_rows=7, block_bytes=5000).collect()) == want
    monkeypatch.setattr("gleanworks.llm.common.BROADCAST_IDS", 0)
    assert sorted(r.doc_id for r in similar.near_duplicate_survivors(df).collect()) == want


def test_short_texts_are_found_surely(spark):
    r = random.Random(21)
    rows = []
    for _ in range(150):
        base = [f"w{r.randint(0, 10**6)}" for _ in range(r.randint(6, 60))]
        rows.append(" ".join(base))
        rows.append(" ".join([*base, "tail"]))  # one shingle more
    rows += ["a common line that all of these short texts have " + " ".join(f"u{r.randint(0, 10**6)}" for _ in range(r.randint(0, 20))) for _ in range(300)]
    rows = list(enumerate(rows))
    got = sorted(x.doc_id for x in similar.near_duplicate_survivors(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_survivors(rows)


def test_equal_rows_and_clashing_names(spark):
    rows = [(1, "x y", 1, 1, "a"), (1, "x y", 2, 1, "b"), (None, None, 3, 1, "c"), (None, "", 4, 1, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, k1_ int, near int, s string")
    got = similar.near_duplicate_survivors(df)
    assert got.columns == df.columns and sorted((r.doc_id or -1) for r in got.collect()) == [-1, 1]


def test_fingerprints_differ_by_the_expected_share():
    r = random.Random(4)
    share = []
    for _ in range(40):
        a = " ".join(f"w{r.randint(0, 9999)}" for _ in range(300))
        b = edited(r, a, 6)
        ha, hb = (similar.shingle_hashes(t.encode()) for t in (a, b))
        both = len(np.intersect1d(ha, hb))
        j = both / (len(ha) + len(hb) - both)
        share.append(int(np.bitwise_count(similar.wide_fingerprint(ha) ^ similar.wide_fingerprint(hb)).sum()) / 256 - similar.bit_share(j))
    assert abs(np.mean(share)) < 0.02
