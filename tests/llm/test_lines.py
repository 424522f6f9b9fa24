"""Line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from gleanworks.llm import common, lines

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(texts, min_docs=10, min_chars=1):
    n = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for t in texts:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(key(x)) < min_chars or n[key(x)] < min_docs]
        out.append(("\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return out


def odd_texts():
    r = random.Random(1)
    pool = [f"Line {k}" for k in range(40)] + ["", "  ", "Été", "été", " ", "x" * 50_000, "tab\there", "line 1 \r", "\tLINE 1"]
    texts = ["\n".join(r.choice(pool) for _ in range(r.randint(1, 12))) for _ in range(120)]
    return [*texts, None, None, "", "\n", "\n\n", " ", texts[0], texts[0], "only here", "a\n" * 5000 + "a", "Été\n "]


@pytest.mark.parametrize("heavy", [1, 4096])
@pytest.mark.parametrize(("min_docs", "min_chars"), [(10, 1), (1, 1), (10, 3), (3, 0), (10_000, 1)])
def test_against_brute_force(spark, monkeypatch, heavy, min_docs, min_chars):
    monkeypatch.setattr(common, "HEAVY_KEYS", heavy)
    texts = odd_texts()
    rows = [(k, t, "clash", k, "clash") for k, t in enumerate(texts)] + [(None, texts[1], None, None, None), (None, None, None, None, None), (3, texts[3], "again", 3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Hash string, n long, line_key_ string").repartition(5)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped, r.Hash, r.n, r.line_key_) for r in lines.drop_common_lines(df, min_docs, min_chars).collect()), key=repr)
    want = sorted(((r[0], *w, *r[2:]) for r, w in zip(rows, brute([r[1] for r in rows], min_docs, min_chars), strict=True)), key=repr)
    assert got == want


def test_heavy_and_light_keys_meet(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY_KEYS", 3)
    texts = ["common\n" + f"rare {k % 20}" for k in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.text, r.n_dropped) for r in lines.drop_common_lines(df, 10).collect()} == {("", 2)}


def test_empty_table_and_taken_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lines.drop_common_lines(df).collect() == []
    assert lines.drop_common_lines(df).columns == ["doc_id", "text", "n_lines", "n_dropped"]
    with pytest.raises(ValueError, match="overwritten"):
        lines.drop_common_lines(spark.createDataFrame([], "doc_id long, text string, N_LINES int"))


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = {d.doc_id: (n, dropped, hashlib.sha256(t.encode()).hexdigest()) for d, (t, n, dropped) in zip(docs, brute([d.text for d in docs]), strict=True)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.op11_lines(spark, sf_dir).collect()} == want
