"""Texts with very many spans, places or repeated words end in seconds and are whole."""

import time

import pytest
from pyspark.sql import functions as F

from nightledger.llm import decontaminate, licenses, pii
from nightledger.llm.common import running_largest, running_totals

MANY = 60_000
SECONDS = 60  # for one document, the start of the query included


def test_running_values(spark):
    arrays = [[], [4], list(range(300)), [k * 7 % 11 for k in range(40_000)], [-1, 5, -1, 2] * 5000]
    df = spark.createDataFrame([(k, a) for k, a in enumerate(arrays)], "k int, a array<int>")
    began = time.time()
    for r in df.select("k", running_totals(F.col("a")).alias("t"), running_largest(F.col("a")).alias("m")).collect():
        total, most = 0, -1
        for x, t, m in zip(arrays[r["k"]], r["t"], r["m"], strict=True):
            assert (t, m) == (total, most)
            total, most = total + x, max(most, x)
    assert time.time() - began < SECONDS


def test_many_spans(spark, make_docs):
    text = "a.b@c.de, " * MANY + "call +49 (30) 123-456-78 or 10.0.0.1 " * 200
    docs = make_docs([(1, text), (2, None), (3, "plain")])
    model = pii.Model([], {})
    began = time.time()
    (found,) = pii.find(docs, "found", model).where("doc_id = 1").select("found").first()
    assert [(s["start"], s["end"]) for s in found[:MANY]] == [(k * 10, k * 10 + 8) for k in range(MANY)]
    assert time.time() - began < SECONDS


def test_redaction_of_many_spans(spark, make_docs, monkeypatch):
    text = "é a.b@c.de, " * MANY + "10.0.0.1 end"
    docs = make_docs([(1, text), (2, None), (3, "plain"), (4, "x.y@z.de")])
    monkeypatch.setattr(pii, "train", lambda docs, options: pii.Model([], {}))
    began = time.time()
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert got == {1: "é [EMAIL], " * MANY + "[IP] end", 2: None, 3: "plain", 4: "[EMAIL]"}
    assert time.time() - began < SECONDS


def test_many_places(spark, make_docs):
    began = time.time()
    (r,) = licenses.scan(make_docs([(1, "cc by " * MANY)])).collect()
    assert (r["n_base"], r["first_word"], r["last_word"]) == (MANY, 0, 2 * MANY - 2)
    assert time.time() - began < SECONDS


@pytest.mark.parametrize("n", [300, 3000])
def test_repeated_words(n):
    """Occurrences are not paired with every place: matches only."""
    block = decontaminate.Block([("i", [b"a"] * n), ("j", [b"b", *[b"a"] * 20])])
    began = time.time()
    (r,) = block.scan([b"a " * MANY])
    assert time.time() - began < SECONDS
    assert (r["hit_starts"], r["hit_ends"], set(r["items"])) == ([0], [MANY], {"i", "j"})
    long = [m for m in r["matches"] if m["item_id"] == "i"]
    assert len(long) == MANY - 12 + n - 12 - 1 and max(m["n_words"] for m in long) == n


def test_maximal_matches_against_all_pairs():
    block = decontaminate.Block([("i", [b"a", b"b"] * 18), ("k", [b"a"] * 16 + [b"b"] * 16), ("s", [b"a", b"b"])])
    words = ([b"a", b"b"] * 11 + [b"x"] + [b"a"] * 20 + [b"b"] * 14) * 2
    (r,) = block.scan([b" ".join(words)])
    want = []
    for name, item in (("i", [b"a", b"b"] * 18), ("k", [b"a"] * 16 + [b"b"] * 16)):
        for d in range(-len(item) + 1, len(words)):
            run = 0
            for p in range(len(words) + 1):
                same = p < len(words) and 0 <= p - d < len(item) and words[p] == item[p - d]
                if same:
                    run += 1
                elif run:
                    if run >= 13:
                        want.append((name, p - run - d, p - run, run))
                    run = 0
    got = [(m["item_id"], m["item_start"], m["doc_start"], m["n_words"]) for m in r["matches"] if m["item_id"] != "s"]
    assert sorted(got) == sorted(want)
    assert sum(m["item_id"] == "s" for m in r["matches"]) == sum(words[k:k + 2] == [b"a", b"b"] for k in range(len(words)))
