import hashlib

import pytest

from nightledger.llm import decontaminate
from nightledger.llm.common import alnum_words
from nightledger.llm.queries import QUERIES

from .conftest import ODD, prose


def by_hand(text, items):
    words = alnum_words((text or "").encode())
    hit, found = set(), set()
    for name, t in items:
        w = alnum_words((t or "").encode())
        n = min(13, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1) if n else ():
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                if name is not None:
                    found.add(str(name))
    return len(words), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(words)


def check(docs, bench, items, **options):
    want = sorted(by_hand(r["text"], items) for r in docs.select("text").collect())
    rows = decontaminate.contamination(docs, bench, **options).collect()
    assert sorted((r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows) == want
    return rows


@pytest.fixture(scope="module")
def items():
    return [("a", prose(5, 40)), ("b", "one"), ("c", None), ("d", ""), ("e", prose(77, 9)), ("a", prose(5, 40)),
            (None, prose(9, 50)), ("f", prose(5, 14) + " ends otherwise here"), ("g", "q q q q q q q q q q q q q q q q")]


@pytest.fixture(scope="module")
def bench(spark, items):
    return spark.createDataFrame(items, "item_id string, text string")


def test_small_tables_match_brute_force(spark, sf_small, small_docs):
    b = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in b.collect()]
    check(small_docs, b, items)
    rows = {r["doc_id"]: r for r in QUERIES["op10_suffix_decontamination"](spark, sf_small).collect()}
    for r in small_docs.collect():
        n, hit, found, bad = by_hand(r["text"], items)
        q = rows[r["doc_id"]]
        assert (q["n_words"], q["n_hit"], q["n_items"], q["contaminated"]) == (n, hit, len(found), bad)
        assert q["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()


@pytest.mark.parametrize("options", [{}, {"block_bytes": 100}, {"shard_bytes": 2000, "block_bytes": 1}])
def test_odd_rows_short_items_and_blocks(make_docs, bench, items, options):
    docs = make_docs([*ODD, (20, "x " + prose(5, 30) + " y"), (21, "q " * 40), (22, prose(5, 20)[40:] + " one")])
    check(docs, bench, items, **options)


def test_longest_match_and_location(make_docs, bench):
    docs = make_docs([(1, "lead words " + prose(5, 30))])
    r = decontaminate.contamination(docs, bench).first()
    assert r["longest"] == 30
    assert {(m["item_id"], m["item_start"], m["doc_start"], m["n_words"]) for m in r["matches"]} >= {("a", 0, 2, 30), ("f", 0, 2, 14)}


def test_remove_keeps_clean_documents_and_columns(make_docs, bench, items):
    docs = make_docs([(1, prose(5, 30)), (2, prose(1, 30)), (2, prose(1, 30)), (3, None), (4, prose(5, 13) + " " + prose(8, 400))])
    out = decontaminate.remove_contaminated(docs, bench)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 2, 3, 4]


def test_empty_tables(spark, make_docs, no_docs, bench):
    assert decontaminate.contamination(no_docs, bench).count() == 0
    r = decontaminate.contamination(make_docs([(1, prose(5, 30))]), bench.where("false")).first()
    assert (r["n_words"], r["n_hit"], r["contaminated"], r["longest"]) == (30, 0, False, 0)
