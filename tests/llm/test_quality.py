import math
from collections import Counter

import numpy as np

from nightledger.llm import quality

from .conftest import ODD, prose


def by_hand(text):
    text = text or ""
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def figures(r):
    return (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])


def test_base_figures_match_brute_force(small_docs):
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    rows = quality.score(small_docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = by_hand(texts[r["doc_id"]])
        assert figures(r) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_distances_against_references_by_hand(make_docs):
    docs = [(i, prose(i, 200)) for i in range(30)]
    limits = quality.Limits(common_words=5)
    rows = {r["doc_id"]: r for r in quality.score(make_docs(docs), limits).collect()}
    counts = Counter(w for _, t in docs for w in t.lower().split())
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:5]
    ref = np.array([*(n for _, n in top), sum(counts.values()) - sum(n for _, n in top)], float)
    for i, t in docs:
        own = Counter(t.lower().split())
        p = np.array([own[w] for w, _ in top] + [200 - sum(own[w] for w, _ in top)], float)
        p, q = p / p.sum(), ref / ref.sum()
        m = (p + q) / 2
        d = sum(a * math.log2(a / b) for a, b in zip(p, m) if a) + sum(a * math.log2(a / b) for a, b in zip(q, m) if a)
        assert math.isclose(rows[i]["word_distance"], math.sqrt(d / 2), abs_tol=1e-9)


def test_labels_agree_on_small_tables(spark, sf_small, small_docs):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    rows = [r for r in quality.score(small_docs).collect() if not r["base_failed"] and labels.get(r["doc_id"]) is not None]
    good = [r["kept"] for r in rows if labels[r["doc_id"]] == 1]
    assert sum(good) == len(good)  # clean documents stay
    bad = [r["kept"] for r in rows if labels[r["doc_id"]] == 0]
    assert sum(bad) <= 0.3 * len(bad)


def test_divergent_document_is_rejected_and_clean_ones_stay(make_docs):
    docs = [(i, prose(i, 300)) for i in range(40)] + [(99, " ".join(f"{i:x}|Z{i}%" for i in range(300)))]
    kept = {r["doc_id"] for r in quality.filter_documents(make_docs(docs)).collect()}
    assert kept == set(range(40))


def test_odd_rows_and_columns(odd_docs):
    rows = quality.score(odd_docs).collect()
    assert sorted(map(figures, rows)) == sorted(by_hand(t) for _, t in ODD)
    assert quality.filter_documents(odd_docs).columns == odd_docs.columns


def test_null_language_uses_the_pooled_reference(make_docs):
    docs = make_docs([(i, prose(i, 100)) for i in range(20)], lang=None)
    assert all(r["kept"] for r in quality.score(docs).collect())


def test_empty_table(no_docs):
    assert quality.score(no_docs).count() == 0
    assert quality.filter_documents(no_docs).count() == 0


def test_every_language_has_its_reference(spark, make_docs):
    """More languages than tasks hold: the others are joined, with the same figures."""
    from pyspark.sql import functions as F
    docs = make_docs([(i, prose(i % 97, 60 + i % 40)) for i in range(600)]).withColumn("lang", F.concat(F.lit("l"), (F.col("doc_id") % 300).cast("string")))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") == 7, None).otherwise(F.col("lang")))
    few, many = (sorted(map(repr, quality.score(docs, quality.Limits(held_languages=n)).collect())) for n in (5, 1000))
    assert few == many and len(few) == 600
    a, b = (sorted(r["doc_id"] for r in quality.filter_documents(docs, quality.Limits(held_languages=n)).collect()) for n in (5, 1000))
    assert a == b and len(a) > 500
    assert quality.filter_documents(docs, quality.Limits(held_languages=5)).columns == docs.columns


def test_pooled_list_counts_all_words(make_docs):
    """A word ranked below every language's own list, and a very long word, are pooled by all their occurrences."""
    long = "x" * 300
    docs = []
    for k in range(4):
        own = " ".join(f"w{k}x{i} " * 10 for i in range(100))
        docs.append((k, own + " shared" * 9 + f" {long}" * 8))
    from pyspark.sql import functions as F
    df = make_docs(docs).withColumn("lang", F.col("doc_id").cast("string"))
    refs, rest = quality.references(df, quality.Limits())
    assert rest is None and refs[None][1][:2] == [b"shared", long.encode()] and refs[None][2][0] == 36
    assert all(len(refs[str(k)][1]) == 100 and b"shared" not in refs[str(k)][1] for k in range(4))
    assert refs[None][2].sum() == sum(len(t.split()) for _, t in docs)
