import random

import xxhash
from pyspark.sql import functions as F

from nightledger.llm import near_dup

from .conftest import ODD, prose


def by_hand(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, radius=2):
    """Union of all pairs within the radius."""
    prints = list(prints)
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


def unsigned(x):
    return x & (1 << 64) - 1


def check(docs, rows):
    texts = [r for r in docs.collect()]
    assert len(rows) == len(texts)
    assert sorted(unsigned(r["fingerprint"]) for r in rows) == sorted(by_hand(r["text"]) for r in texts)
    of = classes({unsigned(r["fingerprint"]) for r in rows})
    least = {}
    for r in rows:
        if r["doc_id"] is not None:
            k = of[unsigned(r["fingerprint"])]
            least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    for r in rows:
        assert r["component_id"] == least.get(of[unsigned(r["fingerprint"])])


def test_components_match_brute_force(small_docs):
    check(small_docs, near_dup.near_duplicates(small_docs).collect())


def test_every_pair_within_the_radius_shares_a_table():
    masks = [unsigned(m) for m in near_dup.covering_masks()]
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not (m >> i & 1 or m >> j & 1) for m in masks)


def test_links_connect_exactly_the_close_fingerprints(spark):
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):  # dense clouds: many fingerprints in one bucket, chains of steps of two bits
        x = rng.getrandbits(64)
        for _ in range(40):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 2, 3))))
            prints.add(x)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "fp long")
    edges = [(unsigned(r["a"]), unsigned(r["b"])) for r in near_dup.links(df).collect()]
    want = classes(prints)
    roots = {unsigned(r["fp"]): unsigned(r["root"]) for r in near_dup.components(near_dup.links(df)).collect()}
    groups = lambda m: sorted(sorted(p for p in prints if m.get(p, p) == r) for r in {m.get(p, p) for p in prints})
    assert groups(roots) == groups(want)
    assert all(want[a] == want[b] for a, b in edges)


def test_chain_and_many_copies(make_docs):
    docs = make_docs([(i, prose(1, 60)) for i in range(300)] + [(500 + i, prose(2, 400) + f" tail{i}") for i in range(60)])
    check(docs, near_dup.near_duplicates(docs).collect())


def test_keep_one_keeps_the_smallest_id_with_all_columns(odd_docs):
    kept = near_dup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    found = near_dup.near_duplicates(odd_docs)
    assert len(rows) == found.select("root").distinct().count()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted(
        (r["m"] is None, r["m"] or 0) for r in found.groupBy("root").agg(F.min("doc_id").alias("m")).collect())


def test_odd_rows(odd_docs):
    check(odd_docs, near_dup.near_duplicates(odd_docs).collect())
    assert len(ODD) == odd_docs.count()


def test_empty_table(no_docs):
    assert near_dup.near_duplicates(no_docs).count() == 0
    assert near_dup.keep_one(no_docs).count() == 0
