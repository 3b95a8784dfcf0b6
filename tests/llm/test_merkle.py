"""The manifest against a plain tree."""

import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from nightledger.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    show = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*(show(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def climb(nodes, fanout=3):
    """The root, and for each leaf its (left, right) siblings by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + fanout] for k in range(0, len(nodes), fanout)]
        for k, p in enumerate(paths):
            run, place = runs[at[k] // fanout], at[k] % fanout
            p.append((run[:place], run[place + 1:]))
            at[k] //= fanout
        nodes = [h(*r) for r in runs]
    return nodes[0], paths


def brute(rows, tampered):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    subs = {}
    for s, rs in by.items():
        rs.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        subs[s] = climb([leaf(r, r["text"]) for r in rs])
    order = sorted(subs, key=lambda s: (s is not None, (s or "").encode()))
    root, over = climb([subs[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for r, path in zip(by[s], subs[s][1]):
            path = path + over[k]
            fold = leaf(r, tampered(r))
            for left, right in path:
                fold = h(*left, fold, *right)
            out.append((-1 if r["doc_id"] is None else r["doc_id"], leaf(r, r["text"]), subs[s][0], root, h(*(x for a, b in path for x in a + b)), fold, fold == root))
    return sorted(out)


def got(df):
    cols = [F.coalesce("doc_id", F.lit(-1)), "leaf", "subroot", "root", F.sha2(F.lower(F.hex("proof")), 256), "folded_root", "verified"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def tampering():
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def tampered(r):
    cut = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
    return r["text"].replace("\n", "") if cut and r["text"] is not None else r["text"]


def test_many_sources_with_a_hot_one(spark, make_docs):
    docs = make_docs([(k * 7 % 401, f"t{k}\nx" if k % 3 else None) for k in range(400)] + [(900, "same\n")] * 30)
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") == 50, None).otherwise(F.concat(F.lit("é"), (F.col("doc_id") % 13).cast("string"))))
    rows = [r.asDict() for r in docs.collect()]
    have = got(merkle.manifest(docs, tampering()))
    assert have == brute(rows, tampered)
    assert {r[-1] for r in have} == {True, False}


def test_odd_lone_and_empty_tables(spark, odd_docs, no_docs):
    rows = [r.asDict() for r in odd_docs.collect()]
    assert got(merkle.manifest(odd_docs, tampering())) == brute(rows, tampered)
    lone = odd_docs.where("doc_id = 4")
    (one,) = merkle.manifest(lone).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["verified"] and one["proof"] == b""
    assert merkle.manifest(no_docs).count() == 0


def test_other_fanout(spark, odd_docs):
    """Every untampered leaf folds to the root, whatever the fanout."""
    out = merkle.manifest(odd_docs, fanout=2).collect()
    assert len(out) == odd_docs.count() and all(r["verified"] for r in out)
