"""Mixing: targets against a plain water level, cuts, hot and repeated rows, reruns."""

from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from nightledger.llm import mixing


def level(sizes: dict, weights=(5, 2, 1), share=Fraction(3, 2), most=2) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, full = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        rate = left / sum(w[s] for s in free) if free else 0
        above = [s for s in free if rate * w[s] > most * sizes[s]]
        if not above:
            return {s: Fraction(full.get(s, rate * w[s])) for s in order}
        for s in above:
            full[s] = most * sizes[s]
            left -= full[s]


def checked(df):
    rows = [r.asDict() | r["row"].asDict() for r in df.collect()]
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    want = level(sizes)
    for s, rs in by.items():
        assert {r["source_size"] for r in rs} == {sizes[s]}
        assert all(abs(r["target"] - float(want[s])) <= 1e-6 * max(1, float(want[s])) for r in rs)
        assert abs(sum(r["taken"] for r in rs) - float(want[s])) <= 0.5
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in rs)
        assert sum(0 < r["cut"] < r["size"] for r in rs) <= 1
    return sorted((str(r["doc_id"]), r["source"] or "", r["size"], r["taken"]) for r in rows)


def test_driver_documents_and_reruns(spark, small_docs):
    keep = ("doc_id", "source")
    first = checked(mixing.plan(small_docs, keep))
    assert first == checked(mixing.plan(small_docs.repartition(7), keep))


def test_hot_source_repeated_rows_and_null_source(spark, make_docs):
    docs = make_docs([(1, "a b c")] * 4000 + [(k, "x " * (k % 9)) for k in range(2, 800)] + [(None, "n"), (5, None)])
    source = F.when(F.col("doc_id") == 1, "hot").when(F.col("doc_id") % 7 == 0, None).otherwise(F.concat(F.lit("Ä"), (F.col("doc_id") % 5).cast("string")))
    docs = docs.withColumn("source", F.when(F.col("doc_id").isNull(), "").otherwise(source))
    got = checked(mixing.plan(docs, ("doc_id", "source")))
    assert len(got) == 4800
    # the hot source is alike in every row: all but one are taken equally often
    assert len({r[3] for r in got if r[1] == "hot"}) <= 3


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    checked(mixing.plan(odd_docs, ("doc_id", "source")))
    assert mixing.plan(no_docs).count() == 0 and mixing.mix(no_docs).columns == no_docs.columns
    lone = odd_docs.where("doc_id in (1, 2, 3)")  # no word at all
    assert [r["taken"] for r in mixing.plan(lone).collect()] == [0, 0, 0]


def test_mixed_documents(spark, odd_docs):
    plan = {(r["row"]["doc_id"], r["size"]): r for r in mixing.plan(odd_docs).collect()}
    out = mixing.mix(odd_docs)
    assert out.columns == odd_docs.columns
    words = sum(len(r["text"].split()) for r in out.collect())
    total = mixing.plan(odd_docs).agg(F.sum("taken")).first()[0]
    assert words == total and plan


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10_000, "c": 1}, {"a": 0, "b": 5}, {"a": 3, None: 100, "z": 40, "zz": 1}])
def test_targets(spark, sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    df = spark.createDataFrame([(str(s), sizes[s], (5, 2, 1)[k % 3]) for k, s in enumerate(order)], "group string, size long, weight long")
    got = {r["group"]: r["target"] for r in mixing.targets(df, (5, 2, 1), Fraction(3, 2), 2).collect()}
    assert got == pytest.approx({str(s): float(t) for s, t in level(sizes).items()})
