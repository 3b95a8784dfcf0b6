"""The daily run's steps do not shuffle, sort or join whole tables where a few keys or rows decide."""

import datetime as dt
from contextlib import contextmanager

from pyspark.sql import Window
from pyspark.sql import functions as F

from nightledger.operators import enriched_delta as delta
from nightledger.operators import quality
from nightledger.operators.sequence import PART, edge_rows, ordered_ranges
from nightledger.plans import buckets
from nightledger.plans.explain import plan_text

T0 = dt.datetime(2024, 1, 1)
CARDS = "card_num string, account_num string"


@contextmanager
def _broadcast_under(spark, size):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, size)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _cards(spark, tmp_path, n, extra=()):
    path = str(tmp_path / "cards")
    rows = spark.range(n).selectExpr("concat('K', id) AS card_num", "concat('A', id, '-', sha2(string(id), 256)) AS account_num")
    rows.unionByName(spark.createDataFrame(list(extra), CARDS)).write.parquet(path)
    return spark.read.parquet(path)


def test_rows_are_not_shuffled_for_a_few_repeated_keys(spark, tmp_path):
    cards = _cards(spark, tmp_path, 4000, [("K1", "A"), (None, "B")])
    with _broadcast_under(spark, "20KB"):
        good, bad = quality.set_aside(cards, ["card_num"], [])
        assert "SortMergeJoin" not in plan_text(good).split("\n\n")[0]
        assert good.count() == 4000
    assert sorted((r["card_num"] or "", r["reason"], r["n_rows"]) for r in bad.collect()) == [
        ("", "null_key", 1), ("K1", "duplicate_key", 1)]


def test_children_are_not_shuffled_for_a_few_lost_parents(spark, tmp_path):
    cards = _cards(spark, tmp_path, 4000, [("K1", "gone"), ("K2", "gone"), ("K3", None)])
    accounts = cards.where("account_num <> 'gone'").select("account_num")
    with _broadcast_under(spark, "20KB"):
        lost = quality.orphans(cards, "card_num", "account_num", accounts, "account_num", "cards->accounts")
        assert "SortMergeJoin" not in plan_text(lost)
        assert sorted((r["child_key"], r["fk_value"]) for r in lost.collect()) == [("K1", "gone"), ("K2", "gone")]


def test_repeated_keys_serve_both_checks(spark):
    rows = spark.createDataFrame([("t1", 1), ("t1", None), ("t2", 2), ("t2", 2), (None, 3), (None, 3)], "trans_id string, amt int")
    held = quality.repeated_keys(rows, ["trans_id"], ["amt"])
    found = quality.duplicate_keys(rows, ["trans_id"], "transactions", held)
    assert sorted((r["key_value"], r["n_rows"]) for r in found.collect()) == [("t1", 2), ("t2", 2)]
    for given in (held, None):
        good, bad = quality.set_aside(rows, ["trans_id"], ["amt"], given)
        assert sorted(map(tuple, good.collect())) == [("t1", 1), ("t2", 2)]
        assert sorted((r["trans_id"] or "", r["reason"], r["n_rows"]) for r in bad.collect()) == [
            ("", "null_key", 2), ("t1", "unparsed_value", 1), ("t2", "duplicate_key", 1)]


def test_edges_of_ranges_are_found_without_sorting(spark, many_ranges):
    rows = [(None if i % 50 == 0 else f"C{i % 7}", None if i % 11 == 0 else T0 + dt.timedelta(minutes=i % 90), f"{i:04d}") for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id string")
    with many_ranges():
        ranged = ordered_ranges(df, ["k"], ["t", "id"])
    assert ranged.select(PART).distinct().count() > 2
    for n, newest in ((1, True), (2, True), (1, False)):
        by = [F.col(c).desc_nulls_first() if newest else F.col(c).asc_nulls_last() for c in ("k", "t", "id")]
        want = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy(PART).orderBy(*by))).where(F.col("_rn") <= n)
        got = edge_rows(ranged, n, newest)
        assert "Window" not in plan_text(got) and "Sort" not in plan_text(got)
        cols = [PART, "k", "t", "id", "_rn"]
        assert sorted(map(repr, got.select(*cols).collect())) == sorted(map(repr, want.select(*cols).collect()))


def test_a_snapshot_is_digested_once(spark, monkeypatch):
    calls, plain = [], buckets.digests
    monkeypatch.setattr(buckets, "digests", lambda *a: calls.append(a) or plain(*a))
    rows = spark.createDataFrame([(f"K{i}", i if i % 3 else None) for i in range(500)], "k string, a int")
    seen = buckets.shared_digests(rows, "k", ["a"])
    got = seen(4)
    assert seen(4) is got and len(calls) == 1
    # the halves add up to the sum of the 64-bit hashes
    want = rows.groupBy(buckets.bucket_of("k", 4).alias("b")).agg(F.sum(buckets._hash(["k", "a"], "a").cast("decimal(38,0)")).alias("t"))
    assert {b: d[1] for b, (_, d) in got.items()} == {r["b"]: int(r["t"]) for r in want.collect()}


def test_rows_of_the_newest_patch_are_not_looked_up(spark, tmp_path):
    parts = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "a"), (None, "a")], "trans_id string, x string")
    assert delta.current(parts, spark.createDataFrame([], "trans_id string, v int"), parts.withColumn("v", F.lit(1)).limit(0)) is parts
    ids = spark.createDataFrame([("1", 1), ("2", 1), ("2", 2), (None, 2)], "trans_id string, v int")
    # of id 2 no row is left by the second patch
    rows = spark.createDataFrame([("1", "b", 1), ("2", "b", 1), (None, "c", 2)], "trans_id string, x string, v int")
    got = delta.current(parts, ids, rows)
    assert sorted((r["trans_id"] or "", r["x"]) for r in got.collect()) == [("", "c"), ("1", "b"), ("3", "a")]
