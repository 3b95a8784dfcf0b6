"""SCD1 / SCD2 operators: hand-made cases and invariants."""

import datetime as dt

from pyspark.sql import functions as F

from nightledger import fixtures as fx
from nightledger import schemas as sch
from nightledger.operators import scd

TS = "2024-02-01 09:00:00"
BTS = dt.datetime(2024, 2, 1, 9)
OLD = dt.datetime(2024, 1, 1)


def _dim(spark, rows):
    return spark.createDataFrame(rows, sch.DIM_TERMINALS)


def _snap(spark, rows):
    return spark.createDataFrame(rows, sch.STG_TERMINALS)


KEY, ATTRS = sch.dim_key("terminals"), sch.dim_attrs("terminals")


def test_scd1_null_safe_changes(spark):
    dim = _dim(spark, [("T1", "ATM", None, "a", OLD, None), ("T2", "ATM", "X", "a", OLD, None),
                       ("T3", "ATM", None, "a", OLD, None), ("T4", "ATM", "X", "a", OLD, None)])
    snap = _snap(spark, [("T1", "ATM", None, "a"), ("T2", "ATM", None, "a"),
                         ("T3", "ATM", "Y", "a"), ("T5", "POS", "Z", "b")])
    got = {r.terminal_id: r for r in scd.scd1_apply(dim, snap, KEY, ATTRS, TS).collect()}
    assert set(got) == {"T1", "T2", "T3", "T5"}                 # T4 deleted
    assert got["T1"].update_dt is None                           # null = null: unchanged
    assert got["T2"].terminal_city is None and got["T2"].update_dt == BTS
    assert got["T3"].terminal_city == "Y" and got["T3"].create_dt == OLD
    assert got["T5"].create_dt == BTS and got["T5"].update_dt is None
    assert [r.terminal_id for r in scd.scd1_delete(dim, snap, KEY, ATTRS).collect()] == ["T4"]


def test_scd1_all_changed_variant(spark):
    a = spark.createDataFrame([("A1", dt.date(2024, 1, 1), "C1", OLD, None),
                               ("A2", dt.date(2024, 1, 1), "C1", OLD, None)], sch.DIM_ACCOUNTS)
    s = spark.createDataFrame([("A1", dt.date(2024, 2, 1), "C1"), ("A2", dt.date(2024, 2, 1), "C2")],
                              "account_num string, valid_to date, client string")
    k, at = sch.dim_key("accounts"), sch.dim_attrs("accounts")
    assert {r.account_num for r in scd.scd1_update(a, s, k, at, TS).collect()} == {"A1", "A2"}
    assert {r.account_num for r in scd.scd1_update(a, s, k, at, TS, change="all").collect()} == {"A2"}


def test_scd2_versions(spark):
    hist = spark.createDataFrame([
        ("T1", "ATM", "A", "a", OLD, None, False),                          # unchanged
        ("T2", "ATM", "A", "a", OLD, None, False),                          # changes
        ("T2", "ATM", "OLD", "a", dt.datetime(2023, 1, 1), OLD, False),     # closed, differs
        ("T3", "ATM", "A", "a", OLD, None, False),                          # deleted
        ("T3", "ATM", "B", "a", dt.datetime(2023, 1, 1), OLD, False),
    ], sch.HIST["terminals"])
    snap = _snap(spark, [("T1", "ATM", "A", "a"), ("T2", "ATM", "B", "a"), ("T4", "POS", "C", "c")])
    ch = scd.scd2_changes(hist, snap, KEY, ATTRS, TS).collect()
    acts = sorted((r.terminal_id, r._action, r.terminal_city) for r in ch)
    assert acts == [("T1", "same", "A"), ("T2", "close", "A"), ("T2", "open", "B"), ("T2", "same", "OLD"),
                    ("T3", "delete", "A"), ("T3", "delete", "B"), ("T4", "insert", "C")]
    closed = [r for r in ch if r._action == "close"][0]
    assert closed.effective_to == BTS and closed.effective_from == OLD
    assert all(r.deleted for r in ch if r._action == "delete")
    assert [r.effective_to for r in ch if r._action == "delete" and r.terminal_city == "A"] == [None]


def test_apply_twice_changes_nothing_and_one_open_version(spark, sf_small):
    for d in sch.DIMENSIONS:
        key, attrs = sch.dim_key(d), sch.dim_attrs(d)
        snap = fx.todays_snapshot(spark, sf_small, d)
        once = scd.scd1_apply(fx.stored_dimension(spark, sf_small, d), snap, key, attrs, TS)
        twice = scd.scd1_apply(once, snap, key, attrs, "2024-02-02 09:00:00")
        assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))
        # the dimension equals the snapshot on keys and attributes
        assert once.select(key, *attrs).exceptAll(snap).count() == 0
        assert snap.exceptAll(once.select(key, *attrs)).count() == 0

        h1 = scd.scd2_apply(fx.stored_history(spark, sf_small, d), snap, key, attrs, TS)
        h2 = scd.scd2_apply(h1, snap, key, attrs, "2024-02-02 09:00:00")
        assert sorted(map(repr, h1.collect())) == sorted(map(repr, h2.collect()))
        open_per_key = h1.where(F.col("effective_to").isNull()).groupBy(key).count()
        assert open_per_key.where("count > 1").count() == 0


def test_null_keys_bypass_the_join(spark):
    dim = _dim(spark, [("T1", "ATM", "A", "a", OLD, None), (None, "ATM", "B", "b", OLD, None)])
    snap = _snap(spark, [("T1", "ATM", "A", "a"), (None, "POS", "C", "c"), (None, "POS", "D", "d")])
    got = scd.scd1_changes(dim, snap, KEY, ATTRS, TS).collect()
    acts = sorted((r._action, r.terminal_city) for r in got)
    assert acts == [("delete", "B"), ("insert", "C"), ("insert", "D"), ("same", "A")]


def test_returning_key_is_not_reopened(spark):
    """Q8 as written: a deleted key keeps its flag when it comes back
    unchanged; if it comes back changed, the flagged version is closed and
    a new live version opens."""
    hist = spark.createDataFrame([("T1", "ATM", "A", "a", OLD, None, False),
                                  ("T2", "ATM", "A", "a", OLD, None, False)], sch.HIST["terminals"])
    day1 = scd.scd2_apply(hist, _snap(spark, []), KEY, ATTRS, TS)
    assert all(r.deleted for r in day1.collect())
    back = _snap(spark, [("T1", "ATM", "A", "a"), ("T2", "ATM", "B", "a")])
    got = scd.scd2_changes(day1, back, KEY, ATTRS, "2024-02-02 09:00:00").collect()
    acts = sorted((r.terminal_id, r._action, r.terminal_city, r.deleted) for r in got)
    assert acts == [("T1", "same", "A", True), ("T2", "close", "A", True), ("T2", "open", "B", False)]


def test_history_invariant_check(spark):
    from nightledger.operators import quality
    hist = spark.createDataFrame([("T1", "ATM", "A", "a", OLD, None, False),
                                  ("T2", "ATM", "A", "a", OLD, BTS, False)], sch.HIST["terminals"])
    bad = [(r.key_value, r.n_open) for r in quality.open_version_violations(hist, KEY).collect()]
    assert bad == [("T2", 0)]
    built = scd.scd2_apply(hist.where("terminal_id = 'T1'"), _snap(spark, [("T1", "ATM", "B", "a")]),
                           KEY, ATTRS, TS)
    assert quality.open_version_violations(built, KEY).count() == 0
