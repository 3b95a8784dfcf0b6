"""Two daily runs through the versioned store; a rerun is a no-op."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from nightledger import fixtures as fx
from nightledger import schemas as sch
from nightledger.operators import rules
from nightledger.operators.enrich import enrich
from nightledger.plans.daily_run import BatchOrderError, DailyInputs, next_batch_label, read_report, run_day
from nightledger.plans.store import Store


def _inputs(spark, sf, day: int) -> DailyInputs:
    return DailyInputs(**fx.daily_staging(spark, sf, day))


def _snapshot_of(store, day):
    out = {}
    for d in sch.DIMENSIONS:
        out[d] = sorted(map(repr, store.read(sch.DIM_TABLES[d], sch.DIM[d], day).collect()))
        out[d + "_h"] = sorted(map(repr, store.read(sch.HIST_TABLES[d], sch.HIST[d], day).collect()))
    out["meta"] = sorted(map(repr, store.read("meta_dwh", sch.META, day).collect()))
    out["report"] = sorted(map(repr, read_report(store, "2024-02-02").collect()))
    return out


def test_two_days_and_rerun(spark, sf_small, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    run_day(store, "01022024", _inputs(spark, sf_small, 1), batch_ts="2024-02-01 09:00:00",
            report_dt="2024-02-01")
    run_day(store, "02022024", _inputs(spark, sf_small, 2), batch_ts="2024-02-02 09:00:00",
            report_dt="2024-02-02")
    assert store.committed_days() == [dt.date(2024, 2, 1), dt.date(2024, 2, 2)]
    assert store.next_label() == "03022024" == next_batch_label(store)
    assert next_batch_label(Store(spark, str(tmp_path / "empty"))) == sch.BATCH_LABEL_SEED
    d2 = dt.date(2024, 2, 2)
    # dimensions equal today's snapshot; history has closed + open versions
    for d in sch.DIMENSIONS:
        key, attrs = sch.dim_key(d), sch.dim_attrs(d)
        dim = store.read(sch.DIM_TABLES[d], sch.DIM[d], d2).select(key, *attrs)
        snap = fx.todays_snapshot(spark, sf_small, d)
        assert dim.exceptAll(snap).count() == 0 and snap.exceptAll(dim).count() == 0
    tx = store.read_days("dwh_fact_transactions", sch.FACT_TRANSACTIONS, store.committed_days())
    assert tx.count() == fx.transactions(spark, sf_small).count()
    rep = read_report(store, "2024-02-02").drop("report_dt")
    rep_rows = sorted(map(repr, rep.collect()))
    assert rep_rows
    # the report of day 2 equals the rules over the full history and day-2 dimensions
    snap = {d: fx.todays_snapshot(spark, sf_small, d) for d in sch.DIMENSIONS}
    bl = fx.stored_blacklist(spark, sf_small).unionByName(fx.incoming_blacklist(spark, sf_small))
    e = enrich(fx.transactions(spark, sf_small), snap["cards"], snap["terminals"], snap["accounts"],
               snap["clients"], blacklist=bl)
    want = rules.fraud_report(e, "2024-02-02").drop("report_dt")
    assert sorted(map(repr, want.collect())) == rep_rows
    first = _snapshot_of(store, d2)
    run_day(store, "02022024", _inputs(spark, sf_small, 2), batch_ts="2024-02-02 09:00:00",
            report_dt="2024-02-02")
    assert _snapshot_of(store, d2) == first
    assert sorted(map(repr, read_report(store, "2024-02-02").drop("report_dt").collect())) == rep_rows


def test_report_since_in_the_daily_run(spark, sf_small, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    run_day(store, "01022024", _inputs(spark, sf_small, 1), batch_ts="2024-02-01 09:00:00",
            report_dt="2024-02-01")
    since = "2024-01-25 00:00:00"
    run_day(store, "02022024", _inputs(spark, sf_small, 2), batch_ts="2024-02-02 09:00:00",
            report_dt="2024-02-02", report_since=since)
    snap = {d: fx.todays_snapshot(spark, sf_small, d) for d in sch.DIMENSIONS}
    bl = fx.stored_blacklist(spark, sf_small).unionByName(fx.incoming_blacklist(spark, sf_small))
    e = enrich(fx.transactions(spark, sf_small), snap["cards"], snap["terminals"], snap["accounts"],
               snap["clients"], blacklist=bl)
    want = rules.fraud_report(e, "2024-02-02").where(F.col("event_dt") >= F.lit(since).cast("timestamp_ntz"))
    got = read_report(store, "2024-02-02")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_dimension_orphans_are_reported(spark, sf_small, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    run_day(store, "02022024", _inputs(spark, sf_small, 2), batch_ts="2024-02-02 09:00:00",
            report_dt="2024-02-02")
    orphans = spark.read.parquet(store.path("_dwh_orphans", "v=2024-02-02"))
    # all four references are checked
    assert {r["relation"].split(".")[0] for r in orphans.select("relation").distinct().collect()} <= {"accounts", "cards", "transactions"}
    assert orphans.where("relation like 'transactions.card%'").count() > 0
    # cards of accounts missing from today's snapshot (k % 10 = 8) stay behind
    assert orphans.where("relation = 'cards.account_num->accounts'").count() > 0


def test_fail_mode_stops_before_publishing(spark, sf_small, tmp_path):
    import pytest
    from nightledger.plans.daily_run import QualityError
    store = Store(spark, str(tmp_path / "wh"))
    staged = fx.daily_staging(spark, sf_small, 2)
    staged["cards"] = staged["cards"].unionByName(staged["cards"].limit(1))   # a duplicate key
    with pytest.raises(QualityError):
        run_day(store, "02022024", DailyInputs(**staged), batch_ts="2024-02-02 09:00:00",
                report_dt="2024-02-02", on_violation="fail")
    assert store.committed_days() == []


def test_uncommitted_batch_is_invisible(spark, sf_small, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    run_day(store, "01022024", _inputs(spark, sf_small, 1), batch_ts="2024-02-01 09:00:00",
            report_dt="2024-02-01")
    # a run for 2 Feb that died after writing facts and report, before its commit marker
    junk = fx.transactions(spark, sf_small).limit(5)
    d2 = dt.date(2024, 2, 2)
    report = read_report(store, "2024-02-01")
    store.write("dwh_fact_transactions", d2, "dead", junk)
    store.write("rep_fraud", d2, "dead", report)
    assert store.committed_days() == [dt.date(2024, 2, 1)]
    visible = store.read_days("dwh_fact_transactions", sch.FACT_TRANSACTIONS, store.committed_days())
    assert visible.count() == fx.stored_transactions(spark, sf_small).count()
    assert read_report(store, "2024-02-01").count() == report.count()


@pytest.fixture(scope="module")
def small_inputs(spark):
    """A tiny bank: the same snapshot and one transaction per day."""
    def make(day: int, **change) -> DailyInputs:
        rows = {
            "transactions": [(f"t{day}", dt.datetime(2024, 2, day, 10), "K1", "PAY", Decimal("10.00"), "SUCCESS", "T1")],
            "terminals": [("T1", "ATM", "Oslo", "street")], "blacklist": [("P9", dt.datetime(2024, 1, 1))],
            "clients": [("C1", "A", "B", "C", dt.date(1990, 1, 1), "P1", dt.date(2020, 1, 1), "1", None, None)],
            "accounts": [("A1", dt.date(2023, 1, 1), "C1", None, None)], "cards": [("K1", "A1", None, None)]} | change
        return DailyInputs(**{t: spark.createDataFrame(r, getattr(sch, f"STG_{t.upper()}")) for t, r in rows.items()})
    return make


def _run(store, day, inputs, **kw):
    run_day(store, f"{day:02d}022024", inputs, batch_ts=f"2024-02-{day:02d} 09:00:00", report_dt="2024-02-05", **kw)


def test_batches_are_taken_in_order(spark, small_inputs, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    _run(store, 2, small_inputs(2))
    for wrong in (1, 4):
        with pytest.raises(BatchOrderError):
            _run(store, wrong, small_inputs(wrong))
    _run(store, 3, small_inputs(3))
    with pytest.raises(BatchOrderError):
        _run(store, 2, small_inputs(2))
    facts = store.read_days("dwh_fact_transactions", sch.FACT_TRANSACTIONS, store.committed_days())
    assert sorted(r["trans_id"] for r in facts.collect()) == ["t2", "t3"]


def test_batches_on_one_date_append_their_reports(spark, small_inputs, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    _run(store, 1, small_inputs(1))
    one = read_report(store, "2024-02-05").collect()
    _run(store, 2, small_inputs(2))
    both = read_report(store, "2024-02-05").collect()
    # the expired contract and passport of day 1 are reported again by day 2, with its own
    assert len(one) == 2 and len(both) == 6
    _run(store, 2, small_inputs(2))
    assert len(read_report(store, "2024-02-05").collect()) == 6  # a rerun replaces its own rows


def test_a_rerun_that_dies_leaves_the_commit(spark, small_inputs, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "wh"))
    _run(store, 1, small_inputs(1))
    want = _small_state(store)
    monkeypatch.setattr(rules, "fraud_report", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        _run(store, 1, small_inputs(1, cards=[]))
    assert _small_state(store) == want


def _small_state(store):
    return [sorted(map(repr, store.read(sch.DIM_TABLES[d], sch.DIM[d], store.committed_days()[-1]).collect())) for d in sch.DIMENSIONS]


def test_a_missing_committed_folder_is_an_error(spark, small_inputs, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    _run(store, 1, small_inputs(1))
    folder = tmp_path / "wh" / "dwh_fact_transactions"
    folder.rename(tmp_path / "elsewhere")
    with pytest.raises(AnalysisException):
        _run(store, 2, small_inputs(2))


def test_rows_that_break_a_key_are_set_aside(spark, small_inputs, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    bad = {"cards": [("K1", "A1", None, None), ("K1", "A1", None, None), ("K1", "A2", None, None), (None, "A1", None, None)],
           "transactions": [("t1", None, "K1", "PAY", Decimal("1.00"), "SUCCESS", "T1"),
                            ("t2", dt.datetime(2024, 2, 1), "K1", "PAY", None, "SUCCESS", "T1"),
                            ("t3", dt.datetime(2024, 2, 1), "K1", "PAY", Decimal("1.00"), "SUCCESS", "T1")]}
    for day in range(1, 3):
        _run(store, day, small_inputs(day, **bad))
        d = dt.date(2024, 2, day)
        assert [r["card_num"] for r in store.read("dwh_dim_cards", sch.DIM["cards"], d).collect()] == ["K1"]
        assert store.read(sch.HIST_TABLES["cards"], sch.HIST["cards"], d).count() == 1
    aside = spark.read.parquet(store.path("_quarantine", "cards", "v=2024-02-02"))
    assert sorted((r["reason"], r["n_rows"], r["account_num"]) for r in aside.collect()) == [
        ("duplicate_key", 1, "A1"), ("duplicate_key", 1, "A2"), ("null_key", 1, "A1")]
    aside = spark.read.parquet(store.path("_quarantine", "transactions", "v=2024-02-01"))
    assert {r["trans_id"]: r["reason"] for r in aside.collect()} == {"t1": "unparsed_value", "t2": "unparsed_value"}
