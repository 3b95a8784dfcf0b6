"""Daily files through the streaming file-drop runner."""

import os

import pytest
from pyspark.sql import functions as F

from nightledger import fixtures as fx
from nightledger import schemas as sch
from nightledger.plans.daily_run import read_report
from nightledger.plans.store import Store
from nightledger.streaming.file_drop import run_file_drop


def _write(df, path, sep=";"):
    # test fixture files are small; written as single files like a real drop
    df.toPandas().to_csv(path, sep=sep, index=False, na_rep="")


def test_two_daily_drops(spark, sf_small, tmp_path):
    drop, archive = tmp_path / "drop", tmp_path / "archive"
    drop.mkdir()
    tx = fx.transactions_text(spark, sf_small).withColumn("_mod", F.col("transaction_id").cast("long") % 10)
    for label, day_tx in (("01022024", tx.where("_mod <> 9")), ("02022024", tx.where("_mod = 9"))):
        # in the feed's own column order, which is not the order the job keeps
        _write(day_tx.drop("_mod"), drop / f"transactions_{label}.txt")
        _write(fx.terminals_sheet(spark, sf_small), drop / f"terminals_file_{label}.csv")
        _write(fx.blacklist_sheet(spark, sf_small), drop / f"passport_blacklist_{label}.csv")

    # the file source takes files oldest first: make the order explicit
    for i, label in enumerate(("01022024", "02022024")):
        t = 1_700_000_000 + 3600 * i
        os.utime(drop / f"transactions_{label}.txt", (t, t))

    def snapshots(label):
        c, a, k = fx.clients(spark, sf_small), fx.source_accounts(spark, sf_small), fx.source_cards(spark, sf_small)
        return c, a, k

    store = Store(spark, str(tmp_path / "wh"))
    q = run_file_drop(spark, store, str(drop), str(tmp_path / "ckpt"), snapshots,
                      archive_dir=str(archive), batch_ts="2024-02-01 09:00:00", report_dt="2024-02-01")
    q.awaitTermination(600)
    assert q.exception() is None
    assert [d.isoformat() for d in store.committed_days()] == ["2024-02-01", "2024-02-02"]
    facts = store.read_days("dwh_fact_transactions", sch.FACT_TRANSACTIONS, store.committed_days())
    assert facts.count() == fx.transactions(spark, sf_small).count()
    assert read_report(store, "2024-02-01").count() > 0
    # a second start finds nothing new
    q2 = run_file_drop(spark, store, str(drop), str(tmp_path / "ckpt"), snapshots,
                       archive_dir=str(archive), batch_ts="2024-02-01 09:00:00", report_dt="2024-02-01")
    q2.awaitTermination(600)
    assert q2.lastProgress is None or q2.lastProgress["numInputRows"] == 0
    assert store.committed_days()[-1].isoformat() == "2024-02-02"
    assert sorted(os.listdir(archive)) == sorted(
        f for x in ("01022024", "02022024")
        for f in (f"transactions_{x}.txt", f"terminals_file_{x}.csv", f"passport_blacklist_{x}.csv"))
    assert [f for f in os.listdir(drop) if not f.startswith(".")] == []
    want = fx.transactions(spark, sf_small).select(*sch.FACT_TRANSACTIONS.names)
    want = want.withColumn("trans_date", F.date_trunc("second", "trans_date").cast("timestamp_ntz"))
    assert facts.exceptAll(want).count() == 0


def test_two_days_in_one_micro_batch(spark, sf_small, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    tx = fx.transactions_text(spark, sf_small).withColumn("_mod", F.col("transaction_id").cast("long") % 10)
    for i, (label, day_tx) in enumerate((("01022024", tx.where("_mod <> 9")), ("02022024", tx.where("_mod = 9")))):
        # in the feed's own column order, which is not the order the job keeps
        _write(day_tx.drop("_mod"), drop / f"transactions_{label}.txt")
        _write(fx.terminals_sheet(spark, sf_small), drop / f"terminals_file_{label}.csv")
        _write(fx.blacklist_sheet(spark, sf_small), drop / f"passport_blacklist_{label}.csv")

    def snapshots(label):
        return fx.clients(spark, sf_small), fx.source_accounts(spark, sf_small), fx.source_cards(spark, sf_small)

    store = Store(spark, str(tmp_path / "wh"))
    q = run_file_drop(spark, store, str(drop), str(tmp_path / "ckpt"), snapshots, files_per_batch=2,
                      batch_ts="2024-02-01 09:00:00", report_dt="2024-02-01")
    q.awaitTermination(600)
    assert q.exception() is None
    assert [d.isoformat() for d in store.committed_days()] == ["2024-02-01", "2024-02-02"]
    facts = store.read_days("dwh_fact_transactions", sch.FACT_TRANSACTIONS, store.committed_days())
    assert facts.count() == fx.transactions(spark, sf_small).count()


def test_replay_after_a_crash_skips_what_was_committed(spark, sf_small, tmp_path):
    """Both days of a micro-batch are committed, then the run dies before the stream's checkpoint."""
    drop = tmp_path / "drop"
    drop.mkdir()
    tx = fx.transactions_text(spark, sf_small).withColumn("_mod", F.col("transaction_id").cast("long") % 10)
    for label, day_tx in (("01022024", tx.where("_mod <> 9")), ("02022024", tx.where("_mod = 9"))):
        _write(day_tx.drop("_mod"), drop / f"transactions_{label}.txt")
        _write(fx.terminals_sheet(spark, sf_small), drop / f"terminals_file_{label}.csv")
        _write(fx.blacklist_sheet(spark, sf_small), drop / f"passport_blacklist_{label}.csv")

    class Dies(Store):
        def commit(self, day, *args, **kw):
            super().commit(day, *args, **kw)
            if day.isoformat() == "2024-02-02":
                raise RuntimeError("died after the second commit")

    asked = []

    def snapshots(label):
        asked.append(label)
        return fx.clients(spark, sf_small), fx.source_accounts(spark, sf_small), fx.source_cards(spark, sf_small)

    root, ckpt = str(tmp_path / "wh"), str(tmp_path / "ckpt")
    how = {"files_per_batch": 2, "batch_ts": "2024-02-01 09:00:00", "report_dt": "2024-02-01"}
    q = run_file_drop(spark, Dies(spark, root), str(drop), ckpt, snapshots, **how)
    with pytest.raises(Exception, match="died after the second commit"):
        q.awaitTermination(600)
    store = Store(spark, root)
    before = store.commits()
    assert len(before) == 2
    q = run_file_drop(spark, store, str(drop), ckpt, snapshots, **how)
    q.awaitTermination(600)
    assert q.exception() is None
    assert store.commits() == before
    assert asked == ["01022024", "02022024"]
