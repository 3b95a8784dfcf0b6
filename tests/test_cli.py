"""The command-line daily run over a drop folder and file-based sources."""

from nightledger import fixtures as fx
from nightledger import schemas as sch
from nightledger.__main__ import main
from nightledger.plans.daily_run import read_report
from nightledger.plans.store import Store


def test_cli_runs_the_next_batch(spark, sf_small, tmp_path):
    drop, src = tmp_path / "drop", tmp_path / "src"
    drop.mkdir()
    label = sch.BATCH_LABEL_SEED
    fx.transactions_text(spark, sf_small).toPandas().to_csv(drop / f"transactions_{label}.txt", sep=";", index=False)
    fx.terminals_sheet(spark, sf_small).toPandas().to_csv(drop / f"terminals_file_{label}.csv", sep=";", index=False)
    fx.blacklist_sheet(spark, sf_small).toPandas().to_csv(drop / f"passport_blacklist_{label}.csv", sep=";",
                                                          index=False)
    fx.clients(spark, sf_small).write.parquet(str(src / "clients"))
    fx.source_accounts(spark, sf_small).write.parquet(str(src / "accounts"))
    fx.source_cards(spark, sf_small).write.parquet(str(src / "cards"))
    main(["--store", str(tmp_path / "wh"), "--drop", str(drop), "--sources", str(src),
          "--batch-ts", "2021-03-01 09:00:00", "--report-dt", "2021-03-01"])
    store = Store(spark, str(tmp_path / "wh"))
    assert store.next_label() == "02032021"
    full = read_report(store, "2021-03-01").count()
    assert full > 0
    # the same batch again, reporting only operations from 20 January on
    main(["--store", str(tmp_path / "wh"), "--drop", str(drop), "--sources", str(src), "--label", label,
          "--batch-ts", "2021-03-01 09:00:00", "--report-dt", "2021-03-01",
          "--report-since", "2024-01-20 00:00:00"])
    assert 0 < read_report(store, "2021-03-01").count() < full
