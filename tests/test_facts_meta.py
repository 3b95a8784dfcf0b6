"""Facts (D8, D9), metadata (D10-D12), control (S1, S13), quality (K1-K6)."""

import datetime as dt

from nightledger import schemas as sch
from nightledger.operators import facts, meta, quality
from nightledger.sources import control, files

T = dt.datetime(2024, 1, 1)


def test_blacklist_append_semantics(spark):
    stored = spark.createDataFrame([("P1", T)], sch.FACT_BLACKLIST)
    staged = spark.createDataFrame([("P1", T), ("P2", T), ("P2", T), (None, T)], sch.STG_BLACKLIST)
    got = sorted(facts.new_blacklist_entries(staged, stored).collect(), key=lambda r: str(r[0]))
    assert [r.passport_num for r in got] == [None, "P2", "P2"]


def test_meta_high_water_keeps_previous_without_updates(spark):
    m = meta.seed(spark)
    dims = {"dwh_dim_terminals": spark.createDataFrame([("T1", "a", "b", "c", T, None)], sch.DIM_TERMINALS),
            "dwh_dim_cards": spark.createDataFrame([("K1", "A1", T, dt.datetime(2024, 2, 1))], sch.DIM_CARDS)}
    got = {r.table_name: r.max_update_dt for r in meta.high_water_marks(m, dims).collect()}
    assert got["dwh_dim_terminals"] == dt.datetime(1900, 1, 1)
    assert got["dwh_dim_cards"] == dt.datetime(2024, 2, 1)
    stamped = {r.table_name: r.max_update_dt
               for r in meta.stamp_load_time(m, ["dwh_fact_blacklist"], "2024-02-01 09:00:00").collect()}
    assert stamped["dwh_fact_blacklist"] == dt.datetime(2024, 2, 1, 9)
    assert len(stamped) == 10


def test_control_label(spark):
    c = control.control_table(spark)
    assert control.read_batch_label(c) == "01032021"
    assert control.read_batch_label(control.advance(c)) == "02032021"


def test_transactions_file_by_name_and_quality(spark, tmp_path):
    p = tmp_path / "transactions_01032021.txt"
    p.write_text("amount;transaction_id;transaction_date;card_num;oper_type;terminal;oper_result\n"
                 "8378,05;1;2021-03-01 00:00:01; K1-0 \t;PAY;T1;SUCCESS\n"
                 "x;2;2021-03-01 00:00:02;K1-0;PAY;T1;REJECT\n")
    df = files.read_transactions_file(spark, str(p))
    rows = df.orderBy("trans_id").collect()
    assert df.columns == sch.STG_TRANSACTIONS.names
    assert str(rows[0].amt) == "8378.05" and rows[0].card_num == "K1-0"
    assert rows[1].amt is None
    assert quality.bad_amount_rows(files.read_text_table(spark, str(p))).count() == 1


def test_quality_checks(spark):
    cards = spark.createDataFrame([("K1", "A1", T, None), ("K1", "A9", T, None), (None, None, T, None)],
                                  sch.STG_CARDS)
    accounts = spark.createDataFrame([("A1", dt.date(2024, 1, 1), "C1", T, None)], sch.STG_ACCOUNTS)
    got = quality.check_all({"cards": cards, "accounts": accounts})
    assert [(r.table_name, r.key_value, r.n_rows) for r in got["duplicate_keys"].collect()] == [("cards", "K1", 2)]
    nulls = {r.table_name: r.n_null_keys for r in got["null_keys"].collect()}
    assert nulls == {"cards": 1, "accounts": 0}
    assert [(r.child_key, r.fk_value) for r in got["orphans"].collect()] == [("K1", "A9")]


def test_source_table_and_staging(spark, tmp_path):
    from nightledger.sources import tables
    src = spark.createDataFrame([("  K1-0 \t", "A1", T, None, "extra")],
                                "card_num string, account_num string, create_dt timestamp_ntz, "
                                "update_dt timestamp_ntz, spare string")
    src.write.parquet(str(tmp_path / "cards"))
    got = tables.stage_cards(tables.read_source_table(spark, "info.cards", path=str(tmp_path / "cards")))
    assert got.columns == sch.STG_CARDS.names and got.first().card_num == "K1-0"
    acc = spark.createDataFrame([("A1", dt.datetime(2024, 3, 1, 17, 30), "C1", T, None)], sch.SRC_ACCOUNTS)
    assert tables.stage_accounts(acc).first().valid_to == dt.date(2024, 3, 1)


def test_missing_file_column_is_null(spark, tmp_path):
    p = tmp_path / "transactions_02032021.txt"
    p.write_text("transaction_id;transaction_date;amount;card_num;oper_type;oper_result\n"
                 "7;2021-03-02 10:00:00;1,5;K1;PAY;SUCCESS\n")
    r = files.read_transactions_file(spark, str(p)).first()
    assert r.terminal is None and str(r.amt) == "1.50"


def test_terminals_by_position_and_blacklist_by_name(spark, tmp_path):
    t = tmp_path / "terminals.csv"
    t.write_text("id;kind;town;street\nT1;ATM;Moscow;Lenina 1\n")
    assert tuple(files.read_terminals_file(spark, str(t)).first()) == ("T1", "ATM", "Moscow", "Lenina 1")
    b = tmp_path / "blacklist.csv"
    b.write_text("date;passport\n2021-03-01 00:00:00;P1\n")
    r = files.read_blacklist_file(spark, str(b)).first()
    assert (r.passport_num, r.entry_dt) == ("P1", dt.datetime(2021, 3, 1))


def test_fact_append_twice_adds_nothing(spark, sf_small):
    from nightledger import fixtures as fx
    stored = fx.stored_transactions(spark, sf_small)
    incoming = fx.transactions(spark, sf_small)
    new = facts.new_transactions(incoming, stored)
    after = stored.unionByName(new)
    assert new.count() == incoming.count() - stored.count()
    assert facts.new_transactions(incoming, after).count() == 0
    bl_new = facts.new_blacklist_entries(fx.incoming_blacklist(spark, sf_small), fx.stored_blacklist(spark, sf_small))
    bl_after = fx.stored_blacklist(spark, sf_small).unionByName(bl_new)
    assert facts.new_blacklist_entries(fx.incoming_blacklist(spark, sf_small), bl_after).count() == 0


def test_terminals_sheet_from_parquet(spark, tmp_path):
    df = spark.createDataFrame([("T1", "ATM", "Moscow", "Lenina 1", "extra")], "a string, b string, c string, "
                               "d string, e string")
    df.write.parquet(str(tmp_path / "t"))
    assert tuple(files.read_terminals_file(spark, str(tmp_path / "t"), fmt="parquet").first()) == \
        ("T1", "ATM", "Moscow", "Lenina 1")


def test_xlsx_sheets_need_openpyxl(spark, tmp_path):
    import pytest
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        with pytest.raises(RuntimeError, match="openpyxl"):
            files.read_terminals_file(spark, str(tmp_path), fmt="xlsx")
        return
    import pandas as pd
    pd.DataFrame({"id": ["T1"], "kind": ["ATM"], "town": ["Moscow"], "street": ["Lenina 1"]}).to_excel(
        tmp_path / "terminals_file_01032021.xlsx", index=False)
    pd.DataFrame({"date": ["2021-03-01 00:00:00"], "passport": ["P1"]}).to_excel(
        tmp_path / "passport_blacklist_01032021.xlsx", index=False)
    t = files.read_terminals_file(spark, str(tmp_path / "terminals_file_01032021.xlsx"), fmt="xlsx")
    assert tuple(t.first()) == ("T1", "ATM", "Moscow", "Lenina 1")
    b = files.read_blacklist_file(spark, str(tmp_path / "passport_blacklist_01032021.xlsx"), fmt="xlsx")
    assert b.first().passport_num == "P1"


def test_violations_in_one_shape(spark):
    cards = spark.createDataFrame([("K1", "A1", T, None), ("K1", "A9", T, None)], sch.STG_CARDS)
    accounts = spark.createDataFrame([("A1", dt.date(2024, 1, 1), "C1", T, None)], sch.STG_ACCOUNTS)
    tx = spark.createDataFrame([("1", None, "K1", "PAY", None, "SUCCESS", "T1")], sch.STG_TRANSACTIONS)
    got = sorted((r.check, r.table_name, r.key_value, r.detail)
                 for r in quality.violations({"cards": cards, "accounts": accounts, "transactions": tx}).collect())
    assert got == [("duplicate_key", "cards", "K1", "2"),
                   ("orphan", "cards.account_num->accounts", "K1", "A9"),
                   ("unparsed_value", "transactions", "1", "amt,trans_date")]


def test_jdbc_source_reaches_the_driver_lookup(spark):
    """No database may run here: check the partitioned JDBC read is built
    and fails only where a connection would be made."""
    import pytest
    from nightledger.sources import tables
    with pytest.raises(Exception, match="No suitable driver"):
        tables.read_source_table(spark, "info.clients", fmt="jdbc", jdbc_url="jdbc:nosuchdb:x",
                                 properties={"user": "u"}, partition_column="id", lower_bound=0,
                                 upper_bound=100, num_partitions=4)
