"""Fraud rules F1-F4 on hand-made rows, and the look-back by ranges."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from nightledger.operators import rules
from nightledger.operators.sequence import lag_name, ordered_lags
from nightledger import schemas as sch

ENRICHED = ("trans_id string, trans_date timestamp_ntz, amt decimal(18,2), oper_result string, "
            "passport_valid_to date, passport_num string, fio string, phone string, "
            "terminal_city string, account_num string, valid_to date, client_id string")
T0 = dt.datetime(2021, 3, 1, 10, 0)


def row(tid, t, amt=Decimal("1.00"), res="SUCCESS", city="A", client="C1", passport="P1",
        pvalid=dt.date(2030, 1, 1), valid=dt.date(2030, 1, 1)):
    return (tid, t, amt, res, pvalid, passport, "F I O", "+7", city, "A1", valid, client)


def test_passport_rule_midnight_and_blacklist(spark):
    e = spark.createDataFrame([
        row("1", dt.datetime(2021, 3, 1, 0, 0, 0), pvalid=dt.date(2021, 3, 1)),
        row("2", dt.datetime(2021, 3, 1, 0, 0, 1), pvalid=dt.date(2021, 3, 1)),
        row("3", T0, passport="P9"),
        row("4", T0, passport=None),
    ], ENRICHED)
    bl = spark.createDataFrame([("P9", T0), ("P9", T0), (None, T0)], sch.STG_BLACKLIST)
    got = rules.fraud_passport(e, "2021-03-02", bl).collect()
    assert sorted((r.event_dt, r.passport) for r in got) == [
        (dt.datetime(2021, 3, 1, 0, 0, 1), "P1"), (T0, "P9")]
    assert got[0].report_dt == dt.date(2021, 3, 2)
    assert {r.event_type for r in got} == {sch.EVENT_PASSPORT}


def test_contract_rule(spark):
    e = spark.createDataFrame([row("1", T0, valid=dt.date(2021, 3, 1)),
                               row("2", T0, valid=dt.date(2021, 3, 2)),
                               row("3", T0, valid=None)], ENRICHED)
    assert [r.event_dt for r in rules.fraud_contract(e, "2021-03-02").collect()] == [T0]


def test_multi_city_rule_uses_clock_hours(spark):
    h = lambda H, M, S=0: dt.datetime(2021, 3, 1, H, M, S)
    e = spark.createDataFrame([
        row("1", h(10, 59), city="A"), row("2", h(11, 1), city="B"),          # different hours
        row("3", h(12, 1), city="A"), row("4", h(12, 59), city="B"),          # flagged
        row("5", h(13, 1), city="A"), row("6", h(13, 30), city=None),         # null city
        row("7", h(14, 0), city="A", client="C2"), row("8", h(14, 0), city="A", client="C2"),
        row("9", h(14, 5), city="B", client="C2"),                            # same second twice
    ], ENRICHED)
    got = sorted((r.event_dt, r.passport) for r in rules.fraud_multi_city(e, "2021-03-02").collect())
    assert got == [(h(12, 1), "P1"), (h(12, 59), "P1"), (h(14, 0), "P1"), (h(14, 5), "P1")]


def _probe_rows(gaps_min, amts=("30.00", "20.00", "10.00"), client="C1", start=T0, id0=0):
    rows, t = [], start
    results = ["REJECT", "REJECT", "SUCCESS"]
    for i, (g, a, r) in enumerate(zip([0] + list(gaps_min), amts, results)):
        t = t + dt.timedelta(minutes=g)
        rows.append(row(str(id0 + i), t, amt=Decimal(a), res=r, client=client))
    return rows


def test_amount_probe_as_written_and_elapsed(spark):
    day = dt.timedelta(days=1)
    rows = (_probe_rows([5, 5], client="C1")                       # sum 15 -> hit both
            + _probe_rows([10, 10], client="C2", id0=10)          # (t-t1)+(t-t2) = 10+20 = 30 -> no
            + _probe_rows([0, 10], client="C3", id0=20)           # 10+10 = 20 -> hit (as written)
            + _probe_rows([60, 2.5], client="C4", id0=30)         # 2.5 + 62.5 = 65 -> minute field 5 -> hit
            + _probe_rows([1, 1], amts=("30.00", "30.00", "10.00"), client="C5", id0=40)  # equal amounts
            + _probe_rows([5, 5], client="C6", start=T0 + day, id0=50))
    # a second operation of C6 at the very time of the hit: reported too
    rows.append(row("59", T0 + day + dt.timedelta(minutes=10), amt=Decimal("99.00"), client="C6"))
    e = spark.createDataFrame(rows, ENRICHED)
    got = sorted((r.event_dt, r.passport) for r in rules.fraud_amount_probe(e, "2021-03-03").collect())
    want = sorted([(T0 + dt.timedelta(minutes=10), "P1"), (T0 + dt.timedelta(minutes=10), "P1"),
                   (T0 + dt.timedelta(minutes=62.5), "P1"),
                   (T0 + day + dt.timedelta(minutes=10), "P1"), (T0 + day + dt.timedelta(minutes=10), "P1")])
    # C1 hit, C3 hit, C4 hit, C6 hit + its same-instant row; C1 and C3 share a timestamp
    assert len(got) == 5 and got == want
    el = rules.fraud_amount_probe_elapsed(e, "2021-03-03").collect()
    # elapsed t - t2 <= 20 min: C1 (10), C2 (20), C3 (10), C6 (10, and its twin); not C4 (62.5)
    assert len(el) == 5


def test_ordered_lags_match_a_plain_window(spark, many_ranges):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        k = "hot" if i % 3 else f"c{rnd.randrange(5)}"
        t = base + dt.timedelta(minutes=rnd.randrange(0, 60 * 30))
        rows.append((k, t, f"{i:04d}", rnd.randrange(100)))
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id string, v int")
    with many_ranges():
        got = ordered_lags(df, ["k"], ["t", "id"], ["v"], n=2, rank_col="rk")
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.select("k", "id", F.row_number().over(w).alias("rk"),
                     *[F.lag(c, i).over(w).alias(lag_name(c, i)) for c in ("t", "id", "v") for i in (1, 2)])
    cols = ["k", "id", "rk"] + [lag_name(c, i) for c in ("t", "id", "v") for i in (1, 2)]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_fused_report_equals_rules_appended(spark, many_ranges):
    h = lambda H, M, S=0: dt.datetime(2021, 3, 1, H, M, S)
    rows = (_probe_rows([5, 5], client="C1") + _probe_rows([0, 10], client="C3", id0=20)
            + [row("90", h(12, 1), city="A", client="C7", pvalid=dt.date(2021, 3, 1)),
               row("91", h(12, 1), city="A", client="C7"), row("92", h(12, 59), city="B", client="C7",
                                                                valid=dt.date(2021, 1, 1)),
               row("93", h(13, 0), city=None, client="C8", passport="P9")])
    e = spark.createDataFrame(rows, ENRICHED)
    bl = spark.createDataFrame([("P9", T0)], sch.STG_BLACKLIST)
    with many_ranges():
        fused = rules.fraud_report(e, "2021-03-02", bl).collect()
    by_rule = rules.fraud_report_by_rule(e, "2021-03-02", bl).collect()
    assert sorted(map(repr, fused)) == sorted(map(repr, by_rule))
    assert {r.event_type for r in fused} == {sch.EVENT_PASSPORT, sch.EVENT_CONTRACT,
                                            sch.EVENT_MULTI_CITY, sch.EVENT_AMOUNT_PROBE}


def test_every_report_row_comes_from_an_enriched_row(spark, sf_small):
    from nightledger.plans.catalog import enriched
    e = enriched(spark, sf_small, with_blacklist=True)
    rep = rules.fraud_report(e, "2024-02-01")
    keys = e.select(F.col("trans_date").alias("event_dt"), F.col("passport_num").alias("passport"))
    assert rep.count() > 0
    assert rep.join(keys, ["event_dt", "passport"], "left_anti").count() == 0


def test_report_since_equals_full_report_after_since(spark):
    from nightledger.operators.enrich import enrich
    D = lambda H, M: dt.datetime(2021, 3, 1, H, M)
    tx = spark.createDataFrame([
        ("1", D(9, 0), "K1", "PAY", Decimal("30.00"), "REJECT", "T1"),
        ("2", D(9, 5), "K2", "PAY", Decimal("20.00"), "REJECT", "T1"),
        ("3", D(9, 6), "K1", "PAY", Decimal("99.00"), "SUCCESS", "TX"),   # unknown terminal
        ("4", D(9, 7), "K1", "PAY", Decimal("98.00"), "SUCCESS", "TX"),   # unknown terminal
        ("5", D(10, 10), "K2", "PAY", Decimal("10.00"), "SUCCESS", "T1"),
        ("6", D(10, 20), "K1", "PAY", Decimal("5.00"), "SUCCESS", "T2"),
    ], sch.FACT_TRANSACTIONS)
    cards = spark.createDataFrame([("K1", "A1", T0, None), ("K2", "A1", T0, None)], sch.DIM_CARDS)
    accounts = spark.createDataFrame([("A1", dt.date(2021, 3, 1), "C1", T0, None)], sch.DIM_ACCOUNTS)
    clients = spark.createDataFrame([("C1", "L", "F", None, dt.date(1990, 1, 1), "P1", dt.date(2030, 1, 1),
                                      "+7", T0, None)], sch.DIM_CLIENTS)
    terms = spark.createDataFrame([("T1", "ATM", "A", "x", T0, None), ("T2", "ATM", "B", "y", T0, None)],
                                  sch.DIM_TERMINALS)
    bl = spark.createDataFrame([], sch.STG_BLACKLIST)
    full = rules.fraud_report(enrich(tx, cards, terms, accounts, clients, blacklist=bl), "2021-03-02")
    since = "2021-03-01 10:05:00"
    want = sorted(map(repr, full.where(F.col("event_dt") >= F.lit(since).cast("timestamp_ntz")).collect()))
    got = sorted(map(repr, rules.fraud_report_since(tx, cards, terms, accounts, clients, bl, since,
                                                   "2021-03-02").collect()))
    assert got == want
    assert any(sch.EVENT_AMOUNT_PROBE in r for r in got)     # the look-back reached into history


def test_a_hot_hour_spreads_over_ranges(spark, many_ranges):
    """A third of all rows in one clock hour of one client, and of these many at one instant: several
    tasks share them, and every rule reports what the plain forms report."""
    from nightledger.operators.sequence import PART, ordered_ranges
    rnd = random.Random(3)
    rows = [row(f"{i:05d}", T0 + dt.timedelta(hours=9, seconds=rnd.randrange(1200) if i % 2 else 7),
                amt=Decimal(rnd.randrange(1, 9)), res=rnd.choice(["REJECT", "REJECT", "SUCCESS"]),
                city="B" if i == 40 else "A") for i in range(300)]
    rows += [row(f"{i:05d}", T0 + dt.timedelta(minutes=rnd.randrange(3000)), amt=Decimal(rnd.randrange(1, 9)),
                 res=rnd.choice(["REJECT", "SUCCESS"]), city=rnd.choice("AB"), client=f"C{rnd.randrange(2, 9)}") for i in range(300, 900)]
    e = spark.createDataFrame(rows, ENRICHED)
    bl = spark.createDataFrame([("P9", T0)], sch.STG_BLACKLIST)
    with many_ranges():
        ranged = ordered_ranges(e, ["client_id"], ["trans_date", "trans_id"])
        parts = {r[PART] for r in ranged.where("client_id = 'C1'").select(PART).collect()}
        fused = sorted(map(repr, rules.fraud_report(e, "2021-03-02", bl).collect()))
    assert len(parts) > 2
    # plain windows over whole clients
    w = Window.partitionBy("client_id").orderBy("trans_date", "trans_id")
    lagged = e.select("*", *[F.lag(c, i).over(w).alias(lag_name(c, i)) for c in ("trans_date", "amt", "oper_result") for i in (1, 2)])
    hits = lagged.where(rules._probe_pattern() & rules.probe_gap_as_written()).select("client_id", "trans_date")
    probes = rules._report(e.join(hits, ["client_id", "trans_date"]), sch.EVENT_AMOUNT_PROBE, "2021-03-02")
    want = (rules.fraud_passport(e, "2021-03-02", bl).unionByName(rules.fraud_contract(e, "2021-03-02"))
            .unionByName(rules.fraud_multi_city(e, "2021-03-02")).unionByName(probes))
    assert fused == sorted(map(repr, want.collect())) and any(sch.EVENT_AMOUNT_PROBE in r for r in fused)
