"""Property tests: SCD invariants on random snapshots, and the look-back by
ranges against a plain window on random orderings."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from nightledger import schemas as sch
from nightledger.operators import scd
from nightledger.operators.sequence import lag_name, ordered_lags


KEY, ATTRS = sch.dim_key("terminals"), sch.dim_attrs("terminals")
T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

val = st.sampled_from([None, "a", "b"])
snapshot = st.dictionaries(st.sampled_from([f"T{i}" for i in range(8)]),
                           st.tuples(val, val, val), max_size=8)


def _snap(spark, d):
    return spark.createDataFrame([(k, *v) for k, v in d.items()], sch.STG_TERMINALS)


@SETTINGS
@given(prev=snapshot, curr=snapshot, nxt=snapshot)
def test_scd_invariants(spark, prev, curr, nxt):
    empty_dim = spark.createDataFrame([], sch.DIM_TERMINALS)
    empty_hist = spark.createDataFrame([], sch.HIST["terminals"])
    dim, hist = empty_dim, empty_hist
    for i, snap_d in enumerate((prev, curr, nxt)):
        snap = _snap(spark, snap_d)
        ts = T0 + dt.timedelta(days=i)
        dim = spark.createDataFrame(scd.scd1_apply(dim, snap, KEY, ATTRS, ts).collect(), sch.DIM_TERMINALS)
        hist = spark.createDataFrame(scd.scd2_apply(hist, snap, KEY, ATTRS, ts).collect(), sch.HIST["terminals"])
        # SCD1: the dimension equals the snapshot on keys and attributes
        got = {r[KEY]: tuple(r[a] for a in ATTRS) for r in dim.collect()}
        assert got == snap_d
        rows = hist.collect()
        open_v = [r for r in rows if r.effective_to is None]
        # SCD2: one open version per key ever seen, carrying today's values
        assert len({r[KEY] for r in open_v}) == len(open_v)
        for r in open_v:
            if r[KEY] in snap_d:
                assert tuple(r[a] for a in ATTRS) == snap_d[r[KEY]]
        # keys gone from the snapshot are flagged in every version
        assert all(r.deleted for r in rows if r[KEY] not in snap_d)
        # a key's versions follow each other without overlap; only the last is open
        by_key = {}
        for r in rows:
            by_key.setdefault(r[KEY], []).append(r)
        for versions in by_key.values():
            versions.sort(key=lambda r: r.effective_from)
            for a, b in zip(versions, versions[1:]):
                assert a.effective_to is not None and a.effective_to <= b.effective_from
            assert all(r.effective_to is None or r.effective_from <= r.effective_to for r in versions)


events = st.lists(st.tuples(st.sampled_from(["hot", "a", "b", None]), st.one_of(st.integers(0, 60), st.none()),
                            st.integers(0, 9)),
                  min_size=1, max_size=60)


@settings(SETTINGS, max_examples=6)
@given(rows=events, n=st.integers(1, 3))
def test_ordered_lags_equal_plain_window(spark, many_ranges, rows, n):
    data = [(k, None if m is None else T0 + dt.timedelta(minutes=m), f"{i:03d}", v)
            for i, (k, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, id string, v int")
    with many_ranges():
        got = ordered_lags(df, ["k"], ["t", "id"], ["v"], n=n, rank_col="rk")
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
    cols = [lag_name(c, i) for c in ("t", "id", "v") for i in range(1, n + 1)]
    want = df.select("k", "id", F.row_number().over(w).alias("rk"),
                     *[F.lag(c, i).over(w).alias(lag_name(c, i)) for c in ("t", "id", "v") for i in range(1, n + 1)])
    key = ["k", "id", "rk", *cols]
    assert sorted(map(repr, got.select(*key).collect())) == sorted(map(repr, want.select(*key).collect()))


ENRICH_ROWS = st.lists(
    st.tuples(st.sampled_from(["K1", "K2", "K3", "K9"]),          # K9 has no card row
              st.one_of(st.integers(0, 240), st.none()),          # minutes after T0 (ties likely); None: unparsed
              st.sampled_from(["5.00", "10.00", "20.00", "30.00"]),
              st.sampled_from(["REJECT", "SUCCESS"]),
              st.sampled_from(["T1", "T2", "T3", "TX"])),         # TX unknown, T3 has no city
    min_size=1, max_size=40)


def _dims(spark):
    from decimal import Decimal  # noqa: F401
    cards = spark.createDataFrame([("K1", "A1", T0, None), ("K2", "A1", T0, None), ("K3", "A2", T0, None)],
                                  sch.DIM_CARDS)
    accounts = spark.createDataFrame([("A1", dt.date(2024, 1, 1), "C1", T0, None),
                                      ("A2", dt.date(2023, 1, 1), "C2", T0, None)], sch.DIM_ACCOUNTS)
    clients = spark.createDataFrame([
        ("C1", "L", "F", None, dt.date(1990, 1, 1), "P1", dt.date(2024, 1, 1), "+7", T0, None),
        ("C2", "M", "G", "H", dt.date(1990, 1, 1), "P2", dt.date(2030, 1, 1), None, T0, None)], sch.DIM_CLIENTS)
    terms = spark.createDataFrame([("T1", "ATM", "A", "x", T0, None), ("T2", "POS", "B", "y", T0, None),
                                   ("T3", "POS", None, "z", T0, None)], sch.DIM_TERMINALS)
    bl = spark.createDataFrame([("P2", T0)], sch.STG_BLACKLIST)
    return cards, terms, accounts, clients, bl


def _facts(spark, rows):
    from decimal import Decimal
    data = [(f"{i:03d}", None if m is None else T0 + dt.timedelta(minutes=m), card, "PAY", Decimal(a), res, term)
            for i, (card, m, a, res, term) in enumerate(rows)]
    return spark.createDataFrame(data, sch.FACT_TRANSACTIONS)


@settings(SETTINGS, max_examples=6)
@given(rows=ENRICH_ROWS, since_min=st.integers(0, 240))
def test_report_forms_agree(spark, many_ranges, rows, since_min):
    from nightledger.operators import rules
    from nightledger.operators.enrich import enrich
    cards, terms, accounts, clients, bl = _dims(spark)
    fact = _facts(spark, rows)
    e = enrich(fact, cards, terms, accounts, clients, blacklist=bl)
    with many_ranges():
        fused = sorted(map(repr, rules.fraud_report(e, "2024-02-01").collect()))
    assert fused == sorted(map(repr, rules.fraud_report_by_rule(e, "2024-02-01").collect()))
    since = T0 + dt.timedelta(minutes=since_min)
    full_after = [r for r in rules.fraud_report(e, "2024-02-01").collect()
                  if r.event_dt is not None and r.event_dt >= since]
    windowed = rules.fraud_report_since(fact, cards, terms, accounts, clients, bl, since, "2024-02-01")
    assert sorted(map(repr, windowed.collect())) == sorted(map(repr, full_after))
