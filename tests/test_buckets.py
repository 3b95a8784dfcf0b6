"""Copy-on-write versions: equal to the whole step, and only changed buckets are written."""

import datetime as dt

from pyspark.sql import functions as F

from nightledger import schemas as sch
from nightledger.operators import scd
from nightledger.plans.buckets import NULL_BUCKET, read_manifest, write_version
from nightledger.plans.store import Store

KEY, ATTRS = sch.dim_key("terminals"), sch.dim_attrs("terminals")
DIM, HIST = sch.DIM_TABLES["terminals"], sch.HIST_TABLES["terminals"]
LIVE = "effective_to is null and not deleted"
D = [dt.date(2024, 2, d) for d in range(1, 6)]


def _snap(spark, n, change=(), gone=(), extra=()):
    rows = [(f"T{k}", "ATM", "X" if k in change else None if k % 7 == 0 else f"c{k % 5}", f"a{k}") for k in range(n) if k not in gone]
    return spark.createDataFrame([*rows, *extra], sch.STG_TERMINALS).select(KEY, *ATTRS)


def _run(store, snaps, bucket_rows=20):
    """Each snapshot as one day's version, beside the whole step; returns the manifests."""
    dim, hist = store.spark.createDataFrame([], sch.DIM["terminals"]), store.spark.createDataFrame([], sch.HIST["terminals"])
    previous, manifests = None, []
    for day, snap in zip(D, snaps):
        ts, attempt = f"{day} 09:00:00", store.new_attempt()
        m1 = write_version(store, DIM, sch.DIM["terminals"], day, attempt, previous, snap, KEY, ATTRS,
                           lambda o, n, ts=ts: scd.scd1_apply(o, n, KEY, ATTRS, ts), bucket_rows=bucket_rows)
        m2 = write_version(store, HIST, sch.HIST["terminals"], day, attempt, previous, snap, KEY, ATTRS,
                           lambda o, n, ts=ts: scd.scd2_apply(o, n, KEY, ATTRS, ts), F.expr(LIVE), bucket_rows)
        dim = store.spark.createDataFrame(scd.scd1_apply(dim, snap, KEY, ATTRS, ts).collect(), sch.DIM["terminals"])
        hist = store.spark.createDataFrame(scd.scd2_apply(hist, snap, KEY, ATTRS, ts).collect(), sch.HIST["terminals"])
        for table, schema, want in ((DIM, sch.DIM["terminals"], dim), (HIST, sch.HIST["terminals"], hist)):
            got = store.read(table, schema, day, attempt)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), (day, table)
        assert read_manifest(store, DIM, day, attempt) == m1
        manifests.append((m1, m2))
        previous = (day, attempt)
    return manifests


def test_versions_equal_the_whole_step(spark, tmp_path):
    snaps = [_snap(spark, 200), _snap(spark, 203, change={5}, gone={17}), _snap(spark, 203, change={5}, gone={17}),
             _snap(spark, 203, gone={100}, extra=[(None, "POS", "x", "y")]), _snap(spark, 0)]
    ms = _run(Store(spark, str(tmp_path / "wh")), snaps)
    assert ms[0][0].buckets == 16
    for table in (0, 1):
        first, second, same, null = (m[table] for m in ms[:4])
        # at most one bucket for each changed, gone or new key is written; the others are named again
        moved = {b for b, e in second.entries.items() if e[0] == D[1]}
        assert 0 < len(moved) <= 5 and len(first.entries) == 16
        assert all(second.entries[b] == first.entries[b] for b in second.entries if b not in moved)
        # an unchanged day writes nothing
        assert same.entries == second.entries
        assert NULL_BUCKET in null.entries
    assert ms[4][0].entries == {}
    # nothing is deleted from a history
    assert sum(e[2] for e in ms[4][1].entries.values()) >= 203


def test_bytes_written_follow_the_change(spark, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    _run(store, [_snap(spark, 2000), _snap(spark, 2000, change={3, 900})], bucket_rows=40)
    size = [sum(p.stat().st_size for p in (tmp_path / "wh" / DIM / f"v={d}").rglob("*.parquet")) for d in D[:2]]
    assert 0 < size[1] * 10 < size[0]


def test_an_outgrown_table_gets_more_buckets(spark, tmp_path):
    ms = _run(Store(spark, str(tmp_path / "wh")), [_snap(spark, 30), _snap(spark, 300), _snap(spark, 300, change={1})])
    assert [m[0].buckets for m in ms] == [2, 16, 16]
    assert sum(e[0] == D[2] for e in ms[2][0].entries.values()) == 1
