"""Compaction, expiry and zone maps of the versioned store; scratch folders end with a run."""

import datetime as dt
import os

from pyspark.sql import functions as F

from nightledger.plans.store import Store
from nightledger.session import scratch_path, scratch_scope

SCHEMA = "k int, t timestamp_ntz"
DAY0 = dt.date(2024, 1, 1)


def _days(store, n, table="facts"):
    """Commit n days of two rows each."""
    out = []
    for k in range(n):
        day, attempt = DAY0 + dt.timedelta(days=k), store.new_attempt()
        t = dt.datetime(2024, 1, 1) + dt.timedelta(days=k)
        store.write(table, day, attempt, store.spark.createDataFrame([(2 * k, t), (2 * k + 1, t + dt.timedelta(hours=5))], SCHEMA).coalesce(1))
        store.commit(day, attempt, "x")
        out.append((day, attempt))
    return out


def test_many_days_are_read_from_few_folders(spark, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    made = _days(store, 11)
    attempts = dict(made)
    read = lambda days: sorted(r["k"] for r in store.read_days("facts", SCHEMA, days).collect())
    before = read(list(attempts))
    assert store.compact("facts", SCHEMA, fan=3) == 4  # three of three days, and one of these three
    units = store._units("facts", list(attempts), attempts)
    assert [len(u.members) for u in units] == [9, 1, 1]
    assert read(list(attempts)) == before == list(range(22))
    assert store.compact("facts", SCHEMA, fan=3) == 0
    # other sets of days: merged folders only where all their days are asked for
    assert read([d for d, _ in made[1:10]]) == list(range(2, 20))
    assert [len(u.members) for u in store._units("facts", [d for d, _ in made[:7]], attempts)] == [3, 3, 1]
    # a day that is run again no longer counts in a folder that was merged before
    store.write("facts", made[-1][0], again := store.new_attempt(), spark.createDataFrame([(99, None)], SCHEMA))
    store.commit(made[-1][0], again, "x")
    assert read(list(attempts)) == [*range(20), 99]


def test_attempts_that_do_not_count_are_deleted(spark, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    _days(store, 2)
    day = DAY0 + dt.timedelta(days=1)
    store.write("facts", day, "died", spark.createDataFrame([(7, None)], SCHEMA))
    store.write("_zones/facts", day, "died", spark.createDataFrame([(7, None)], SCHEMA))
    before = store.read_days("facts", SCHEMA, store.committed_days()).count()
    gone = store.expire_attempts()
    assert sorted(os.path.basename(g) for g in gone) == ["attempt=died", "attempt=died"]
    assert store.read_days("facts", SCHEMA, store.committed_days()).count() == before
    assert store.expire_attempts() == []


def test_zone_maps_choose_the_files(spark, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    made = _days(store, 5)
    for day, attempt in made:
        store.write_zones("facts", day, attempt, "t")
    zones = store.zones("facts", [d for d, _ in made], attempts=dict(made))
    start = F.lit("2024-01-03 03:00:00").cast("timestamp_ntz")
    late, early = store.files_between(zones, "facts", lo=start), store.files_between(zones, "facts", hi=start)
    assert len(late) == 3 and len(early) == 3  # the third day's file lies on both sides
    rows = store.read_files(late, SCHEMA).where(F.col("t") >= start)
    assert sorted(r["k"] for r in rows.collect()) == [5, 6, 7, 8, 9]
    assert set(rows.inputFiles()) == {f if "://" in f else f"file://{f}" for f in late}
    assert store.read_files([], SCHEMA).count() == 0


def test_scratch_folders_end_with_their_scope(spark):
    outside = scratch_path(spark, "kept")
    spark.range(3).write.parquet(outside)
    with scratch_scope(spark):
        inside = scratch_path(spark, "gone")
        spark.range(3).write.parquet(inside)
        assert spark.read.parquet(inside).count() == 3
    local = lambda p: p.removeprefix("file://").removeprefix("file:")
    assert os.path.exists(local(outside)) and not os.path.exists(local(inside))
