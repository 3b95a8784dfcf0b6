"""The maintained enriched table equals the whole join after every batch, and joins only what changed."""

import datetime as dt
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger import schemas as sch
from nightledger.operators import enriched_delta as delta

T0 = dt.datetime(2024, 1, 1)


def _facts(spark, lo, hi, extra=()):
    rows = [(f"{k:03d}", T0 + dt.timedelta(minutes=k), f"K{k % 6}", "PAY", Decimal("1.00"), "SUCCESS", f"T{k % 4}") for k in range(lo, hi)]
    return spark.createDataFrame([*rows, *extra], sch.FACT_TRANSACTIONS)


def _dims(spark, city="A", phone="+1", cards=range(6), terminals=range(4), listed=()):
    return {
        "cards": spark.createDataFrame([(f"K{k}", f"A{k // 2}", T0, None) for k in cards], sch.DIM_CARDS),
        "accounts": spark.createDataFrame([(f"A{k}", dt.date(2030, 1, 1), f"C{k}", T0, None) for k in range(3)], sch.DIM_ACCOUNTS),
        "clients": spark.createDataFrame([(f"C{k}", "L", "F", None, dt.date(1990, 1, 1), f"P{k}", dt.date(2030, 1, 1),
                                           phone if k == 1 else "+0", T0, None) for k in range(3)], sch.DIM_CLIENTS),
        "terminals": spark.createDataFrame([(f"T{k}", "ATM", city if k == 2 else "Z", "x", T0, None) for k in terminals], sch.DIM_TERMINALS),
        "blacklist": spark.createDataFrame([(p, T0) for p in listed], sch.FACT_BLACKLIST),
    }


def test_equals_the_whole_join_after_each_batch(spark):
    # an id that comes twice and one that is null are replaced together
    odd = [("500", T0, "K2", "PAY", Decimal("2.00"), "SUCCESS", "T0"), ("500", T0, "K0", "PAY", Decimal("3.00"), "SUCCESS", "T0"),
           (None, T0, "K3", "PAY", Decimal("4.00"), "SUCCESS", "T1"), (None, T0, "K1", "PAY", Decimal("5.00"), "SUCCESS", "T1")]
    batches = [_facts(spark, 0, 40, odd), _facts(spark, 40, 60), _facts(spark, 60, 61), _facts(spark, 61, 62)]
    states = [_dims(spark, cards=range(5)), _dims(spark, phone="+9"), _dims(spark, phone="+9", city="B", listed=["P0"]),
              _dims(spark, phone="+9", city="B", listed=["P0"], terminals=range(1, 4))]
    union = lambda dfs: reduce(DataFrame.unionByName, dfs)
    parts, ids, rows = [], [spark.createDataFrame([], "trans_id string, v int")], []
    replaced = []
    for k, dims in enumerate(states):
        parts.append(delta.part(batches[k], dims))
        if k:
            i, r = delta.patch(union(batches[:k]), states[k - 1], dims)
            replaced.append(sorted(x["trans_id"] or "" for x in i.collect()))
            ids.append(i.withColumn("v", F.lit(k)))
            rows.append(r.withColumn("v", F.lit(k)))
        none = parts[0].limit(0).withColumn("v", F.lit(0))
        got = delta.current(union(parts), union(ids), union([none, *rows]))
        want = delta._enrich(union(batches[:k + 1]), dims)
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect())), k
    # the second batch: client C1 (cards K2, K3) has a new phone, card K5 is new
    assert replaced[0] == sorted(["", "500", *[f"{k:03d}" for k in range(40) if k % 6 in (2, 3, 5)]])
    # nothing but the facts of changed cards and terminals
    assert replaced[2] == sorted(["500", *[f"{k:03d}" for k in range(61) if k % 4 == 0]])


def test_no_change_replaces_nothing(spark):
    dims = _dims(spark)
    ids, rows = delta.patch(_facts(spark, 0, 30), dims, _dims(spark))
    assert ids.count() == 0 and rows.count() == 0
