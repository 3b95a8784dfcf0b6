"""A third of all transactions on one card: the enrichment join must be
split by AQE instead of landing in one task (thresholds scaled down to the
test data)."""

from pyspark.sql import functions as F

from nightledger import fixtures as fx
from nightledger.operators.enrich import enrich
from nightledger.plans.explain import plan_text

SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB"}


def test_hot_card_is_split(spark, sf_small):
    old = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    try:
        tx = fx.transactions(spark, sf_small)
        # AQE splits a skewed partition by ranges of map outputs; the test
        # table is one file, so spread it over several tasks as a real fact
        # table (many files) would be.
        hot = tx.withColumn("card_num", F.when(F.col("trans_id").cast("long") % 3 == 0, F.lit("K1-0"))
                            .otherwise(F.col("card_num"))).repartition(8)
        e = enrich(hot, fx.cards(spark, sf_small), fx.terminals(spark, sf_small),
                   fx.accounts(spark, sf_small), fx.clients(spark, sf_small))
        rows = e.collect()
        p = plan_text(e)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == tx.count()
    assert "isFinalPlan=true" in p
    split = [b for b in p.split("\n\n") if b.lstrip().startswith("(") and "SortMergeJoin(skew=true)" in b]
    assert any("keys [1]: [card_num" in b for b in split), split
