"""Membership filters: nothing is lost, little passes, batches without today's ids stay closed."""

from decimal import Decimal

from pyspark.sql import functions as F

from nightledger import schemas as sch
from nightledger.operators import facts, membership


def _ids(spark, lo, hi, batch=0):
    return spark.range(lo, hi).select(F.concat(F.lit("t"), F.md5(F.col("id").cast("string"))).alias("trans_id"))


def test_no_id_is_lost_and_few_foreign_ones_pass(spark):
    held = membership.build(_ids(spark, 0, 20_000), "trans_id").withColumn("batch", F.lit(1))
    small = membership.build(_ids(spark, 50_000, 50_010), "trans_id").withColumn("batch", F.lit(2))
    filters = held.unionByName(small)
    assert held.count() <= membership.blocks_for(20_000)
    mine = membership.may_hold(_ids(spark, 0, 20_000), "trans_id", filters)
    assert mine.where("batch = 1").count() == 20_000
    assert membership.may_hold(_ids(spark, 50_000, 50_010), "trans_id", filters).where("batch = 2").count() == 10
    assert membership.may_hold(_ids(spark, 100_000, 200_000), "trans_id", filters).count() <= 3


def _facts(spark, ids):
    return ids.select("trans_id", F.lit(None).cast("timestamp_ntz").alias("trans_date"), F.lit("K").alias("card_num"), F.lit("PAY").alias("oper_type"),
                      F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("amt"), F.lit("SUCCESS").alias("oper_result"), F.lit("T").alias("terminal"))


def test_only_batches_in_question_are_read(spark):
    batches = {b: _facts(spark, _ids(spark, 1000 * b, 1000 * b + 1000)) for b in range(6)}
    filters = None
    for b, f in batches.items():
        one = membership.build(f, "trans_id").withColumn("batch", F.lit(b))
        filters = one if filters is None else filters.unionByName(one)
    asked = []

    def read(which):
        asked.extend(which)
        return spark.createDataFrame([], sch.FACT_TRANSACTIONS).unionByName(batches[which[0]]) if len(which) == 1 else (
            batches[which[0]].unionByName(batches[which[1]]))

    today = _facts(spark, _ids(spark, 2990, 3010).unionByName(_ids(spark, 9000, 9100)).unionByName(
        spark.createDataFrame([(None,), (None,)], "trans_id string")))
    new = facts.new_transactions_by_filter(today, filters, "batch", read)
    assert asked == [2, 3]
    # ids of the first kind are stored; null ids match nothing and enter
    assert new.count() == 102 and new.where("trans_id is null").count() == 2
    nothing = facts.new_transactions_by_filter(today, filters.limit(0), "batch", read)
    assert nothing.count() == today.count()
