"""The load metadata table (one row per warehouse table)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as sch


def _ts(v):
    return F.lit(str(v)).cast("timestamp_ntz")


def seed(spark: SparkSession) -> DataFrame:
    """The initial metadata: every table at the seed time.  A handful of
    rows, fixed in number (one per warehouse table)."""
    rows = [(sch.META_SCHEMA_NAME, t) for t in sch.META_TABLES]
    return (spark.createDataFrame(rows, "schema_name string, table_name string")
            .withColumn("max_update_dt", F.to_timestamp_ntz(F.lit(sch.META_SEED_TS))))


def stamp_load_time(meta: DataFrame, tables: list[str], batch_ts) -> DataFrame:
    """Set ``max_update_dt`` of the given tables to the batch time."""
    hit = (F.col("schema_name") == sch.META_SCHEMA_NAME) & F.col("table_name").isin(*tables)
    return meta.withColumn("max_update_dt",
                           F.when(hit, _ts(batch_ts)).otherwise(F.col("max_update_dt")))


def high_water_marks(meta: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """For each dimension table, ``coalesce(max(update_dt), previous)``.

    Inserted rows have a null update_dt, so inserts alone do not move the
    mark.  Each maximum is a global aggregate (partial per task, one row
    after the shuffle); the four results are joined to the metadata rows.
    """
    marks = reduce(DataFrame.unionByName, [
        df.agg(F.max("update_dt").alias("_mark")).withColumn("table_name", F.lit(name))
        for name, df in dims.items()])
    marks = marks.withColumn("schema_name", F.lit(sch.META_SCHEMA_NAME))
    out = meta.join(marks, ["schema_name", "table_name"], "left")
    return out.select("schema_name", "table_name",
                      F.coalesce("_mark", "max_update_dt").alias("max_update_dt"))
