"""Client, account and card snapshots from the source system, and
S8-S9 staging (positional columns, explicit types)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as sch
from ..functions import strip_whitespace


def read_source_table(spark: SparkSession, table: str, *, fmt: str = "parquet",
                      path: str | None = None, jdbc_url: str | None = None,
                      partition_column: str | None = None, lower_bound=None,
                      upper_bound=None, num_partitions: int | None = None,
                      properties: dict[str, str] | None = None) -> DataFrame:
    """A full snapshot of a source table.

    ``fmt='jdbc'`` reads over JDBC; give ``partition_column`` (numeric, date
    or timestamp) with bounds and ``num_partitions`` so the read is split
    into parallel range queries instead of one connection pulling the whole
    table.  Connection details are caller-supplied; none are built in.
    Any other ``fmt`` loads ``path`` with that data source.
    """
    if fmt == "jdbc":
        r = spark.read.format("jdbc").option("url", jdbc_url).option("dbtable", table)
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        if partition_column:
            r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
        return r.load()
    return spark.read.format(fmt).load(path)


def _positional(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Take the first len(schema) columns by position, rename and cast; a
    value that does not convert becomes null (left to the quality checks)."""
    if len(df.columns) < len(schema.fields):
        raise ValueError(f"expected {len(schema.fields)} columns, got {df.columns}")
    d = df.select(*df.columns[:len(schema.fields)]).toDF(*schema.names)
    return d.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def stage_clients(src: DataFrame) -> DataFrame:
    return _positional(src, sch.STG_CLIENTS)


def stage_accounts(src: DataFrame) -> DataFrame:
    """valid_to is a timestamp at the source and a date in the warehouse;
    the time part is dropped here, once."""
    return _positional(src, sch.STG_ACCOUNTS)


def stage_cards(src: DataFrame) -> DataFrame:
    """Card numbers arrive padded with whitespace (spaces, tabs)."""
    d = _positional(src, sch.STG_CARDS)
    return d.withColumn("card_num", strip_whitespace("card_num"))


def stage_terminals(src: DataFrame) -> DataFrame:
    return _positional(src, sch.STG_TERMINALS)
