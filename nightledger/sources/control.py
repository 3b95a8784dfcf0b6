"""The batch date kept in the control table (``ddMMyyyy``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as sch
from ..functions import next_label


def control_table(spark: SparkSession, label: str = sch.BATCH_LABEL_SEED) -> DataFrame:
    return spark.createDataFrame([(label,)], sch.CONTROL)


def read_batch_label(control: DataFrame) -> str:
    """The label of the next batch to load (first row)."""
    row = control.select("dt").limit(1).first()
    if row is None:
        raise ValueError("control table is empty")
    return row["dt"]


def advance(control: DataFrame) -> DataFrame:
    """Every label moved to the following day."""
    return control.select(next_label("dt").alias("dt"))


def batch_days(transactions: DataFrame) -> DataFrame:
    """The batch labels of the days present in ``transactions`` with the
    label of the following batch: (dt, next_dt)."""
    d = transactions.select(F.to_date("trans_date").alias("_d")).distinct()
    return d.select(F.date_format("_d", sch.BATCH_LABEL_FORMAT).alias("dt"),
                    next_label(F.date_format("_d", sch.BATCH_LABEL_FORMAT)).alias("next_dt"))
