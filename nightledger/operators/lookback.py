"""The look-back state of the fraud report (F4, F5): what of the history the
next reports still need.

F4 looks at each client's two operations before an operation.  The last two
operations of a client are among the last two of each of its cards, and
whether an operation counts depends on its terminal being known on the day
of the report.  So the last two operations of every (card, terminal) are
enough, whatever dimensions a later report has.  The state is merged batch by
batch, late rows included, and never looks at the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["card_num", "terminal"]


def newest_two(rows: DataFrame, key: list[str]) -> DataFrame:
    """The last two rows of each key by (trans_date, trans_id); rows without a time are never before
    another one.  Limited in each task before the shuffle, so a hot key is a few rows of each task."""
    newest = Window.partitionBy(*key).orderBy(F.col("trans_date").desc(), F.col("trans_id").desc())
    return (rows.where(F.col("trans_date").isNotNull()).withColumn("_rn", F.row_number().over(newest))
            .where("_rn <= 2").drop("_rn"))


def merge_state(state: DataFrame, new: DataFrame) -> DataFrame:
    """The state after a batch: same columns as the facts."""
    return newest_two(state.unionByName(new.select(*state.columns)), KEY)
