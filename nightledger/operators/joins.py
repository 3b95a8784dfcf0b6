"""Join helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anti_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` rows whose ``key`` is absent from ``right``.  Null keys never
    match, so those rows are kept without entering the shuffle, where they
    would all land in one partition."""
    k = F.col(key)
    return (left.where(k.isNotNull()).join(right.where(k.isNotNull()), key, "left_anti")
            .unionByName(left.where(k.isNull())))
