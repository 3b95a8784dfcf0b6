"""Distributed prefix sums: rows are range-sorted, summed within each range, and every
range gets the sum of the ranges before it.  No task holds more than its range."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import written


def running(group: list, values: np.ndarray, carried: tuple[object, int]) -> tuple[np.ndarray, tuple[object, int]]:
    """The sum of the earlier values of its group for each row; rows of a group stand together.
    ``carried`` is the last group so far and its sum."""
    sums = np.cumsum(values)
    before = sums - values
    starts = [0, *(k for k in range(1, len(group)) if group[k] != group[k - 1])]
    base = np.repeat(before[starts], np.diff([*starts, len(group)]))
    out = before - base
    if group[0] == carried[0]:
        out[:starts[1] if len(starts) > 1 else len(group)] += carried[1]
    return out, (group[-1], int(out[-1] + values[-1]))


def prefix_sums(df: DataFrame, group: str, order: Sequence[str], value: str, name: str,
                per_group: DataFrame | None = None) -> DataFrame:
    """``df`` with ``before``, the sum of ``value`` (long, not null) over the earlier rows of the
    row's ``group`` (string, not null) by ``order``, and ``whole``, the group's sum.  The columns
    of ``per_group`` (one row per group) are added with them, so that the rows are joined once.

    The rows should come from a written table, and ``order`` should end with a column that tells
    them apart: then a hot group or a repeated row spreads over ranges, and a range that is
    worked out again holds the same rows.
    """
    kept = T.StructType([*df.schema, T.StructField("part", T.IntegerType()), T.StructField("run", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carried = TaskContext.get().partitionId(), (None, 0)
        for b in batches:
            if not b.num_rows:
                continue
            names = b.schema.names
            out, carried = running(b.column(names.index(group)).to_pylist(),
                                   b.column(names.index(value)).to_numpy(zero_copy_only=False), carried)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(out, pa.int64())], names=[*names, "part", "run"])

    by = [group, *order]
    ranged = written(df.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, kept), f"{name}-ranges")
    parts = ranged.groupBy(group, "part").agg(F.sum(value).alias("sum"))
    every = Window.partitionBy(group)
    earlier = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(group, "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"),
                           F.sum("sum").over(every).alias("whole"))
    if per_group is not None:
        offsets = offsets.join(per_group, group)
    # one row for each range and group in it: written, so that Spark knows its size before it plans the join
    offsets = written(offsets, f"{name}-offsets")
    return (ranged.join(offsets, [group, "part"])
            .withColumn("before", F.col("run") + F.col("offset")).drop("part", "run", "offset"))
