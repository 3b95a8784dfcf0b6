"""Ordered look-back (``lag``/``row_number`` per key) by ranges with boundary carry.

A plain ``Window.partitionBy(key).orderBy(t)`` sorts every row of a key in a
single task; one client holding a large share of all transactions would then
hold up the job.  Here the rows are range-sorted by (key, order) and written,
each with the number of its range, so a hot key, a hot hour of it, or even a
hot instant spreads over as many ranges as its rows fill.  The windows run
within (range, key).  What a range needs from before it, the last ``n`` rows
of its first key, comes from the last ``n`` rows of the earlier ranges: a
table of a few rows for each range.  The result is exactly the plain window's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

PART = "_part"
POS = "_pos"
_ROW_BITS = (1 << 33) - 1
_CARRY = "_carry"


def lag_name(col: str, i: int) -> str:
    return f"{col}_lag{i}"


def _sorted(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def ordered_ranges(df: DataFrame, key: Sequence[str], order: Sequence[str], stored: bool = False) -> DataFrame:
    """``df`` range-sorted by key and order, with the number of each row's range in ``_part`` and its place there in ``_pos``.

    The range sort looks at its input twice (once for the bounds), so the
    input is written first; say ``stored`` if it is a plain scan already.
    The ranges are written too: every later step sees the same ones.
    """
    rows = df if stored else written(df, "ordered-rows")
    by = _sorted([*key, *order])
    # an id that grows row by row carries the row's place in its lower 33 bits
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    return written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(PART, F.spark_partition_id())
                   .withColumn(POS, place), "ordered-ranges")


def edge_rows(ranged: DataFrame, n: int, newest: bool) -> DataFrame:
    """The last (or first) ``n`` rows of every range, with their place ``_rn`` from that end.  The rows' places are
    stored: nothing is sorted or shuffled but one row for each range, its last place, which is broadcast."""
    if not newest:
        return ranged.where(F.col(POS) < n).withColumn("_rn", (F.col(POS) + 1).cast("int"))
    top = ranged.groupBy(F.col(PART).alias("_p")).agg(F.max(POS).alias("_top"))
    from_end = F.col("_top") - F.col(POS) + 1
    return (ranged.join(F.broadcast(top), F.col(PART) == F.col("_p")).where(from_end <= n)
            .withColumn("_rn", from_end.cast("int")).drop("_p", "_top"))


def same_key(a: Sequence[Column], b: Sequence[Column]) -> Column:
    on = F.lit(True)
    for x, y in zip(a, b):
        on = on & x.eqNullSafe(y)
    return on


def carried(ranged: DataFrame, key: Sequence[str], order: Sequence[str], cols: Sequence[str], n: int,
            offsets: bool = True) -> DataFrame:
    """For every range whose first key began in an earlier range: ``_part``, the key, ``_prev`` (the ``n``
    rows of the key before the range, newest first, null where there are fewer) and ``_offset`` (the number of
    all its rows before the range; null if ``offsets`` are not asked for)."""
    tails = edge_rows(ranged, n, newest=True).select(PART, *key, *order, "_rn", F.struct(*cols).alias("_rec"))
    heads = edge_rows(ranged, 1, newest=False).select(PART, *key)
    if offsets:
        # rows of each range's last key: only that key can go on in the next range
        last = tails.where("_rn = 1").select(F.col(PART).alias("_p"), *[F.col(k).alias(f"_k_{k}") for k in key])
        of_last = (ranged.join(F.broadcast(last), (F.col(PART) == F.col("_p")) & same_key([F.col(k) for k in key], [F.col(f"_k_{k}") for k in key]))
                   .groupBy(F.col("_p")).agg(F.count(F.lit(1)).alias("_n")))
        tails = tails.join(of_last, F.col(PART) == F.col("_p"), "left").drop("_p")
    else:
        tails = tails.withColumn("_n", F.lit(None).cast("long"))
    by_key = Window.partitionBy(*key).orderBy(PART, *_sorted(order))
    tails = tails.withColumn("_last", F.array(F.col("_rec"), *[F.lag("_rec", i).over(by_key) for i in range(1, n)]))
    marks = (tails.select(PART, *key, *order, "_last", F.lit(1).alias("_own"), F.when(F.col("_rn") == 1, F.col("_n")).otherwise(0).alias("_n"))
             .unionByName(heads.withColumn("_own", F.lit(0)), allowMissingColumns=True))
    earlier = Window.partitionBy(*key).orderBy(PART, "_own", *_sorted(order)).rowsBetween(Window.unboundedPreceding, -1)
    found = (marks.withColumn("_prev", F.last("_last", ignorenulls=True).over(earlier))
             .withColumn("_offset", F.sum("_n").over(earlier))
             .where((F.col("_own") == 0) & F.col("_prev").isNotNull()))
    # written: Spark knows how small it is before it plans the joins with the rows
    return written(found.select(PART, *key, "_prev", "_offset"), "ordered-carry")


def spanning(ranged: DataFrame, group: dict[str, Column]) -> DataFrame:
    """The groups (runs of rows that stand together in the order) that lie in more than one range: at most one for each range."""
    edges = (edge_rows(ranged, 1, newest=True).unionByName(edge_rows(ranged, 1, newest=False))
             .select(PART, *[c.alias(name) for name, c in group.items()]))
    return edges.groupBy(*group).agg(F.min(PART).alias("_lo"), F.max(PART).alias("_hi")).where("_lo < _hi").select(*group)


def range_lags(ranged: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str],
               n: int = 2, rank_col: str | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """``ordered_lags`` over rows from ``ordered_ranges``; ``_part`` and ``_pos`` stay in the output, and the rows
    are partitioned by (key, ``_part``).  ``groups``: columns without nulls that never fall in the order; the rows are
    sorted by them first, so that a window over (key, ``_part``, groups) does not sort them again."""
    key, order, groups = list(key), list(order), list(groups)
    cols = list(dict.fromkeys([*order, *values]))
    prev = carried(ranged, key, order, list(dict.fromkeys([*cols, *groups])), n, offsets=rank_col is not None)
    carry = (prev.select(PART, *key, F.explode(F.filter("_prev", lambda r: r.isNotNull())).alias("_r"))
             .select(PART, *key, *[F.col(f"_r.{c}").alias(c) for c in dict.fromkeys([*cols, *groups])], F.lit(True).alias(_CARRY)))
    rows = ranged.withColumn(_CARRY, F.lit(False)).unionByName(carry, allowMissingColumns=True)
    if rank_col:
        before = prev.select(F.col(PART).alias("_p"), *[F.col(k).alias(f"_k_{k}") for k in key], "_offset")
        rows = rows.join(before, (F.col(PART) == F.col("_p")) & same_key([F.col(k) for k in key], [F.col(f"_k_{k}") for k in key]), "left")
    w = Window.partitionBy(*key, PART).orderBy(*groups, *_sorted(order))
    lags = [F.lag(c, i).over(w).alias(lag_name(c, i)) for c in cols for i in range(1, n + 1)]
    if rank_col:
        running = F.sum(F.when(F.col(_CARRY), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
        lags.append((F.coalesce("_offset", F.lit(0)) + running).cast("int").alias(rank_col))
    out = rows.select(*ranged.columns, _CARRY, *lags)
    return out.where(~F.col(_CARRY)).drop(_CARRY)


def ordered_lags(df: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str],
                 n: int = 2, rank_col: str | None = None, stored: bool = False) -> DataFrame:
    """Add ``<c>_lag<i>`` for each column c of ``order + values`` and i in
    1..n, equal to ``lag(c, i) over (partition by key order by order)``.

    ``order`` must be a total order within a key (end it with a unique id);
    nulls sort last, as in SQL's default ascending order.  With ``rank_col``
    the row's 1-based position within its key is added too.
    """
    return range_lags(ordered_ranges(df, key, order, stored), key, order, values, n, rank_col).drop(PART, POS)
