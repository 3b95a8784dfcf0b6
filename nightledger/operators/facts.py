"""Append-only fact tables, deduplicated against what is stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import membership
from .joins import anti_join


def new_transactions(staged: DataFrame, fact: DataFrame, range_prefilter: bool = True) -> DataFrame:
    """Staged transactions whose ``trans_id`` is not yet in the fact
    table.  Only the key column of the fact table is read.

    Two steps, same result as one anti-join: first the stored ids that
    arrive again today (a semi-join whose small side is today's ids, so
    Spark broadcasts it when it fits and the history is only scanned, not
    shuffled), then today's rows minus that small set.

    With ``range_prefilter`` the stored ids are also limited to the
    [min, max] of today's ids (two scalars from the batch).  The range is
    pushed into the Parquet scan, where row groups outside it are skipped;
    with ids that grow over time the history is hardly read at all.
    """
    stored = fact.select("trans_id")
    if range_prefilter:
        b = staged.agg(F.min("trans_id").alias("lo"), F.max("trans_id").alias("hi")).first()
        if b is None or b["lo"] is None:
            return staged
        stored = stored.where(F.col("trans_id").between(F.lit(b["lo"]), F.lit(b["hi"])))
    seen_again = stored.join(staged.select("trans_id"), "trans_id", "left_semi")
    return anti_join(staged, seen_again, "trans_id")


def new_transactions_by_filter(staged: DataFrame, filters: DataFrame, batch: str,
                               read: Callable[[list], DataFrame]) -> DataFrame:
    """D8 from the membership filters of the committed batches (see ``membership``), which carry the
    batch in a column: only the batches that may hold one of today's ids are read (``read`` gives their
    facts), and of them the ids in question, which are then checked exactly."""
    may = written(membership.may_hold(staged, "trans_id", filters), "ids-in-question")
    asked = sorted(r[batch] for r in may.select(batch).distinct().collect())
    if not asked:
        return staged
    stored = read(asked).select("trans_id").join(may.select("trans_id"), "trans_id", "left_semi")
    return anti_join(staged, stored, "trans_id")


def new_blacklist_entries(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Staged blacklist rows whose passport is not yet stored.

    The first-seen entry of a passport is kept across days; several rows
    for one passport within the same batch all enter; a row with a null
    passport matches nothing and enters every time.
    """
    return anti_join(staged, fact.select("passport_num"), "passport_num")
