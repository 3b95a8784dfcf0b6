"""The enriched table as a maintained view.

A batch adds a part, the enriched rows of its own new facts, and a patch: the
older facts whose card or terminal shows other attributes today than when they
were last joined.  A patch names the facts it replaces by id, with the rows
they have now (none for a fact whose card, account, client or terminal is
gone).  The current table is the parts without the ids that a patch names,
and of those the rows of the newest patch.  Unchanged facts are not joined
again; finding the changed ones reads two columns of the history and joins
them with the changed keys, which Spark broadcasts when they are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .enrich import card_profile, enrich

Dims = dict[str, DataFrame]  # cards, terminals, accounts, clients, and blacklist if the flag is kept
PROFILE = "card_profile"  # of ``profiled`` dimensions


def _enrich(facts: DataFrame, dims: Dims) -> DataFrame:
    return enrich(facts, dims["cards"], dims["terminals"], dims["accounts"], dims["clients"], blacklist=dims.get("blacklist"),
                  profile=dims.get(PROFILE))


def _card_profile(dims: Dims) -> DataFrame:
    return dims[PROFILE] if PROFILE in dims else card_profile(dims["cards"], dims["accounts"], dims["clients"], dims.get("blacklist"))


def profiled(dims: Dims) -> Dims:
    """The dimensions with the card profile joined once, for a part and a patch of the same state."""
    return {**dims, PROFILE: written(_card_profile(dims), "card-profile")}


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """The keys that are new, gone or show other values."""
    cols = sorted(set(before.columns) - {key})
    old = before.where(F.col(key).isNotNull()).select(key, F.struct(*cols).alias("_old"))
    new = after.where(F.col(key).isNotNull()).select(key, F.struct(*cols).alias("_new"))
    return old.join(new, key, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new"))).select(key).distinct()


def _profiles(dims: Dims) -> tuple[DataFrame, DataFrame]:
    return (_card_profile(dims),
            dims["terminals"].select(F.col("terminal_id").alias("terminal"), "terminal_city"))


def affected(facts: DataFrame, before: Dims, after: Dims) -> DataFrame:
    """The facts whose enriched row may differ between two states of the dimensions."""
    (cards, terminals), (cards_now, terminals_now) = _profiles(before), _profiles(after)
    card = written(changed_keys(cards, cards_now, "card_num"), "changed-cards").withColumn("_card", F.lit(True))
    terminal = written(changed_keys(terminals, terminals_now, "terminal"), "changed-terminals").withColumn("_terminal", F.lit(True))
    return (facts.join(card, "card_num", "left").join(terminal, "terminal", "left")
            .where(F.col("_card") | F.col("_terminal")).select(*facts.columns))


def part(new_facts: DataFrame, dims: Dims) -> DataFrame:
    """The rows that a batch's own facts add."""
    return _enrich(new_facts, dims)


def patch(old_facts: DataFrame, before: Dims, after: Dims) -> tuple[DataFrame, DataFrame]:
    """(ids of the facts that a batch replaces, their rows now).  Where an id is repeated, or null, all its
    facts are replaced together."""
    ids = written(affected(old_facts, before, after).select(F.col("trans_id").alias("_id")).distinct(), "affected-ids")
    again = old_facts.join(ids, F.col("trans_id").eqNullSafe(F.col("_id")), "left_semi")
    return ids.select(F.col("_id").alias("trans_id")), _enrich(again, after)


def current(parts: DataFrame, patched_ids: DataFrame, patched_rows: DataFrame, version: str = "v") -> DataFrame:
    """The enriched table now.  The patches carry the batch in ``version``; a patch is newer than every part
    that has one of its ids.  No id of the newest patch is in a newer one, so its rows count as they are;
    only the rows of older patches are looked up."""
    newest = patched_ids.agg(F.max(version)).first()[0]
    if newest is None:
        return parts
    same = F.col("trans_id").eqNullSafe(F.col("_id"))
    kept = parts.join(patched_ids.select(F.col("trans_id").alias("_id")), same, "left_anti")
    last = patched_ids.groupBy(F.col("trans_id").alias("_id")).agg(F.max(version).alias("_v"))
    older = patched_rows.where(F.col(version) < F.lit(newest)).join(last, same & (F.col(version) == F.col("_v")), "left_semi")
    again = patched_rows.where(F.col(version) == F.lit(newest)).unionByName(older)
    return kept.unionByName(again.drop(version))
