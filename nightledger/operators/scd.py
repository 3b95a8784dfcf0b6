"""Change capture by snapshot comparison: SCD1 dimensions and SCD2 history.

Parquet tables cannot be updated in place, so every operator is a function
from (stored table, today's snapshot) to rows; ``scd1_apply`` and
``scd2_apply`` return the whole new table, to be written as a new version.

``*_apply`` compare each dimension in one pass: a full outer join of the
stored rows with the snapshot on the key (one shuffle of each side), followed
by a null-safe comparison of the tracked attributes.  Presence of a side is
taken from a marker column, never from attribute nulls.  The single steps use
the join that they need: anti joins for new and gone keys, an inner join
for changed ones, which Spark can broadcast or split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import anti_join

INSERT, UPDATE, SAME, DELETE = "insert", "update", "same", "delete"
CLOSE, OPEN = "close", "open"
ACTION = "_action"


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("timestamp_ntz")


def _change_test(attrs: list[str], change: str) -> Column:
    """``any``: some attribute differs; ``all``: every attribute differs (the
    accounts test as the original writes it)."""
    diffs = [~F.col(f"_old.{a}").eqNullSafe(F.col(f"_new.{a}")) for a in attrs]
    op = (lambda x, y: x | y) if change == "any" else (lambda x, y: x & y)
    if change not in ("any", "all"):
        raise ValueError("change must be 'any' or 'all'")
    return reduce(op, diffs)


def _pair(stored: DataFrame, snapshot: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Full outer join on ``key``: columns ``_key``, ``_old`` (stored row
    struct or null) and ``_new`` (snapshot row struct or null).

    Rows with a null key never match; they bypass the join (otherwise they
    would all hash into one shuffle partition) and come back unpaired.
    """
    old = stored.select(F.col(key).alias("_key"), F.struct(*stored.columns).alias("_old"))
    new = snapshot.select(F.col(key).alias("_key"), F.struct(key, *attrs).alias("_new"))
    k = F.col("_key")
    paired = old.where(k.isNotNull()).join(new.where(k.isNotNull()), "_key", "full_outer")
    return (paired
            .unionByName(old.where(k.isNull()).withColumn("_new", F.lit(None).cast(new.schema["_new"].dataType)))
            .unionByName(new.where(k.isNull()).withColumn("_old", F.lit(None).cast(old.schema["_old"].dataType))))


def classify(stored: DataFrame, snapshot: DataFrame, key: str, attrs: list[str],
             change: str = "any") -> DataFrame:
    """One row per key of either side with ``_op`` in insert / update /
    same / delete, the stored row ``_old`` and the snapshot row ``_new``."""
    p = _pair(stored, snapshot, key, attrs)
    op = (F.when(F.col("_old").isNull(), F.lit(INSERT))
           .when(F.col("_new").isNull(), F.lit(DELETE))
           .when(_change_test(attrs, change), F.lit(UPDATE))
           .otherwise(F.lit(SAME)))
    return p.withColumn("_op", op)


# SCD1 -------------------------------------------------------------------------------

def scd1_changes(dim: DataFrame, snapshot: DataFrame, key: str, attrs: list[str],
                 batch_ts, change: str = "any") -> DataFrame:
    """New dimension rows with ``_action`` in insert / update / same /
    delete.  Delete rows carry the stored values (they leave the table)."""
    c = classify(dim, snapshot, key, attrs, change)
    op = F.col("_op")
    take_new = op.isin(INSERT, UPDATE)
    cols = [F.col("_key").alias(key)]
    cols += [F.when(take_new, F.col(f"_new.{a}")).otherwise(F.col(f"_old.{a}")).alias(a) for a in attrs]
    cols += [
        F.when(op == INSERT, _ts(batch_ts)).otherwise(F.col("_old.create_dt")).alias("create_dt"),
        F.when(op == INSERT, F.lit(None).cast("timestamp_ntz"))
         .when(op == UPDATE, _ts(batch_ts)).otherwise(F.col("_old.update_dt")).alias("update_dt"),
        op.alias(ACTION),
    ]
    return c.select(*cols)


def _matched(stored: DataFrame, snapshot: DataFrame, key: str, attrs: list[str], change: str) -> DataFrame:
    """Changed keys: columns ``_old`` and ``_new`` (inner join)."""
    old = stored.select(F.col(key).alias("_key"), F.struct(*stored.columns).alias("_old"))
    new = snapshot.select(F.col(key).alias("_key"), F.struct(key, *attrs).alias("_new"))
    return old.join(new, "_key").where(_change_test(attrs, change))


def scd1_insert(dim, snapshot, key, attrs, batch_ts) -> DataFrame:
    """Snapshot keys missing from the dimension; create_dt = batch time,
    update_dt null."""
    return anti_join(snapshot.select(key, *attrs), dim.select(key), key).select(
        key, *attrs, _ts(batch_ts).alias("create_dt"), F.lit(None).cast("timestamp_ntz").alias("update_dt"))


def scd1_update(dim, snapshot, key, attrs, batch_ts, change: str = "any") -> DataFrame:
    """Stored keys whose attributes changed, with the new values,
    create_dt kept and update_dt = batch time."""
    return _matched(dim, snapshot, key, attrs, change).select(
        F.col("_new").getField(key).alias(key), *[F.col(f"_new.{a}") for a in attrs],
        F.col("_old.create_dt").alias("create_dt"), _ts(batch_ts).alias("update_dt"))


def scd1_delete(dim, snapshot, key, attrs, batch_ts=None) -> DataFrame:
    """D3: stored rows whose key is gone from the snapshot (they are removed)."""
    return anti_join(dim, snapshot.select(key), key)


def scd1_apply(dim, snapshot, key, attrs, batch_ts, change: str = "any") -> DataFrame:
    """D1 + D2 + D3: the dimension after today's snapshot."""
    ch = scd1_changes(dim, snapshot, key, attrs, batch_ts, change)
    return ch.where(F.col(ACTION) != DELETE).drop(ACTION)


# SCD2 -------------------------------------------------------------------------------

def scd2_changes(hist: DataFrame, snapshot: DataFrame, key: str, attrs: list[str],
                 batch_ts, change: str = "any") -> DataFrame:
    """Every row of the new history with ``_action``:

    * ``insert``  (D4) first version of a key that has no version at all;
    * ``close``   (D5) the open version of a changed key, old values kept,
      effective_to = batch time;
    * ``open``    (D6) the new version of a changed key;
    * ``delete``  (D7) any version of a key gone from the snapshot, flagged
      deleted (effective_to is left as it is);
    * ``same``    every other version, unchanged.

    Every key of a history built by these operators has exactly one open
    version (deletion flags versions, it does not close them), so only the
    open versions are compared with the snapshot: the full outer join moves
    one row per key, however many versions accumulate.  Closed versions
    only take the deleted flag, from the keys gone today (a small set,
    joined by broadcast when it fits).
    """
    open_v = hist.where(F.col("effective_to").isNull())
    closed_v = hist.where(F.col("effective_to").isNotNull())
    p = _pair(open_v, snapshot, key, attrs)
    changed = _change_test(attrs, change)
    bts = _ts(batch_ts)
    null_ts = F.lit(None).cast("timestamp_ntz")

    def version(src: str, eff_from: Column, eff_to: Column, deleted: Column, action: str) -> Column:
        fields = [F.col("_key").alias(key)]
        fields += [F.col(f"{src}.{a}").alias(a) for a in attrs]
        fields += [eff_from.alias("effective_from"), eff_to.alias("effective_to"),
                   deleted.cast("boolean").alias("deleted"), F.lit(action).alias(ACTION)]
        return F.struct(*fields)

    old_ver = lambda deleted, action, eff_to=null_ts: version(
        "_old", F.col("_old.effective_from"), eff_to, deleted, action)
    new_ver = lambda action: version("_new", bts, null_ts, F.lit(False), action)

    rows = (F.when(F.col("_old").isNull(), F.array(new_ver(INSERT)))
             .when(F.col("_new").isNull(), F.array(old_ver(F.lit(True), DELETE)))
             .when(changed, F.array(old_ver(F.col("_old.deleted"), CLOSE, bts), new_ver(OPEN)))
             .otherwise(F.array(old_ver(F.col("_old.deleted"), SAME))))
    live = p.select(F.explode(rows).alias("_v")).select("_v.*")

    # keys only: the open versions whose key the snapshot lacks
    gone = (anti_join(open_v.select(key), snapshot.select(key), key).where(F.col(key).isNotNull())
            .withColumn("_gone", F.lit(True)))
    flag = F.coalesce(F.col("_gone"), F.lit(False))
    closed = closed_v.join(gone, key, "left").select(
        key, *attrs, "effective_from", "effective_to",
        (F.col("deleted") | flag).alias("deleted"),
        F.when(flag, F.lit(DELETE)).otherwise(F.lit(SAME)).alias(ACTION))
    return live.unionByName(closed)


def _version(src: str, key: str, attrs: list[str], eff_from: Column, eff_to: Column, deleted: Column) -> list[Column]:
    return [F.col(src).getField(key).alias(key), *[F.col(f"{src}.{a}") for a in attrs],
            eff_from.alias("effective_from"), eff_to.alias("effective_to"), deleted.cast("boolean").alias("deleted")]


def _open_versions(hist: DataFrame) -> DataFrame:
    return hist.where(F.col("effective_to").isNull())


def scd2_insert(hist, snapshot, key, attrs, batch_ts, change: str = "any") -> DataFrame:
    """First versions of keys new to the history."""
    return anti_join(snapshot.select(key, *attrs), _open_versions(hist).select(key), key).select(
        key, *attrs, _ts(batch_ts).alias("effective_from"), F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(False).alias("deleted"))


def scd2_close(hist, snapshot, key, attrs, batch_ts, change: str = "any") -> DataFrame:
    """Open versions of changed keys, closed at the batch time."""
    return _matched(_open_versions(hist), snapshot, key, attrs, change).select(
        *_version("_old", key, attrs, F.col("_old.effective_from"), _ts(batch_ts), F.col("_old.deleted")))


def scd2_open(hist, snapshot, key, attrs, batch_ts, change: str = "any") -> DataFrame:
    """New open versions of changed keys."""
    return _matched(_open_versions(hist), snapshot, key, attrs, change).select(
        *_version("_new", key, attrs, _ts(batch_ts), F.lit(None).cast("timestamp_ntz"), F.lit(False)))


def scd2_mark_deleted(hist, snapshot, key, attrs, batch_ts=None, change: str = "any") -> DataFrame:
    """All versions of keys gone from the snapshot, flagged deleted."""
    named = hist.where(F.col(key).isNotNull() | F.col("effective_to").isNull())
    return anti_join(named, snapshot.select(key), key).select(
        key, *attrs, "effective_from", "effective_to", F.lit(True).alias("deleted"))


def scd2_apply(hist, snapshot, key, attrs, batch_ts, change: str = "any") -> DataFrame:
    """The history after today's snapshot."""
    return scd2_changes(hist, snapshot, key, attrs, batch_ts, change).drop(ACTION)
