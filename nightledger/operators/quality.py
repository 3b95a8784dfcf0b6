"""K1-K6: data-quality checks in place of database constraints.

Each check returns a DataFrame of violations (or a per-table summary), so a
run can fail, or report the offending rows and go on, instead of a constraint
aborting the load.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_decimal_comma
from ..session import together, written


def _key_text(keys: list[str]):
    """The key as text; null if any part is null."""
    return F.concat(*[x for k in keys for x in (F.lit("|"), F.col(k).cast("string"))][1:])


def _repeated(df: DataFrame, keys: list[str], required: list[str]) -> DataFrame:
    """Key values held by more than one row: the key, ``n_rows``, and ``n_sound``, its rows with every required value."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    sound = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.lit(True))
    return (df.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(sound, 1)).alias("n_sound"))
              .where(F.col("n_rows") > 1))


def repeated_keys(df: DataFrame, keys: list[str], required: list[str]) -> DataFrame:
    """``_repeated``, written: the keys are grouped once for K1 and ``set_aside``, and Spark knows how few there are
    before it plans a join of whole rows with them."""
    return written(_repeated(df, keys, required), "repeated-keys")


def duplicate_keys(df: DataFrame, keys: list[str], table_name: str, repeated: DataFrame | None = None) -> DataFrame:
    """K1/K2: key values held by more than one row: (table_name, key_value,
    n_rows); keys with a null part are K3's.  A grouped count, combined map-side before the shuffle, so a
    heavily repeated key costs one partial count per task.  ``repeated``: from ``repeated_keys``, if at hand."""
    repeated = _repeated(df, keys, []) if repeated is None else repeated
    return repeated.select(F.lit(table_name).alias("table_name"), _key_text(keys).alias("key_value"), "n_rows")


def null_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """K3: rows with a null in any key column."""
    return df.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def null_key_summary(df: DataFrame, keys: list[str], table_name: str) -> DataFrame:
    """K3 as one row: (table_name, n_rows, n_null_keys)."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count(F.when(any_null, 1)).alias("n_null_keys")) \
             .select(F.lit(table_name).alias("table_name"), "n_rows", "n_null_keys")


def orphans(child: DataFrame, child_key: str, fk: str, parent: DataFrame, pk: str,
            relation: str) -> DataFrame:
    """K4/K5: child rows whose non-null foreign key has no parent:
    (relation, child_key, fk_value).  The distinct foreign keys meet the parents and the lost ones are written;
    the children are only scanned for them, not shuffled, while those are few."""
    c = child.select(F.col(child_key).alias("child_key"), F.col(fk).alias("fk_value")) \
             .where(F.col("fk_value").isNotNull())
    p = parent.select(F.col(pk).alias("fk_value"))
    lost = written(c.select("fk_value").distinct().join(p, "fk_value", "left_anti"), "lost-keys")
    return c.join(lost, "fk_value", "left_semi").select(
        F.lit(relation).alias("relation"), "child_key", "fk_value")


def orphans_after(open_findings: DataFrame, new_children: DataFrame, old_children: DataFrame, child_key: str, fk: str,
                  parent_before: DataFrame, parent_after: DataFrame, pk: str, relation: str,
                  append_only: bool = False) -> DataFrame:
    """K4/K5 from the findings of the day before: the same rows as ``orphans`` over all children.

    ``new_children`` are new or changed today, ``old_children`` the rows that are as they were (with
    ``append_only`` all earlier rows).  Checked are the new children against all parents, and the old ones
    against the parents gone today; an open finding goes when its parent is back or its row is gone or
    changed.  The old children meet only the gone keys, which Spark broadcasts when they are few."""
    pairs = lambda df: df.select(F.col(child_key).alias("child_key"), F.col(fk).alias("fk_value"))
    keys = lambda df: df.select(F.col(pk).alias("fk_value")).where("fk_value is not null").distinct()
    before, after = keys(parent_before), keys(parent_after)
    gone, back = (written(a.join(b, "fk_value", "left_anti"), "parent-keys") for a, b in ((before, after), (after, before)))
    still = open_findings.where(F.col("relation") == relation).select("child_key", "fk_value").join(back, "fk_value", "left_anti")
    kept = pairs(old_children)
    if not append_only:
        k = kept.select(F.col("child_key").alias("k"), F.col("fk_value").alias("v"))
        still = still.join(k, F.col("child_key").eqNullSafe(F.col("k")) & (F.col("fk_value") == F.col("v")), "left_semi")
    lost = kept.join(gone, "fk_value", "left_semi")
    fresh = orphans(new_children, child_key, fk, parent_after, pk, relation)
    return fresh.unionByName(still.unionByName(lost).select(F.lit(relation).alias("relation"), "child_key", "fk_value"))


def bad_amount_rows(text: DataFrame, amount_col: str = "amount") -> DataFrame:
    """K6: rows whose amount text is present but does not parse."""
    return text.where(F.col(amount_col).isNotNull() & parse_decimal_comma(amount_col).isNull())


def bad_amount_summary(text: DataFrame, table_name: str, amount_col: str = "amount") -> DataFrame:
    """K6 as one row: (table_name, n_rows, n_null_amounts, n_bad_amounts)."""
    a = F.col(amount_col)
    return text.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(a.isNull(), 1)).alias("n_null_amounts"),
        F.count(F.when(a.isNotNull() & parse_decimal_comma(a).isNull(), 1)).alias("n_bad_amounts"),
    ).select(F.lit(table_name).alias("table_name"), "n_rows", "n_null_amounts", "n_bad_amounts")


# Foreign keys of the warehouse: (relation, child table, child key, fk, parent table, pk).
FOREIGN_KEYS = [
    ("accounts.client->clients", "accounts", "account_num", "client", "clients", "client_id"),
    ("cards.account_num->accounts", "cards", "card_num", "account_num", "accounts", "account_num"),
    ("transactions.card_num->cards", "transactions", "trans_id", "card_num", "cards", "card_num"),
    ("transactions.terminal->terminals", "transactions", "trans_id", "terminal", "terminals", "terminal_id"),
]
PRIMARY_KEYS = {"clients": ["client_id"], "accounts": ["account_num"], "cards": ["card_num"],
                "terminals": ["terminal_id"], "transactions": ["trans_id"]}


# Values that must have been parsed for a row to be loaded (K6).
REQUIRED = {"transactions": ["amt", "trans_date"]}


def set_aside(df: DataFrame, keys: list[str], required: list[str], repeated: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows to load, rows set aside with ``reason`` and ``n_rows`` copies).

    Set aside are rows with a null key or a null required value, and of the rows that share
    a key all but the smallest one (by all columns), so every key keeps one row.  The choice
    is an aggregate (partial per task first): a key with very many rows meets in one
    small buffer, not in one sorted group.  ``repeated``: from ``repeated_keys``, if at hand.
    """
    cols = df.columns
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    unparsed = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required], F.lit(False))
    marked = df.withColumn("_why", F.when(null_key, "null_key").when(unparsed, "unparsed_value"))
    sound = marked.where("_why is null").drop("_why")
    # the keys alone are grouped; whole rows only where a key is repeated
    repeated = repeated_keys(df, keys, required) if repeated is None else repeated
    repeated = repeated.where("n_sound > 1").select(*[F.col(k).alias(f"_{k}") for k in keys])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys])
    copies = sound.join(repeated, on).groupBy(*cols, *[f"_{k}" for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
    first = copies.groupBy(*[F.col(f"_{k}").alias(f"_f_{k}") for k in keys]).agg(F.min(F.struct(*cols)).alias("_first"))
    good = sound.join(repeated, on, "left_anti").unionByName(first.select("_first.*").select(*cols))
    # copies of the kept row itself count one less
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_f_{k}") for k in keys])
    extra = (copies.join(first, same)
             .withColumn("n_rows", F.col("n_rows") - F.struct(*cols).eqNullSafe(F.col("_first")).cast("long"))
             .where("n_rows > 0").select(*cols, F.lit("duplicate_key").alias("reason"), "n_rows"))
    # on the columns themselves: files without nulls are not read
    broken = (marked.where(null_key | unparsed).groupBy(*cols, F.col("_why").alias("reason"))
              .agg(F.count(F.lit(1)).alias("n_rows")))
    return good, extra.unionByName(broken)


CHECKS = ("duplicate_keys", "null_keys", "orphans")


def check_all(tables: dict[str, DataFrame], checks: tuple[str, ...] = CHECKS,
              repeated: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Run K1, K3 and K4, or those asked for, over a set of staged tables keyed by name; ``repeated`` holds
    the tables' ``repeated_keys``, if at hand."""
    has = {t: k for t, k in PRIMARY_KEYS.items() if t in tables}
    found = {"duplicate_keys": lambda: [duplicate_keys(tables[t], k, t, (repeated or {}).get(t)) for t, k in has.items()],
             "null_keys": lambda: [null_key_summary(tables[t], k, t) for t, k in has.items()],
             "orphans": lambda: together(*[lambda r=r: orphans(tables[r[1]], r[2], r[3], tables[r[4]], r[5], r[0])
                                           for r in FOREIGN_KEYS if r[1] in tables and r[4] in tables])}
    u = lambda xs: reduce(DataFrame.unionByName, xs) if xs else None
    return {check: u(found[check]()) for check in checks}


def violations(tables: dict[str, DataFrame], repeated: dict[str, DataFrame] | None = None) -> DataFrame:
    """All K1, K3, K4 and K6 findings over staged tables in one shape:
    (check, table_name, key_value, detail)."""
    c = check_all(tables, repeated=repeated)
    parts = []
    if c["duplicate_keys"] is not None:
        parts.append(c["duplicate_keys"].select(
            F.lit("duplicate_key").alias("check"), "table_name", "key_value",
            F.col("n_rows").cast("string").alias("detail")))
        parts.append(c["null_keys"].where(F.col("n_null_keys") > 0).select(
            F.lit("null_key").alias("check"), "table_name", F.lit(None).cast("string").alias("key_value"),
            F.col("n_null_keys").cast("string").alias("detail")))
    if c["orphans"] is not None:
        parts.append(c["orphans"].select(
            F.lit("orphan").alias("check"), F.col("relation").alias("table_name"),
            F.col("child_key").alias("key_value"), F.col("fk_value").alias("detail")))
    if "transactions" in tables:
        t = tables["transactions"]
        bad = t.where(F.col("amt").isNull() | F.col("trans_date").isNull())
        parts.append(bad.select(
            F.lit("unparsed_value").alias("check"), F.lit("transactions").alias("table_name"),
            F.col("trans_id").alias("key_value"),
            F.concat_ws(",", F.when(F.col("amt").isNull(), F.lit("amt")),
                        F.when(F.col("trans_date").isNull(), F.lit("trans_date"))).alias("detail")))
    if not parts:
        raise ValueError("no table to check")
    return reduce(DataFrame.unionByName, parts)


def open_version_violations(hist: DataFrame, key: str) -> DataFrame:
    """SCD2 histories built by ``scd.scd2_apply`` hold exactly one open
    version per key (the comparison reads only those).  Keys breaking that:
    (key_value, n_open)."""
    n_open = F.sum(F.when(F.col("effective_to").isNull(), 1).otherwise(0))
    return (hist.groupBy(key).agg(n_open.alias("n_open")).where(F.col("n_open") != 1)
                .select(F.col(key).cast("string").alias("key_value"), F.col("n_open").cast("bigint")))
