"""Banking inputs derived from the driver's generic tables.

The driver ships TPC-H-like tables (``customer``, ``supplier``, ``nation``,
``events``).  This module maps them onto the shapes the warehouse job reads
(client/account/card snapshots, terminals, transactions, blacklist) with
plain column expressions, so every derived table grows with the driver's
scale factor.  ``fixtures_sql`` holds the same mapping in DuckDB SQL.

Key numbers: clients, accounts and blacklist rows come from ``c_custkey``
(``k``); cards are two per customer (``k*2 + j``); terminals come from
``s_suppkey``; transactions from ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as sch

DAY0 = "2024-01-01"
# Fixed run literals shared by every fixture query and its oracle.
BATCH_TS = "2024-02-01 09:00:00"
REPORT_DT = "2024-02-01"
# Older closed history versions start here and end at DAY0.
OLD_FROM = "2023-12-01 00:00:00"


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables.  The DataFrame (not its data) is kept per
    session and path, so repeated use does not list and open the file
    again; the tables are read-only."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def _txt(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


# --------------------------------------------------------------------------
# Source snapshots (one row per key), with the number k kept as _k.
# --------------------------------------------------------------------------

# Derivations are SQL expressions: each select is one call into the JVM,
# parsed there, instead of one call per column operator.
_NOW0 = f"TIMESTAMP_NTZ'{DAY0} 00:00:00'"


def clients_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS _k",
        "concat('C', c_custkey) AS client_id",
        "c_mktsegment AS last_name",
        "c_name AS first_name",
        "CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS STRING) ELSE concat('N', c_nationkey) END AS patrinymic",
        "date_add(DATE'1960-01-01', CAST(c_custkey % 15000 AS INT)) AS date_of_birth",
        "concat('P', c_custkey) AS passport_num",
        f"date_add(DATE'{DAY0}', CAST((c_custkey * 7) % 60 AS INT)) AS passport_valid_to",
        "CASE WHEN c_custkey % 11 = 0 THEN CAST(NULL AS STRING) ELSE concat('+7', c_custkey) END AS phone",
        f"{_NOW0} AS create_dt",
        "CAST(NULL AS TIMESTAMP_NTZ) AS update_dt",
    )


def accounts_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS _k",
        "concat('A', c_custkey) AS account_num",
        f"date_add(DATE'{DAY0}', CAST((c_custkey * 13) % 90 AS INT)) AS valid_to",
        "concat('C', c_custkey) AS client",
        f"{_NOW0} AS create_dt",
        "CAST(NULL AS TIMESTAMP_NTZ) AS update_dt",
    )


def cards_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "customer")
            .selectExpr("c_custkey", "explode(array(0, 1)) AS _j")
            .selectExpr(
                "c_custkey * 2 + _j AS _k",
                "concat('K', c_custkey, '-', _j) AS card_num",
                "concat('A', c_custkey) AS account_num",
                f"{_NOW0} AS create_dt",
                "CAST(NULL AS TIMESTAMP_NTZ) AS update_dt",
            ))


def terminals_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "inner").selectExpr(
        "s_suppkey AS _k",
        "concat('T', s_suppkey) AS terminal_id",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type",
        "n_name AS terminal_city",
        "s_name AS terminal_address",
    )


def _drop_k(df: DataFrame) -> DataFrame:
    return df.drop("_k")


def clients(spark, sf_dir):
    return _drop_k(clients_k(spark, sf_dir))


def accounts(spark, sf_dir):
    return _drop_k(accounts_k(spark, sf_dir))


def cards(spark, sf_dir):
    return _drop_k(cards_k(spark, sf_dir))


def terminals(spark, sf_dir):
    return _drop_k(terminals_k(spark, sf_dir))


def transactions(spark: SparkSession, sf_dir: str, *, compress_time: bool = False) -> DataFrame:
    """Transactions from ``events``.

    ``compress_time`` maps each timestamp t to day0 + (t - day0) / 60, which
    squeezes the 30 days of events into 12 hours, so that a client's
    operations fall minutes apart instead of hours.
    """
    t = "ts"
    if compress_time:
        t = (f"{_NOW0} + make_dt_interval(0, 0, 0, CAST(floor(timestampdiff(MICROSECOND, {_NOW0}, ts) / 60)"
             " AS DECIMAL(18, 6)) / 1000000)")
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS trans_id",
        f"{t} AS trans_date",
        "concat('K', user_id, '-', event_id % 2) AS card_num",
        "event_type AS oper_type",
        f"CAST(value AS {sch.AMOUNT.simpleString()}) AS amt",
        f"CASE WHEN event_type IN ('error', 'view', 'click') THEN '{sch.OPER_REJECT}' "
        f"ELSE '{sch.OPER_SUCCESS}' END AS oper_result",
        "concat('T', event_id % 10) AS terminal",
    )


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "customer").where("c_custkey % 17 = 3")
            .selectExpr("concat('P', c_custkey) AS passport_num", f"{_NOW0} AS entry_dt"))


# --------------------------------------------------------------------------
# Snapshot pairs for change capture: prev = stored dimension, curr = today's
# staging.  prev lacks k%10=9 (inserted today), curr lacks k%10=8 (deleted
# today); k%10 in 3..6 carry attribute changes.
# --------------------------------------------------------------------------

# The change scenario, as data: (side, attribute, k % 10 values, new value as
# a SQL expression over the row).  ``fixtures_sql`` reads the same table, so
# both engines see the same inputs; the change capture itself is written
# independently on each side.
CHANGES: dict[str, list[tuple[str, str, tuple[int, ...], str]]] = {
    "terminals": [
        ("curr", "terminal_city", (3,), "'MOVED_' || terminal_city"),
        ("prev", "terminal_address", (4,), "CAST(NULL AS STRING)"),
        ("curr", "terminal_address", (5,), "CAST(NULL AS STRING)"),
    ],
    "clients": [
        ("curr", "last_name", (3,), "'X_' || last_name"),
        ("prev", "phone", (4,), "CAST(NULL AS STRING)"),
        ("curr", "phone", (5,), "CAST(NULL AS STRING)"),
        ("curr", "passport_valid_to", (6,), "CAST(passport_valid_to + 365 AS DATE)"),
    ],
    "accounts": [
        ("curr", "valid_to", (3, 5), "CAST(valid_to + 30 AS DATE)"),
        ("curr", "client", (4, 5), "'C0'"),
        ("prev", "valid_to", (6,), "CAST(NULL AS DATE)"),
    ],
    "cards": [
        ("curr", "account_num", (3,), "'A0'"),
        ("prev", "account_num", (4,), "CAST(NULL AS STRING)"),
        ("curr", "account_num", (5,), "CAST(NULL AS STRING)"),
    ],
}
# Older closed versions (k % 10 in 7, 8) differ in one attribute.
OLD_VERSION = {
    "terminals": ("terminal_city", "'OLD_' || terminal_city"),
    "clients": ("last_name", "'OLD_' || last_name"),
    "accounts": ("client", "'OLD'"),
    "cards": ("account_num", "'OLD'"),
}


def side_columns(dim: str, side: str) -> list[str]:
    """SQL select list (key, attributes) of one side of the snapshot pair."""
    cols = [sch.dim_key(dim)]
    for a in sch.dim_attrs(dim):
        expr = a
        for s, attr, ks, e in CHANGES[dim]:
            if s == side and attr == a:
                expr = f"CASE WHEN _k % 10 IN ({', '.join(map(str, ks))}) THEN {e} ELSE {expr} END"
        cols.append(f"{expr} AS {a}")
    return cols


def snapshot_pair(spark: SparkSession, sf_dir: str, dim: str) -> tuple[DataFrame, DataFrame]:
    """(prev, curr) snapshots of one dimension: key, attributes and _k.
    prev lacks k % 10 = 9 (inserted today), curr lacks k % 10 = 8 (deleted
    today)."""
    base = {"terminals": terminals_k, "clients": clients_k,
            "accounts": accounts_k, "cards": cards_k}[dim](spark, sf_dir)
    prev = base.where("_k % 10 <> 9").selectExpr("_k", *side_columns(dim, "prev"))
    curr = base.where("_k % 10 <> 8").selectExpr("_k", *side_columns(dim, "curr"))
    return prev, curr


def stored_dimension(spark: SparkSession, sf_dir: str, dim: str) -> DataFrame:
    """The SCD1 dimension as stored before today's run."""
    prev, _ = snapshot_pair(spark, sf_dir, dim)
    return prev.drop("_k").selectExpr("*", f"{_NOW0} AS create_dt", "CAST(NULL AS TIMESTAMP_NTZ) AS update_dt")


def todays_snapshot(spark: SparkSession, sf_dir: str, dim: str) -> DataFrame:
    _, curr = snapshot_pair(spark, sf_dir, dim)
    return curr.drop("_k")


def stored_history(spark: SparkSession, sf_dir: str, dim: str) -> DataFrame:
    """The SCD2 history before today's run: every stored key has an open
    version from DAY0; keys with k%10 in (7, 8) also have an older closed
    version with a different attribute value."""
    prev, _ = snapshot_pair(spark, sf_dir, dim)
    key, attrs = sch.dim_key(dim), sch.dim_attrs(dim)
    col, expr = OLD_VERSION[dim]
    open_v = prev.selectExpr(key, *attrs, f"{_NOW0} AS effective_from",
                             "CAST(NULL AS TIMESTAMP_NTZ) AS effective_to", "false AS deleted")
    closed = prev.where("_k % 10 IN (7, 8)").selectExpr(
        key, *[f"{expr} AS {a}" if a == col else a for a in attrs],
        f"TIMESTAMP_NTZ'{OLD_FROM}' AS effective_from", f"{_NOW0} AS effective_to", "false AS deleted")
    return open_v.unionByName(closed)


# Facts ----------------------------------------------------------------------

def stored_transactions(spark, sf_dir):
    """Fact rows already loaded: every event but event_id%10 = 9."""
    return transactions(spark, sf_dir).where(F.col("trans_id").cast("bigint") % 10 != 9)


def stored_blacklist(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where((k % 17 == 3) & (k % 3 == 0)).select(
        _txt("P", k).alias("passport_num"), ts(f"{DAY0} 00:00:00").alias("entry_dt"))


def incoming_blacklist(spark, sf_dir):
    """Today's blacklist sheet: every k%17=3 passport, and a second row in
    the same batch for those with k%5=0."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").where(k % 17 == 3)
    rows = c.select(k).unionByName(c.where(k % 5 == 0).select(k))
    return rows.select(_txt("P", k).alias("passport_num"), ts("2024-02-01 00:00:00").alias("entry_dt"))


# Source-shaped variants (for the staging readers) -----------------------------

def source_cards(spark, sf_dir):
    """``info.cards`` as the source serves it: card numbers padded with
    spaces and a tab."""
    c = cards(spark, sf_dir)
    return c.select(F.concat(F.lit("  "), "card_num", F.lit(" \t")).alias("card_num"),
                    "account_num", "create_dt", "update_dt")


def source_accounts(spark, sf_dir):
    """``info.accounts``: valid_to is a timestamp with a time part."""
    a = accounts_k(spark, sf_dir)
    valid = F.col("valid_to").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), (F.col("_k") % 24).cast("int"))
    return a.select("account_num", valid.alias("valid_to"), "client", "create_dt", "update_dt")


def transactions_text(spark, sf_dir) -> DataFrame:
    """Transactions rendered as the daily text file: all strings, decimal
    comma, seconds-precision timestamps, columns in file order."""
    t = transactions(spark, sf_dir)
    return t.select(
        F.col("trans_id").alias("transaction_id"),
        F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        F.regexp_replace(F.col("amt").cast("string"), r"\.", ",").alias("amount"),
        "card_num", "oper_type", "oper_result", "terminal",
    )


def terminals_sheet(spark, sf_dir) -> DataFrame:
    """Terminals sheet; its header names are free text (read by position)."""
    return terminals(spark, sf_dir).toDF("Терминал", "Тип", "Город", "Адрес")


def blacklist_sheet(spark, sf_dir) -> DataFrame:
    """Blacklist sheet with columns (date, passport)."""
    b = blacklist(spark, sf_dir)
    return b.select(F.date_format("entry_dt", "yyyy-MM-dd HH:mm:ss").alias("date"),
                    F.col("passport_num").alias("passport"))


def daily_staging(spark: SparkSession, sf_dir: str, day: int) -> dict[str, DataFrame]:
    """Staged inputs of a two-day scenario: day 1 loads the stored state
    (prev snapshots, facts but event_id % 10 = 9, the stored blacklist),
    day 2 today's snapshots, all events and today's blacklist sheet."""
    snap = ((lambda d: stored_dimension(spark, sf_dir, d).drop("create_dt", "update_dt")) if day == 1
            else (lambda d: todays_snapshot(spark, sf_dir, d)))
    stamps = ["CAST(NULL AS TIMESTAMP_NTZ) AS create_dt", "CAST(NULL AS TIMESTAMP_NTZ) AS update_dt"]
    return {
        "transactions": stored_transactions(spark, sf_dir) if day == 1 else transactions(spark, sf_dir),
        "terminals": snap("terminals"),
        "blacklist": stored_blacklist(spark, sf_dir) if day == 1 else incoming_blacklist(spark, sf_dir),
        "clients": snap("clients").selectExpr("*", *stamps),
        "accounts": snap("accounts").selectExpr("*", *stamps),
        "cards": snap("cards").selectExpr("*", *stamps),
    }


def dirty_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards with broken keys, by the card's number: some rows twice, some keys
    with a second account, some rows without a key."""
    c = cards(spark, sf_dir).select("card_num", "account_num")
    return (c.unionByName(c.where("card_num LIKE '%1-0'"))
             .unionByName(c.where("card_num LIKE '%2-0'").selectExpr("card_num", "account_num || 'x' AS account_num"))
             .unionByName(c.where("card_num LIKE '%3-0'").selectExpr("CAST(NULL AS STRING) AS card_num", "account_num")))


def dirty_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions file's id and amount, some amounts no number or finer than the column."""
    return transactions_text(spark, sf_dir).selectExpr(
        "transaction_id",
        "CASE WHEN transaction_id LIKE '%7' THEN 'n/a' WHEN transaction_id LIKE '%18' THEN amount || '1' "
        "WHEN transaction_id LIKE '%29' THEN NULL ELSE amount END AS amount")
