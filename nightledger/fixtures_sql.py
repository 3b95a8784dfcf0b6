"""The fixture mapping of ``fixtures.py`` written as DuckDB SQL, plus the
oracle query for every registered query.  The driver runs these next to the
Spark queries on the same parquet tables (views ``customer``, ``supplier``,
``nation``, ``events`` ...)."""

from __future__ import annotations

from . import schemas as sch
from .fixtures import OLD_VERSION as _OLD_VERSION
from .fixtures import side_columns

DAY0 = "DATE '2024-01-01'"
DAY0_TS = "TIMESTAMP '2024-01-01 00:00:00'"
BATCH_TS = "TIMESTAMP '2024-02-01 09:00:00'"
REPORT_DT = "DATE '2024-02-01'"
OLD_FROM = "TIMESTAMP '2023-12-01 00:00:00'"


def _plus_days(d: str, n: str) -> str:
    return f"CAST({d} + CAST({n} AS INTEGER) AS DATE)"


# Base mapping ------------------------------------------------------------------
CLIENTS_K = f"""
SELECT c_custkey AS _k,
       'C' || c_custkey AS client_id,
       c_mktsegment AS last_name,
       c_name AS first_name,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'N' || c_nationkey END AS patrinymic,
       {_plus_days("DATE '1960-01-01'", "c_custkey % 15000")} AS date_of_birth,
       'P' || c_custkey AS passport_num,
       {_plus_days(DAY0, "(c_custkey * 7) % 60")} AS passport_valid_to,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE '+7' || c_custkey END AS phone,
       {DAY0_TS} AS create_dt,
       CAST(NULL AS TIMESTAMP) AS update_dt
FROM customer"""

ACCOUNTS_K = f"""
SELECT c_custkey AS _k,
       'A' || c_custkey AS account_num,
       {_plus_days(DAY0, "(c_custkey * 13) % 90")} AS valid_to,
       'C' || c_custkey AS client,
       {DAY0_TS} AS create_dt,
       CAST(NULL AS TIMESTAMP) AS update_dt
FROM customer"""

CARDS_K = f"""
SELECT c_custkey * 2 + j AS _k,
       'K' || c_custkey || '-' || j AS card_num,
       'A' || c_custkey AS account_num,
       {DAY0_TS} AS create_dt,
       CAST(NULL AS TIMESTAMP) AS update_dt
FROM customer CROSS JOIN (VALUES (0), (1)) AS js(j)"""

TERMINALS_K = """
SELECT s_suppkey AS _k,
       'T' || s_suppkey AS terminal_id,
       CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
       n_name AS terminal_city,
       s_name AS terminal_address
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def transactions_sql(compress_time: bool = False) -> str:
    t = ("make_timestamp((epoch_us(ts) - 1704067200000000) // 60 + 1704067200000000)"
         if compress_time else "ts")
    return f"""
SELECT CAST(event_id AS VARCHAR) AS trans_id,
       {t} AS trans_date,
       'K' || user_id || '-' || (event_id % 2) AS card_num,
       event_type AS oper_type,
       CAST(value AS DECIMAL(18,2)) AS amt,
       CASE WHEN event_type IN ('error', 'view', 'click') THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
       'T' || (event_id % 10) AS terminal
FROM events"""


BLACKLIST = f"""
SELECT 'P' || c_custkey AS passport_num, {DAY0_TS} AS entry_dt
FROM customer WHERE c_custkey % 17 = 3"""


def base_ctes(compress_time: bool = False) -> dict[str, str]:
    return {
        "clients_k": CLIENTS_K,
        "accounts_k": ACCOUNTS_K,
        "cards_k": CARDS_K,
        "terminals_k": TERMINALS_K,
        "clients": "SELECT * EXCLUDE (_k) FROM clients_k",
        "accounts": "SELECT * EXCLUDE (_k) FROM accounts_k",
        "cards": "SELECT * EXCLUDE (_k) FROM cards_k",
        "terminals": "SELECT * EXCLUDE (_k) FROM terminals_k",
        "transactions": transactions_sql(compress_time),
        "blacklist": BLACKLIST,
    }


def with_ctes(ctes: dict[str, str], body: str) -> str:
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


# Enrichment and rules ------------------------------------------------------------
ENRICHED = """
SELECT tr.trans_id, tr.trans_date, tr.amt, tr.oper_result,
       cli.passport_valid_to, cli.passport_num,
       concat(coalesce(cli.last_name, ''), ' ', coalesce(cli.first_name, ''), ' ',
              coalesce(cli.patrinymic, '')) AS fio,
       cli.phone, term.terminal_city, acc.account_num, acc.valid_to, cli.client_id
FROM transactions tr
JOIN cards ON cards.card_num = tr.card_num
JOIN terminals term ON tr.terminal = term.terminal_id
JOIN accounts acc ON cards.account_num = acc.account_num
JOIN clients cli ON acc.client = cli.client_id"""


def _report_cols(event_type: str, alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return (f"{a}trans_date AS event_dt, {a}passport_num AS passport, {a}fio, {a}phone, "
            f"'{event_type}' AS event_type, {REPORT_DT} AS report_dt")


F1 = f"""SELECT {_report_cols(sch.EVENT_PASSPORT)} FROM enriched
WHERE passport_valid_to < trans_date OR passport_num IN (SELECT passport_num FROM blacklist)"""

F2 = f"""SELECT {_report_cols(sch.EVENT_CONTRACT)} FROM enriched WHERE valid_to < trans_date"""

MULTI_CITY_HOURS = """SELECT client_id, date_trunc('hour', trans_date) AS hour,
       count(DISTINCT terminal_city) AS n_cities
FROM enriched GROUP BY client_id, date_trunc('hour', trans_date)
HAVING count(DISTINCT terminal_city) > 1"""

F3 = f"""SELECT DISTINCT {_report_cols(sch.EVENT_MULTI_CITY, 'e')}
FROM enriched e JOIN ({MULTI_CITY_HOURS}) g
  ON e.client_id = g.client_id AND date_trunc('hour', e.trans_date) = g.hour"""

LAGS = """SELECT client_id, trans_date, trans_id, amt, oper_result,
  row_number() OVER w AS rk,
  lag(trans_date, 1) OVER w AS t1, lag(trans_date, 2) OVER w AS t2,
  lag(amt, 1) OVER w AS amt_lag1, lag(amt, 2) OVER w AS amt_lag2,
  lag(oper_result, 1) OVER w AS res_lag1, lag(oper_result, 2) OVER w AS res_lag2
FROM enriched
WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id)"""

_PROBE = """res_lag2 = 'REJECT' AND res_lag1 = 'REJECT' AND oper_result = 'SUCCESS'
  AND amt_lag2 > amt_lag1 AND amt_lag1 > amt"""


def f4(elapsed: bool = False) -> str:
    gap = ("trans_date - t2 <= INTERVAL 20 MINUTE" if elapsed
           else "extract(minute FROM (trans_date - t1) + (trans_date - t2)) <= 20")
    return f"""SELECT {_report_cols(sch.EVENT_AMOUNT_PROBE, 'e')}
FROM enriched e JOIN (SELECT client_id, trans_date FROM ({LAGS}) l WHERE {_PROBE} AND {gap}) h
  ON e.client_id = h.client_id AND e.trans_date = h.trans_date"""


def enriched_ctes(compress_time: bool = False) -> dict[str, str]:
    c = base_ctes(compress_time)
    c["enriched"] = ENRICHED
    return c


# Snapshot pairs (prev = stored, curr = today's staging) ----------------------------
# The change scenario is shared with fixtures.py (data, not logic).


def _side(dim: str, side: str) -> str:
    drop = 9 if side == "prev" else 8
    return f"SELECT _k, {', '.join(side_columns(dim, side))} FROM {dim}_k WHERE _k % 10 <> {drop}"


def scd_ctes(dim: str, p: str = "", base: bool = True) -> dict[str, str]:
    """CTEs ``prev``, ``curr``, ``dim`` (stored SCD1 table) and ``hist``
    (stored SCD2 table) for one dimension, names prefixed with ``p``."""
    key, attrs = sch.dim_key(dim), sch.dim_attrs(dim)
    c = base_ctes() if base else {}
    alist = ", ".join(attrs)
    old_col, old_expr = _OLD_VERSION[dim]
    old_attrs = ", ".join(f"{old_expr} AS {a}" if a == old_col else a for a in attrs)
    c[f"{p}prev"] = _side(dim, "prev")
    c[f"{p}curr"] = _side(dim, "curr")
    c[f"{p}dim"] = (f"SELECT {key}, {alist}, {DAY0_TS} AS create_dt, "
                    f"CAST(NULL AS TIMESTAMP) AS update_dt FROM {p}prev")
    c[f"{p}hist"] = (
        f"SELECT {key}, {alist}, {DAY0_TS} AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, "
        f"false AS deleted FROM {p}prev UNION ALL "
        f"SELECT {key}, {old_attrs}, {OLD_FROM} AS effective_from, {DAY0_TS} AS effective_to, "
        f"false AS deleted FROM {p}prev WHERE _k % 10 IN (7, 8)")
    return c


def _changed(attrs: list[str], a: str, b: str, all_: bool = False) -> str:
    j = " AND " if all_ else " OR "
    return "(" + j.join(f"{a}.{x} IS DISTINCT FROM {b}.{x}" for x in attrs) + ")"


def scd1_body(dim: str, what: str, all_changed: bool = False, p: str = "") -> str:
    key, attrs = sch.dim_key(dim), sch.dim_attrs(dim)
    ch = _changed(attrs, "c", "d", all_changed)
    c_attrs = ", ".join(f"c.{a}" for a in attrs)
    d_attrs = ", ".join(f"d.{a}" for a in attrs)
    curr, dim_ = f"{p}curr", f"{p}dim"
    ins = (f"SELECT c.{key}, {c_attrs}, {BATCH_TS} AS create_dt, CAST(NULL AS TIMESTAMP) AS update_dt "
           f"FROM {curr} c LEFT JOIN {dim_} d ON c.{key} = d.{key} WHERE d.{key} IS NULL")
    upd = (f"SELECT c.{key}, {c_attrs}, d.create_dt, {BATCH_TS} AS update_dt "
           f"FROM {curr} c JOIN {dim_} d ON c.{key} = d.{key} WHERE {ch}")
    same = (f"SELECT d.{key}, {d_attrs}, d.create_dt, d.update_dt "
            f"FROM {curr} c JOIN {dim_} d ON c.{key} = d.{key} WHERE NOT {ch}")
    dele = f"SELECT d.* FROM {dim_} d LEFT JOIN {curr} c ON c.{key} = d.{key} WHERE c.{key} IS NULL"
    return {"insert": ins, "update": upd, "delete": dele,
            "apply": f"{ins} UNION ALL {upd} UNION ALL {same}"}[what]


def scd1_sql(dim: str, what: str, all_changed: bool = False) -> str:
    return with_ctes(scd_ctes(dim), scd1_body(dim, what, all_changed))


def scd2_sql(dim: str, what: str) -> str:
    key, attrs = sch.dim_key(dim), sch.dim_attrs(dim)
    ch = _changed(attrs, "c", "h")
    c_attrs = ", ".join(f"c.{a}" for a in attrs)
    h_attrs = ", ".join(f"h.{a}" for a in attrs)
    ins = (f"SELECT c.{key}, {c_attrs}, {BATCH_TS} AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, "
           f"false AS deleted FROM curr c WHERE c.{key} NOT IN (SELECT {key} FROM hist)")
    close = (f"SELECT h.{key}, {h_attrs}, h.effective_from, {BATCH_TS} AS effective_to, h.deleted "
             f"FROM hist h JOIN curr c ON c.{key} = h.{key} WHERE h.effective_to IS NULL AND {ch}")
    opn = (f"SELECT c.{key}, {c_attrs}, {BATCH_TS} AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, "
           f"false AS deleted FROM hist h JOIN curr c ON c.{key} = h.{key} WHERE h.effective_to IS NULL AND {ch}")
    dele = (f"SELECT h.{key}, {h_attrs}, h.effective_from, h.effective_to, true AS deleted "
            f"FROM hist h WHERE h.{key} NOT IN (SELECT {key} FROM curr)")
    keep = (f"SELECT h.{key}, {h_attrs}, h.effective_from, h.effective_to, h.deleted "
            f"FROM hist h JOIN curr c ON c.{key} = h.{key} WHERE NOT (h.effective_to IS NULL AND {ch})")
    body = {"insert": ins, "close": close, "open": opn, "mark_deleted": dele,
            "apply": " UNION ALL ".join([ins, close, opn, dele, keep])}[what]
    return with_ctes(scd_ctes(dim), body)


def all_dims_ctes() -> dict[str, str]:
    """Base CTEs plus prefixed snapshot CTEs of all four dimensions
    (``terminals_curr``, ``clients_dim`` ...)."""
    c = base_ctes()
    for d in sch.DIMENSIONS:
        c.update(scd_ctes(d, p=f"{d}_", base=False))
    return c


# Staging, facts, metadata, control, quality ---------------------------------------
STAGE = {
    "stage_transactions": "SELECT trans_id, date_trunc('second', trans_date) AS trans_date, card_num, "
                          "oper_type, amt, oper_result, terminal FROM transactions",
    "stage_terminals": "SELECT * FROM terminals",
    "stage_blacklist": "SELECT * FROM blacklist",
    "stage_clients": "SELECT * FROM clients",
    "stage_accounts": "SELECT * FROM accounts",
    "stage_cards": "SELECT * FROM cards",
}

FACT_TRANSACTIONS_APPEND = """SELECT i.* FROM transactions i
LEFT JOIN (SELECT trans_id FROM transactions WHERE CAST(trans_id AS BIGINT) % 10 <> 9) s
  ON i.trans_id = s.trans_id WHERE s.trans_id IS NULL"""

FACT_BLACKLIST_APPEND = """SELECT i.passport_num, i.entry_dt FROM (
  SELECT 'P' || c_custkey AS passport_num, TIMESTAMP '2024-02-01 00:00:00' AS entry_dt
  FROM customer WHERE c_custkey % 17 = 3
  UNION ALL
  SELECT 'P' || c_custkey, TIMESTAMP '2024-02-01 00:00:00'
  FROM customer WHERE c_custkey % 17 = 3 AND c_custkey % 5 = 0) i
LEFT JOIN (SELECT 'P' || c_custkey AS passport_num FROM customer
           WHERE c_custkey % 17 = 3 AND c_custkey % 3 = 0) s
  ON i.passport_num = s.passport_num WHERE s.passport_num IS NULL"""


def _meta_seed() -> str:
    rows = ", ".join(f"('{sch.META_SCHEMA_NAME}', '{t}', TIMESTAMP '{sch.META_SEED_TS}')"
                     for t in sch.META_TABLES)
    return f"SELECT * FROM (VALUES {rows}) AS m(schema_name, table_name, max_update_dt)"


def _high_water() -> str:
    marks = " UNION ALL ".join(
        f"SELECT '{sch.DIM_TABLES[d]}' AS table_name, max(update_dt) AS mark "
        f"FROM ({scd1_body(d, 'apply', p=f'{d}_')})" for d in sch.DIMENSIONS)
    return (f"SELECT m.schema_name, m.table_name, coalesce(w.mark, m.max_update_dt) AS max_update_dt "
            f"FROM ({_meta_seed()}) m LEFT JOIN ({marks}) w ON m.table_name = w.table_name")


def meta_sql(stamp: bool) -> str:
    body = _high_water()
    if stamp:
        stamped = ", ".join(f"'{t}'" for t in sch.FACT_TABLES + list(sch.HIST_TABLES.values()))
        body = (f"SELECT schema_name, table_name, CASE WHEN table_name IN ({stamped}) "
                f"THEN {BATCH_TS} ELSE max_update_dt END AS max_update_dt FROM ({body})")
    return with_ctes(all_dims_ctes(), body)


NEXT_BATCH_DATE = """SELECT DISTINCT strftime(CAST(ts AS DATE), '%d%m%Y') AS dt,
       strftime(CAST(ts AS DATE) + 1, '%d%m%Y') AS next_dt FROM events"""

_PKS = {"clients": "client_id", "accounts": "account_num", "cards": "card_num",
        "terminals": "terminal_id", "transactions": "trans_id"}

DQ_DUPLICATE_KEYS = " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, CAST({k} AS VARCHAR) AS key_value, count(*) AS n_rows "
     f"FROM {t} GROUP BY {k} HAVING count(*) > 1" for t, k in _PKS.items()]
    + ["SELECT 'lineitem' AS table_name, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) "
       "AS key_value, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"])

DWH_DUPLICATE_KEYS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({k} AS VARCHAR) AS key_value, count(*) AS n_rows "
    f"FROM {'dirty' if t == 'cards' else t} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1" for t, k in _PKS.items())

DQ_NULL_KEYS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) FILTER (WHERE {k} IS NULL) AS n_null_keys "
    f"FROM {t}" for t, k in _PKS.items())


def _curr(d: str) -> str:
    return f"(SELECT * EXCLUDE (_k) FROM {d}_curr)"


DQ_ORPHANS = " UNION ALL ".join([
    f"SELECT 'accounts.client->clients' AS relation, a.account_num AS child_key, a.client AS fk_value "
    f"FROM {_curr('accounts')} a WHERE a.client IS NOT NULL AND a.client NOT IN (SELECT client_id FROM {_curr('clients')})",
    f"SELECT 'cards.account_num->accounts', c.card_num, c.account_num "
    f"FROM {_curr('cards')} c WHERE c.account_num IS NOT NULL AND c.account_num NOT IN (SELECT account_num FROM {_curr('accounts')})",
    f"SELECT 'transactions.card_num->cards', t.trans_id, t.card_num "
    f"FROM transactions t WHERE t.card_num IS NOT NULL AND t.card_num NOT IN (SELECT card_num FROM {_curr('cards')})",
    f"SELECT 'transactions.terminal->terminals', t.trans_id, t.terminal "
    f"FROM transactions t WHERE t.terminal IS NOT NULL AND t.terminal NOT IN (SELECT terminal_id FROM {_curr('terminals')})",
])

DQ_BAD_AMOUNTS = """SELECT 'transactions' AS table_name, count(*) AS n_rows,
  count(*) FILTER (WHERE amount IS NULL) AS n_null_amounts,
  count(*) FILTER (WHERE amount IS NOT NULL AND TRY_CAST(replace(trim(amount), ',', '.') AS DECIMAL(18,2)) IS NULL)
    AS n_bad_amounts
FROM (SELECT replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS amount FROM events)"""


# The report published by the second day of a two-day run ----------------------
def daily_run_report_sql(day: int = 2) -> str:
    """F5 as the daily run of ``day`` reports it.  Day 2: all events, today's
    snapshots of the four dimensions and the stored plus today's blacklist;
    day 1: the stored events, dimensions and blacklist."""
    c = all_dims_ctes()
    for d in sch.DIMENSIONS:
        c.pop(d)                       # re-added last: it reads {d}_curr
        c[d] = f"SELECT * EXCLUDE (_k) FROM {d}_{'curr' if day == 2 else 'prev'}"
    c.pop("blacklist")
    stored = "SELECT 'P' || c_custkey AS passport_num FROM customer WHERE c_custkey % 17 = 3 AND c_custkey % 3 = 0"
    c["blacklist"] = stored + (" UNION ALL SELECT 'P' || c_custkey FROM customer WHERE c_custkey % 17 = 3" if day == 2 else "")
    if day == 1:
        c["all_transactions"] = c.pop("transactions")
        c["transactions"] = "SELECT * FROM all_transactions WHERE CAST(trans_id AS BIGINT) % 10 <> 9"
    c["enriched"] = ENRICHED
    return with_ctes(c, "\nUNION ALL\n".join(f"SELECT * FROM ({q})" for q in (F1, F2, F3, f4())))


DIRTY_CARDS = """
SELECT card_num, account_num FROM cards
UNION ALL SELECT card_num, account_num FROM cards WHERE card_num LIKE '%1-0'
UNION ALL SELECT card_num, account_num || 'x' FROM cards WHERE card_num LIKE '%2-0'
UNION ALL SELECT CAST(NULL AS VARCHAR), account_num FROM cards WHERE card_num LIKE '%3-0'"""

QUARANTINE_CARDS = """
SELECT card_num, account_num, 'null_key' AS reason, count(*) AS n_rows
FROM dirty WHERE card_num IS NULL GROUP BY card_num, account_num
UNION ALL
SELECT card_num, account_num, 'duplicate_key', n FROM (
  SELECT card_num, account_num, count(*) - CASE WHEN account_num = min(account_num) OVER (PARTITION BY card_num) THEN 1 ELSE 0 END AS n
  FROM dirty WHERE card_num IS NOT NULL GROUP BY card_num, account_num) WHERE n > 0"""

KEY_FINDINGS_CARDS = """
SELECT 'duplicate_key' AS finding, card_num AS key_value, count(*) AS n_rows
FROM dirty WHERE card_num IS NOT NULL GROUP BY card_num HAVING count(*) > 1
UNION ALL SELECT 'null_key', NULL, count(*) FROM dirty WHERE card_num IS NULL"""

DIRTY_AMOUNTS = """
SELECT 'transactions' AS table_name, count(*) AS n_rows,
       count(*) FILTER (WHERE event_id LIKE '%29') AS n_null_amounts,
       count(*) FILTER (WHERE event_id LIKE '%7' OR event_id LIKE '%18') AS n_bad_amounts
FROM (SELECT CAST(event_id AS VARCHAR) AS event_id FROM events)"""
