"""Table schemas, table names and the fixed literals of the warehouse.

Every table is declared here as an explicit ``StructType``; no reader in the
package infers a schema.  Timestamps are ``TimestampNTZType`` throughout: the
warehouse stores wall-clock times without a zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, B = T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType()
AMOUNT = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --------------------------------------------------------------------------
# Fixed values.  These literals must equal the original job's so that the
# report and the control tables read the same.
# --------------------------------------------------------------------------
EVENT_PASSPORT = "заблокированный или просроченный паспорт"
EVENT_CONTRACT = "недействующий договор"
EVENT_MULTI_CITY = "операции в разных городах"
EVENT_AMOUNT_PROBE = "попытка подбора суммы"
OPER_SUCCESS = "SUCCESS"
OPER_REJECT = "REJECT"
BATCH_LABEL_FORMAT = "ddMMyyyy"
BATCH_LABEL_SEED = "01032021"
META_SCHEMA_NAME = "public"
META_SEED_TS = "1900-01-01 00:00:00"
# Input file name patterns; {dt} is the batch label.
TRANSACTIONS_FILE = "transactions_{dt}.txt"
TERMINALS_FILE = "terminals_file_{dt}"
BLACKLIST_FILE = "passport_blacklist_{dt}"
# Column names in the daily transactions file (header row), and the order the
# job keeps them in.
TRANSACTIONS_FILE_COLUMNS = [
    "transaction_id", "transaction_date", "card_num", "oper_type",
    "amount", "oper_result", "terminal",
]
# Column names in the daily blacklist sheet, in the order the job keeps them.
BLACKLIST_FILE_COLUMNS = ["passport", "date"]
# --------------------------------------------------------------------------

# Staging tables ------------------------------------------------------------
STG_CLIENTS = _struct(
    ("client_id", S), ("last_name", S), ("first_name", S), ("patrinymic", S),
    ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D),
    ("phone", S), ("create_dt", TS), ("update_dt", TS),
)
# valid_to is a timestamp at the source; staging casts it to a date so that a
# time part never looks like a change against the date-typed dimension.
SRC_ACCOUNTS = _struct(
    ("account_num", S), ("valid_to", TS), ("client", S),
    ("create_dt", TS), ("update_dt", TS),
)
STG_ACCOUNTS = _struct(
    ("account_num", S), ("valid_to", D), ("client", S),
    ("create_dt", TS), ("update_dt", TS),
)
STG_CARDS = _struct(
    ("card_num", S), ("account_num", S), ("create_dt", TS), ("update_dt", TS),
)
STG_TERMINALS = _struct(
    ("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
    ("terminal_address", S),
)
STG_TRANSACTIONS = _struct(
    ("trans_id", S), ("trans_date", TS), ("card_num", S), ("oper_type", S),
    ("amt", AMOUNT), ("oper_result", S), ("terminal", S),
)
STG_BLACKLIST = _struct(("passport_num", S), ("entry_dt", TS))

# Raw text layout of the daily transactions file (all strings, parsed later).
TRANSACTIONS_FILE_TEXT = _struct(*[(c, S) for c in TRANSACTIONS_FILE_COLUMNS])

# Warehouse dimensions (SCD1) -------------------------------------------------
DIM_CLIENTS = STG_CLIENTS
DIM_ACCOUNTS = STG_ACCOUNTS
DIM_CARDS = STG_CARDS
DIM_TERMINALS = _struct(
    ("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
    ("terminal_address", S), ("create_dt", TS), ("update_dt", TS),
)
FACT_TRANSACTIONS = STG_TRANSACTIONS
FACT_BLACKLIST = STG_BLACKLIST


def _hist(dim_key: str, attrs: list[tuple[str, T.DataType]]) -> T.StructType:
    return _struct((dim_key, S), *attrs, ("effective_from", TS),
                   ("effective_to", TS), ("deleted", B))


# Per-dimension key and tracked attributes.  One place drives SCD1, SCD2 and
# the history schemas.
DIMENSIONS: dict[str, dict] = {
    "terminals": {
        "key": "terminal_id",
        "attrs": [("terminal_type", S), ("terminal_city", S), ("terminal_address", S)],
    },
    "clients": {
        "key": "client_id",
        "attrs": [("last_name", S), ("first_name", S), ("patrinymic", S),
                  ("date_of_birth", D), ("passport_num", S),
                  ("passport_valid_to", D), ("phone", S)],
    },
    "accounts": {
        "key": "account_num",
        "attrs": [("valid_to", D), ("client", S)],
    },
    "cards": {
        "key": "card_num",
        "attrs": [("account_num", S)],
    },
}

HIST = {name: _hist(d["key"], d["attrs"]) for name, d in DIMENSIONS.items()}
DIM = {"terminals": DIM_TERMINALS, "clients": DIM_CLIENTS,
       "accounts": DIM_ACCOUNTS, "cards": DIM_CARDS}


def dim_key(name: str) -> str:
    return DIMENSIONS[name]["key"]


def dim_attrs(name: str) -> list[str]:
    return [a for a, _ in DIMENSIONS[name]["attrs"]]


REPORT = _struct(
    ("event_dt", TS), ("passport", S), ("fio", S), ("phone", S),
    ("event_type", S), ("report_dt", D),
)
META = _struct(("schema_name", S), ("table_name", S), ("max_update_dt", TS))
CONTROL = _struct(("dt", S))

# Warehouse table names used in the metadata table.
FACT_TABLES = ["dwh_fact_transactions", "dwh_fact_blacklist"]
DIM_TABLES = {n: f"dwh_dim_{n}" for n in DIMENSIONS}
HIST_TABLES = {n: f"dwh_dim_{n}_hist" for n in DIMENSIONS}
META_TABLES = FACT_TABLES + list(DIM_TABLES.values()) + list(HIST_TABLES.values())

ENRICHED_COLUMNS = [
    "trans_id", "trans_date", "amt", "oper_result", "passport_valid_to",
    "passport_num", "fio", "phone", "terminal_city", "account_num",
    "valid_to", "client_id",
]
