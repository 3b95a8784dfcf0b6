"""Run one daily batch from the command line (what a scheduler starts).

    spark-submit --py-files nightledger.zip run_daily.py \\
        --store <shared root> --drop <incoming folder> \\
        --sources-format jdbc --jdbc-url <jdbc url> \\
        --jdbc-user <user> --jdbc-password-env <VARIABLE>

Without ``--label`` the next label kept by the store is loaded (the seed
label before the first run).  Source snapshots come from JDBC (tables
``info.clients``, ``info.accounts``, ``info.cards`` by default) or from a
folder with one sub-folder per table in any Spark file format.
"""

from __future__ import annotations

import argparse
import os

from .plans.daily_run import inputs_from_drop, next_batch_label, run_day
from .plans.store import Store
from .session import build_session
from .sources.tables import read_source_table

SOURCE_TABLES = ("clients", "accounts", "cards")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="nightledger", description=__doc__.split("\n")[0])
    p.add_argument("--store", required=True, help="warehouse root (shared storage)")
    p.add_argument("--drop", required=True, help="folder with the daily files")
    p.add_argument("--label", help="batch label ddMMyyyy (default: next one kept by the store)")
    p.add_argument("--sheet-format", default="csv", help="format of the terminals/blacklist sheets")
    p.add_argument("--sources-format", default="parquet", help="'jdbc' or a Spark file format")
    p.add_argument("--sources", help="folder with clients/accounts/cards sub-folders (file formats)")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    p.add_argument("--jdbc-schema", default="info")
    p.add_argument("--jdbc-partitions", type=int, default=0,
                   help="split each source read into this many range queries on --jdbc-partition-column")
    p.add_argument("--jdbc-partition-column")
    p.add_argument("--jdbc-lower-bound")
    p.add_argument("--jdbc-upper-bound")
    p.add_argument("--batch-ts", help="load timestamp (default: now)")
    p.add_argument("--report-dt", help="report date (default: today)")
    p.add_argument("--report-since", help="report operations from this time on (default: all history)")
    p.add_argument("--on-violation", default="report", choices=["fail", "report", "ignore"])
    a = p.parse_args(argv)

    spark = build_session()
    store = Store(spark, a.store)
    label = a.label or next_batch_label(store)

    def source(name: str):
        if a.sources_format == "jdbc":
            props = {"user": a.jdbc_user} if a.jdbc_user else {}
            if a.jdbc_password_env:
                props["password"] = os.environ[a.jdbc_password_env]
            return read_source_table(
                spark, f"{a.jdbc_schema}.{name}", fmt="jdbc", jdbc_url=a.jdbc_url, properties=props,
                partition_column=a.jdbc_partition_column if a.jdbc_partitions else None,
                lower_bound=a.jdbc_lower_bound, upper_bound=a.jdbc_upper_bound,
                num_partitions=a.jdbc_partitions or None)
        return read_source_table(spark, name, fmt=a.sources_format, path=f"{a.sources.rstrip('/')}/{name}")

    clients, accounts, cards = (source(n) for n in SOURCE_TABLES)
    inputs = inputs_from_drop(spark, a.drop, label, clients, accounts, cards, a.sheet_format)
    run_day(store, label, inputs, batch_ts=a.batch_ts, report_dt=a.report_dt,
            on_violation=a.on_violation, report_since=a.report_since)
    print(f"batch {label} committed; next {store.next_label()}")


if __name__ == "__main__":
    main()
