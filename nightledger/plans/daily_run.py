"""The daily run.

stage -> check -> SCD1 dimensions -> SCD2 history -> facts -> metadata ->
enriched table -> fraud rules -> report -> commit -> next batch label.

Each batch is a pure function of the previous committed version and the
day's inputs; rerunning the last batch publishes a new attempt at it.  Batches
are taken in order: only the label that the control table names, or the last
one again, is accepted.
Results that later steps read again (dimensions, facts) are written first
and read back, which cuts the lineage: a lost executor costs a recompute
from those files, not from the raw inputs.  The enriched table is a
maintained view (``enriched_delta``): a batch joins its new facts and the
facts of changed dimension keys, not the history.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as sch
from ..operators import facts, lookback, membership, meta, quality, rules, scd
from ..operators import enriched_delta as delta
from ..operators.enrich import BLACKLISTED
from ..session import scratch_scope, together, written
from ..sources import files
from .buckets import BUCKET_ROWS, shared_digests, write_version
from .store import REPORT_DATE, Store, day_of_label, label_of_day

LOOKBACK = "state_lookback"
MEMBERS = "_members/dwh_fact_transactions"
PART, PATCHED, PATCH = "enriched_part", "enriched_patched_ids", "enriched_patch"
ENRICHED = ("trans_id string, trans_date timestamp_ntz, amt decimal(18,2), oper_result string, passport_valid_to date, "
            "passport_num string, fio string, phone string, terminal_city string, account_num string, valid_to date, "
            f"client_id string, {BLACKLISTED} boolean")
COMPACT_DAYS = 32
_MEMBERS = "day date, blocks long, block long, w0 long, w1 long, w2 long, w3 long"


@dataclass
class DailyInputs:
    """The day's staged inputs (see ``sources``)."""
    transactions: DataFrame
    terminals: DataFrame
    blacklist: DataFrame
    clients: DataFrame
    accounts: DataFrame
    cards: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"transactions": self.transactions, "terminals": self.terminals,
                "blacklist": self.blacklist, "clients": self.clients,
                "accounts": self.accounts, "cards": self.cards}


def inputs_from_drop(spark: SparkSession, drop_dir: str, label: str,
                     clients: DataFrame, accounts: DataFrame, cards: DataFrame,
                     sheet_format: str = "csv") -> DailyInputs:
    """Stage the three daily files of ``label`` from ``drop_dir`` together
    with the source snapshots (already read, e.g. by
    ``sources.tables.read_source_table``)."""
    from ..sources import tables
    p = files.daily_paths(drop_dir, label, sheet_format)
    return DailyInputs(
        transactions=files.read_transactions_file(spark, p["transactions"]),
        terminals=files.read_terminals_file(spark, p["terminals"], sheet_format),
        blacklist=files.read_blacklist_file(spark, p["blacklist"], sheet_format),
        clients=tables.stage_clients(clients),
        accounts=tables.stage_accounts(accounts),
        cards=tables.stage_cards(cards),
    )


def next_batch_label(store: Store) -> str:
    """The label of the batch to load next (the seed label before the
    first run)."""
    return store.next_label() or sch.BATCH_LABEL_SEED


class QualityError(RuntimeError):
    pass


class BatchOrderError(RuntimeError):
    pass


def _check(store: Store, day: _dt.date, attempt: str, inputs: DailyInputs, on_violation: str) -> dict[str, DataFrame]:
    """Run the key, reference and parse checks over the staged inputs; the tables to load.

    ``quarantine`` writes the findings to ``_violations``, sets the rows that break a key or
    did not parse aside in ``_quarantine/<table>`` and loads the rest; ``report`` writes the
    findings and loads every row; ``fail`` raises on any finding; ``ignore`` skips the checks.
    """
    if on_violation not in ("quarantine", "fail", "report", "ignore"):
        raise ValueError("on_violation must be 'quarantine', 'fail', 'report' or 'ignore'")
    tables = inputs.as_dict()
    if on_violation == "ignore":
        return tables
    repeated = dict(zip(quality.PRIMARY_KEYS, together(*[
        lambda n=n, k=k: quality.repeated_keys(tables[n], k, quality.REQUIRED.get(n, [])) for n, k in quality.PRIMARY_KEYS.items()])))
    found = quality.violations(tables, repeated)
    if on_violation == "fail":
        if found.limit(1).count():
            raise QualityError(f"data-quality violations in batch {day}")
        return tables
    if on_violation == "report":
        store.write("_violations", day, attempt, found)
        return tables

    def sort_out(name: str, keys: list[str]) -> None:
        good, bad = quality.set_aside(tables[name], keys, quality.REQUIRED.get(name, []), repeated[name])
        store.write(f"_quarantine/{name}", day, attempt, bad)
        if store.read(f"_quarantine/{name}", bad.schema, day, attempt).limit(1).count():
            store.write(f"stg_{name}_valid", day, attempt, good)
            tables[name] = store.read(f"stg_{name}_valid", tables[name].schema, day, attempt)

    together(lambda: store.write("_violations", day, attempt, found),
             *[lambda n=name, k=keys: sort_out(n, k) for name, keys in quality.PRIMARY_KEYS.items()])
    return tables


def run_day(store: Store, label: str, inputs: DailyInputs, *,
            batch_ts: str | _dt.datetime | None = None,
            report_dt: str | _dt.date | None = None,
            on_violation: str = "quarantine",
            report_since: str | _dt.datetime | None = None,
            bucket_rows: int = BUCKET_ROWS,
            stream: tuple[str, int] | None = None) -> None:
    """Load batch ``label`` (``ddMMyyyy``) and publish its version.
    ``stream`` names the stream and epoch that brought it, if one did.

    The report covers the whole fact history, as the original does (every
    past hit is reported again under the new report date).  With
    ``report_since`` it covers operations from that time on, computed from
    the batches since then and the look-back state stored before them
    (``rules.fraud_report_from_state``); the history is not read.
    """
    with scratch_scope(store.spark):
        _run_day(store, label, inputs, batch_ts, report_dt, on_violation, report_since, bucket_rows, stream)


def _run_day(store: Store, label: str, inputs: DailyInputs, batch_ts, report_dt, on_violation: str, report_since,
             bucket_rows: int, stream) -> None:
    spark = store.spark
    day = day_of_label(label)
    batch_ts = str(batch_ts or _dt.datetime.now().replace(microsecond=0))
    report_dt = _dt.date.fromisoformat(str(report_dt)) if report_dt else _dt.date.today()
    commits = store.commits()  # one listing a run: what is committed does not change meanwhile
    done = list(commits)
    if done and day != done[-1] and label != commits[done[-1]][1]:
        raise BatchOrderError(f"batch {label} is out of order: the next one is {commits[done[-1]][1]}")
    before = [d for d in done if d < day]
    held = {d: a for d, (a, _) in commits.items()}
    previous = (before[-1], held[before[-1]]) if before else None
    attempt = store.new_attempt()

    # Staging is written once and read back, so every later step (and
    # any recomputation after a lost executor) sees the same snapshot even if
    # a source database moves on meanwhile.
    arrived = inputs.as_dict()
    together(*[lambda n=name, d=df: store.write(f"stg_{n}", day, attempt, d) for name, df in arrived.items()])
    staged = {name: store.read(f"stg_{name}", df.schema, day, attempt) for name, df in arrived.items()}
    staged = _check(store, day, attempt, DailyInputs(**staged), on_violation)

    # SCD1 dimensions and SCD2 history, one version each: the buckets that the snapshot changes.
    shown = F.col("effective_to").isNull() & ~F.col("deleted")

    snapshots = {d: staged[d].select(sch.dim_key(d), *sch.dim_attrs(d)) for d in sch.DIMENSIONS}
    seen = {d: shared_digests(snapshots[d], sch.dim_key(d), sch.dim_attrs(d)) for d in sch.DIMENSIONS}

    def version(d: str, history: bool) -> None:
        key, attrs = sch.dim_key(d), sch.dim_attrs(d)
        table, schema, apply = ((sch.HIST_TABLES[d], sch.HIST[d], scd.scd2_apply) if history
                                else (sch.DIM_TABLES[d], sch.DIM[d], scd.scd1_apply))
        write_version(store, table, schema, day, attempt, previous, snapshots[d], key, attrs,
                      lambda old, new: apply(old, new, key, attrs, batch_ts), shown if history else None, bucket_rows, seen[d])

    # Facts: only rows not stored before.
    tx_fact, bl_fact = "dwh_fact_transactions", "dwh_fact_blacklist"
    own = (day, attempt)

    def transactions() -> None:
        # Only the batches whose filter may hold one of today's ids are read.
        filters = store.read_days(MEMBERS, _MEMBERS, before, attempts=held)
        new = facts.new_transactions_by_filter(staged["transactions"], filters, "day", lambda days: store.read_days(
            tx_fact, sch.FACT_TRANSACTIONS, days, attempts=held))
        if before:
            # the ranges look at their input twice: the join runs once
            new = written(new, "new-facts")
        # Files by event time, so that the zone map tells them apart, and sorted by id inside each file: tight
        # row-group statistics for the check of ids in question.
        store.write(tx_fact, day, attempt, new.repartitionByRange("trans_date").sortWithinPartitions("trans_id"))
        stored = store.read(tx_fact, sch.FACT_TRANSACTIONS, day, attempt)
        state = (store.read(LOOKBACK, sch.FACT_TRANSACTIONS, *previous) if previous else spark.createDataFrame([], sch.FACT_TRANSACTIONS))
        together(lambda: store.write_zones(tx_fact, day, attempt, "trans_date"),
                 lambda: store.write(MEMBERS, day, attempt, membership.build(stored, "trans_id").select(F.lit(day).alias("day"), "*")),
                 lambda: store.write(LOOKBACK, day, attempt, lookback.merge_state(state, stored)))

    def blacklist() -> None:
        old_bl = store.read_days(bl_fact, sch.FACT_BLACKLIST, before, attempts=held)
        store.write(bl_fact, day, attempt, facts.new_blacklist_entries(staged["blacklist"], old_bl))

    together(transactions, blacklist, *[lambda d=d, h=h: version(d, h) for d in sch.DIMENSIONS for h in (False, True)])
    dims = {d: store.read(sch.DIM_TABLES[d], sch.DIM[d], day, attempt) for d in sch.DIMENSIONS}
    new_tx = store.read(tx_fact, sch.FACT_TRANSACTIONS, day, attempt)

    all_bl = store.read_days(bl_fact, sch.FACT_BLACKLIST, before, own, held)
    now = {**dims, "blacklist": all_bl}

    def add_part() -> None:
        store.write(PART, day, attempt, delta.part(new_tx, now))

    def add_patch() -> None:
        if previous:
            then = {d: store.read(sch.DIM_TABLES[d], sch.DIM[d], *previous) for d in sch.DIMENSIONS}
            then["blacklist"] = store.read_days(bl_fact, sch.FACT_BLACKLIST, before, attempts=held)
            ids, rows = delta.patch(store.read_days(tx_fact, sch.FACT_TRANSACTIONS, before, attempts=held), then, now)
        else:
            ids, rows = spark.createDataFrame([], "trans_id string"), spark.createDataFrame([], ENRICHED)
        together(lambda: store.write(PATCHED, day, attempt, ids.withColumn("v", F.lit(day))),
                 lambda: store.write(PATCH, day, attempt, rows.withColumn("v", F.lit(day))))

    def stored_checks() -> None:
        # K2, K5 on what is stored: keys of the dimensions and of today's facts, and all four
        # references; deleting a parent leaves its children behind (Q11), they are reported.
        stored = quality.check_all({**dims, "transactions": new_tx}, ("orphans", "duplicate_keys"))
        together(lambda: store.write("_dwh_orphans", day, attempt, stored["orphans"]),
                 lambda: store.write("_dwh_duplicate_keys", day, attempt, stored["duplicate_keys"]))

    def metadata() -> None:
        m = (store.read("meta_dwh", sch.META, *previous) if previous else meta.seed(spark))
        m = meta.stamp_load_time(m, sch.FACT_TABLES, batch_ts)
        m = meta.high_water_marks(m, {sch.DIM_TABLES[d]: dims[d] for d in sch.DIMENSIONS})
        m = meta.stamp_load_time(m, list(sch.HIST_TABLES.values()), batch_ts)
        store.write("meta_dwh", day, attempt, m)

    def report_fraud() -> None:
        if previous:
            now.update(delta.profiled(now))
        if report_since is None:
            # The whole fact history, as the rules expect: the maintained enriched table.
            together(add_part, add_patch)
            # without a patch it is a plain scan
            report = rules.fraud_report(read_enriched(store, before, own, held), report_dt, None, not previous)
        else:
            state, late, recent = window_facts(store, before, own, held, report_since)
            report = rules.fraud_report_from_state(state, late, recent, dims["cards"], dims["terminals"], dims["accounts"],
                                                   dims["clients"], all_bl, report_since, report_dt)
            together(add_part, add_patch)
        # A batch appends its own rows, also where another batch has the same report date.
        store.write("rep_fraud", day, attempt, report.select(*sch.REPORT.names))

    together(report_fraud, metadata, *([] if on_violation == "ignore" else [stored_checks]))
    store.commit(day, attempt, label_of_day(day + _dt.timedelta(days=1)), stream)
    if (len(before) + 1) % COMPACT_DAYS == 0:
        # what later runs read of every day is merged, so that they open few folders
        together(*[lambda t=t, x=x: store.compact(t, x, COMPACT_DAYS) for t, x in (
            (tx_fact, sch.FACT_TRANSACTIONS), (bl_fact, sch.FACT_BLACKLIST), (MEMBERS, _MEMBERS), (PART, ENRICHED),
            (PATCHED, "trans_id string, v date"), (PATCH, f"{ENRICHED}, v date"))])


def read_enriched(store: Store, days: list[_dt.date], own: tuple[_dt.date, str] | None = None,
                  attempts: dict[_dt.date, str] | None = None) -> DataFrame:
    """The enriched table (D13) after the given days, from its parts and patches."""
    of = lambda table, schema: store.read_days(table, schema, days, own, attempts)
    return delta.current(of(PART, ENRICHED), of(PATCHED, "trans_id string, v date"), of(PATCH, f"{ENRICHED}, v date"))


def window_facts(store: Store, days: list[_dt.date], own: tuple[_dt.date, str] | None, attempts: dict[_dt.date, str],
                 since: str | _dt.datetime) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(look-back state, late facts, recent facts) for a report from ``since`` on: the state after the last
    batch up to which every fact lies before the clock hour of ``since``, and the later batches' facts
    before and from that hour.  Batches and files are chosen by their zone maps; no other fact file is opened."""
    table, start = "dwh_fact_transactions", rules.window_start(since)
    zones = store.zones(table, days, own, attempts)
    reached = {r["day"] for r in zones.where(F.col("hi") >= start).select("day").distinct().collect()}
    first = next((i for i, d in enumerate(days) if d in reached), len(days))
    state = (store.read(LOOKBACK, sch.FACT_TRANSACTIONS, days[first - 1], attempts[days[first - 1]]) if first
             else store.spark.createDataFrame([], sch.FACT_TRANSACTIONS))
    after = zones.where(~F.col("day").isin(*days[:first])) if first else zones
    of = lambda **bounds: store.read_files(store.files_between(after, table, **bounds), sch.FACT_TRANSACTIONS)
    return state, of(hi=start).where(F.col("trans_date") < start), of(lo=start).where(F.col("trans_date") >= start)


def read_report(store: Store, report_dt: str | _dt.date) -> DataFrame:
    """The rows that all committed batches reported under ``report_dt``."""
    d = _dt.date.fromisoformat(str(report_dt))
    return store.read_days("rep_fraud", sch.REPORT, store.committed_days()).where(
        F.col(REPORT_DATE) == F.lit(d.isoformat()).cast("date"))
