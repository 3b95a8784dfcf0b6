"""Registered queries: each builds one operator over the driver's tables
(through the fixture mapping) and has a DuckDB oracle in
``fixtures_sql``."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from .. import fixtures_sql as fq
from .. import schemas as sch
from ..operators import enrich as en
from ..operators import enriched_delta as delta
from ..operators import facts, lookback, membership, meta, quality, rules, scd
from ..operators.sequence import lag_name
from ..session import scratch_path, written
from ..sources import control, files, tables
from .buckets import write_version
from .daily_run import DailyInputs, read_report, run_day
from .store import Store

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def enriched(spark: SparkSession, sf_dir: str, *, with_blacklist: bool = False,
             compress_time: bool = False) -> DataFrame:
    return en.enrich(
        fx.transactions(spark, sf_dir, compress_time=compress_time),
        fx.cards(spark, sf_dir), fx.terminals(spark, sf_dir),
        fx.accounts(spark, sf_dir), fx.clients(spark, sf_dir),
        blacklist=fx.blacklist(spark, sf_dir) if with_blacklist else None)


# D13 and F1-F5 -------------------------------------------------------------------
_E = fq.enriched_ctes()
_E_FAST = fq.enriched_ctes(compress_time=True)


@register("enriched_transactions", fq.with_ctes(_E, "SELECT * FROM enriched"))
def q_enriched(spark, sf_dir):
    return enriched(spark, sf_dir)


@register("enriched_transactions_maintained", fq.with_ctes(_E, "SELECT * FROM enriched"))
def q_enriched_maintained(spark, sf_dir):
    """The same table, maintained over three batches of facts while the dimensions change before the second and
    the third: no fact of an unchanged card and terminal is joined twice."""
    fact = fx.transactions(spark, sf_dir)
    batch = F.pmod(F.xxhash64("trans_id"), F.lit(3))
    now = {"cards": fx.cards(spark, sf_dir), "terminals": fx.terminals(spark, sf_dir), "accounts": fx.accounts(spark, sf_dir),
           "clients": fx.clients(spark, sf_dir)}
    first = {**now, "terminals": now["terminals"].where("terminal_id <> 'T3'"),
             "clients": now["clients"].withColumn("phone", F.when(F.length("client_id") % 2 == 0, F.col("phone")))}
    second = {**now, "terminals": now["terminals"].withColumn("terminal_city", F.upper("terminal_city"))}
    states = [first, second, now]
    parts, ids, rows = [], [], []
    for k, dims in enumerate(states):
        parts.append(written(delta.part(fact.where(batch == k), dims), "enriched-part"))
        if k:
            i, r = delta.patch(fact.where(batch < k), states[k - 1], dims)
            ids.append(i.withColumn("v", F.lit(k)))
            rows.append(written(r.withColumn("v", F.lit(k)), "enriched-patch"))
    all_of = lambda dfs: reduce(DataFrame.unionByName, dfs)
    return delta.current(all_of(parts), all_of(ids), all_of(rows))


@register("fraud_passport", fq.with_ctes(_E, fq.F1))
def q_fraud_passport(spark, sf_dir):
    return rules.fraud_passport(enriched(spark, sf_dir, with_blacklist=True), fx.REPORT_DT)


@register("fraud_contract", fq.with_ctes(_E, fq.F2))
def q_fraud_contract(spark, sf_dir):
    return rules.fraud_contract(enriched(spark, sf_dir), fx.REPORT_DT)


@register("multi_city_hours", fq.with_ctes(_E, fq.MULTI_CITY_HOURS))
def q_multi_city_hours(spark, sf_dir):
    return rules.multi_city_hours(enriched(spark, sf_dir), with_counts=True)


@register("fraud_multi_city", fq.with_ctes(_E, fq.F3))
def q_fraud_multi_city(spark, sf_dir):
    return rules.fraud_multi_city(enriched(spark, sf_dir), fx.REPORT_DT)


_LAG_FEATURES_SQL = f"""SELECT client_id, trans_id, trans_date, CAST(rk AS INTEGER) AS rk,
  amt, amt_lag1, amt_lag2, oper_result, res_lag1 AS oper_result_lag1, res_lag2 AS oper_result_lag2,
  epoch_us(trans_date) - epoch_us(t1) AS gap1_us, epoch_us(trans_date) - epoch_us(t2) AS gap2_us
FROM ({fq.LAGS}) l"""


@register("client_lag_features", fq.with_ctes(_E, _LAG_FEATURES_SQL))
def q_client_lag_features(spark, sf_dir):
    lagged = rules.client_lags(enriched(spark, sf_dir), rank_col="rk")
    t = F.col("trans_date")
    return lagged.select(
        "client_id", "trans_id", "trans_date", "rk", "amt",
        F.col(lag_name("amt", 1)).alias("amt_lag1"), F.col(lag_name("amt", 2)).alias("amt_lag2"),
        "oper_result",
        F.col(lag_name("oper_result", 1)).alias("oper_result_lag1"),
        F.col(lag_name("oper_result", 2)).alias("oper_result_lag2"),
        F.timestamp_diff("MICROSECOND", F.col(lag_name("trans_date", 1)), t).alias("gap1_us"),
        F.timestamp_diff("MICROSECOND", F.col(lag_name("trans_date", 2)), t).alias("gap2_us"),
    )


@register("fraud_amount_probe", fq.with_ctes(_E, fq.f4()))
def q_fraud_amount_probe(spark, sf_dir):
    return rules.fraud_amount_probe(enriched(spark, sf_dir), fx.REPORT_DT)


@register("fraud_amount_probe_elapsed", fq.with_ctes(_E_FAST, fq.f4(elapsed=True)))
def q_fraud_amount_probe_elapsed(spark, sf_dir):
    return rules.fraud_amount_probe_elapsed(enriched(spark, sf_dir, compress_time=True), fx.REPORT_DT)


REPORT_SINCE = "2024-01-20 12:30:00"
REPORT_HALF = "2024-01-10 00:00:00"


@register("fraud_report_since", fq.with_ctes(_E, "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT * FROM ({q})" for q in (fq.F1, fq.F2, fq.F3, fq.f4()))
    + f") WHERE event_dt >= TIMESTAMP '{REPORT_SINCE}'"))
def q_fraud_report_since(spark, sf_dir):
    return rules.fraud_report_since(
        fx.transactions(spark, sf_dir), fx.cards(spark, sf_dir), fx.terminals(spark, sf_dir),
        fx.accounts(spark, sf_dir), fx.clients(spark, sf_dir), fx.blacklist(spark, sf_dir),
        REPORT_SINCE, fx.REPORT_DT)


@register("fraud_report_from_state", ORACLES["fraud_report_since"])
def q_fraud_report_from_state(spark, sf_dir):
    """The same report from a look-back state that three batches maintain: the state is merged by two batches
    of old facts, the third brings the recent facts and late ones."""
    fact, start = fx.transactions(spark, sf_dir), rules.window_start(REPORT_SINCE)
    late = F.col("trans_id").cast("long") % 13 == 5
    older = fact.where((F.col("trans_date") < start) & ~late)
    half = F.col("trans_date") < F.lit(REPORT_HALF).cast("timestamp_ntz")
    state = written(lookback.merge_state(spark.createDataFrame([], sch.FACT_TRANSACTIONS), older.where(half)), "lookback")
    state = written(lookback.merge_state(state, older.where(~half)), "lookback")
    return rules.fraud_report_from_state(
        state, fact.where((F.col("trans_date") < start) & late), fact.where(F.col("trans_date") >= start),
        fx.cards(spark, sf_dir), fx.terminals(spark, sf_dir), fx.accounts(spark, sf_dir),
        fx.clients(spark, sf_dir), fx.blacklist(spark, sf_dir), REPORT_SINCE, fx.REPORT_DT)


@register("fraud_report", fq.with_ctes(_E, "\nUNION ALL\n".join(
    f"SELECT * FROM ({q})" for q in (fq.F1, fq.F2, fq.F3, fq.f4()))))
def q_fraud_report(spark, sf_dir):
    return rules.fraud_report(enriched(spark, sf_dir, with_blacklist=True), fx.REPORT_DT)


# D1-D7 ----------------------------------------------------------------------------------


def _scd1_query(dim: str, what: str, change: str = "any") -> QueryFn:
    key, attrs = sch.dim_key(dim), sch.dim_attrs(dim)

    def q(spark, sf_dir):
        stored = fx.stored_dimension(spark, sf_dir, dim)
        snap = fx.todays_snapshot(spark, sf_dir, dim)
        if what == "insert":
            return scd.scd1_insert(stored, snap, key, attrs, fx.BATCH_TS)
        if what == "update":
            return scd.scd1_update(stored, snap, key, attrs, fx.BATCH_TS, change)
        if what == "delete":
            return scd.scd1_delete(stored, snap, key, attrs)
        return scd.scd1_apply(stored, snap, key, attrs, fx.BATCH_TS, change)
    q.__name__ = f"scd1_{what}_{dim}"
    return q


def _scd2_query(dim: str, what: str) -> QueryFn:
    key, attrs = sch.dim_key(dim), sch.dim_attrs(dim)
    op = {"insert": scd.scd2_insert, "close": scd.scd2_close, "open": scd.scd2_open,
          "mark_deleted": scd.scd2_mark_deleted, "apply": scd.scd2_apply}[what]

    def q(spark, sf_dir):
        return op(fx.stored_history(spark, sf_dir, dim), fx.todays_snapshot(spark, sf_dir, dim),
                  key, attrs, fx.BATCH_TS)
    q.__name__ = f"scd2_{what}_{dim}"
    return q


for _dim in sch.DIMENSIONS:
    for _what in ("insert", "update", "delete", "apply"):
        register(f"scd1_{_what}_{_dim}", fq.scd1_sql(_dim, _what))(_scd1_query(_dim, _what))
    for _what in ("insert", "close", "open", "mark_deleted", "apply"):
        register(f"scd2_{_what}_{_dim}", fq.scd2_sql(_dim, _what))(_scd2_query(_dim, _what))
register("scd1_update_accounts_allchanged", fq.scd1_sql("accounts", "update", all_changed=True))(
    _scd1_query("accounts", "update", change="all"))


VERSION_ROWS = 500  # rows of a bucket: the test tables too have several


def _versions_query(dim: str, history: bool) -> QueryFn:
    """The second of two copy-on-write versions of a table (see ``buckets``)."""
    key, attrs = sch.dim_key(dim), sch.dim_attrs(dim)
    table, schema = (sch.HIST_TABLES, sch.HIST) if history else (sch.DIM_TABLES, sch.DIM)
    days = [_dt.date(2024, 2, 1), _dt.date(2024, 2, 2)]

    def q(spark, sf_dir):
        store = Store(spark, scratch_path(spark, "warehouse"))
        stored = (fx.stored_history if history else fx.stored_dimension)(spark, sf_dir, dim)
        apply = scd.scd2_apply if history else scd.scd1_apply
        live = (F.col("effective_to").isNull() & ~F.col("deleted")) if history else None
        attempts = [store.new_attempt(), store.new_attempt()]
        write_version(store, table[dim], schema[dim], days[0], attempts[0], None, stored.where(live) if history else stored,
                      key, attrs, lambda old, new: stored, live, VERSION_ROWS)
        write_version(store, table[dim], schema[dim], days[1], attempts[1], (days[0], attempts[0]),
                      fx.todays_snapshot(spark, sf_dir, dim).select(key, *attrs), key, attrs,
                      lambda old, new: apply(old, new, key, attrs, fx.BATCH_TS), live, VERSION_ROWS)
        return store.read(table[dim], schema[dim], days[1], attempts[1])
    q.__name__ = f"{'hist' if history else 'dim'}_version_{dim}"
    return q


for _dim in ("clients", "cards"):
    register(f"dim_version_{_dim}", fq.scd1_sql(_dim, "apply"))(_versions_query(_dim, False))
    register(f"hist_version_{_dim}", fq.scd2_sql(_dim, "apply"))(_versions_query(_dim, True))


# Staging --------------------------------------------------------------------------

_BASE = fq.base_ctes()


def drop_file(spark: SparkSession, df: DataFrame, name: str, sep: str = ";") -> str:
    """Write ``df`` as a header-row text file under the shared scratch
    folder, the way the daily files arrive; returns its path."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


@register("stage_transactions", fq.with_ctes(_BASE, fq.STAGE["stage_transactions"]))
def q_stage_transactions(spark, sf_dir):
    path = drop_file(spark, fx.transactions_text(spark, sf_dir), "transactions_file")
    return files.read_transactions_file(spark, path)


@register("stage_terminals", fq.with_ctes(_BASE, fq.STAGE["stage_terminals"]))
def q_stage_terminals(spark, sf_dir):
    path = drop_file(spark, fx.terminals_sheet(spark, sf_dir), "terminals_file")
    return files.read_terminals_file(spark, path)


@register("stage_blacklist", fq.with_ctes(_BASE, fq.STAGE["stage_blacklist"]))
def q_stage_blacklist(spark, sf_dir):
    path = drop_file(spark, fx.blacklist_sheet(spark, sf_dir), "blacklist_file")
    return files.read_blacklist_file(spark, path)


@register("stage_clients", fq.with_ctes(_BASE, fq.STAGE["stage_clients"]))
def q_stage_clients(spark, sf_dir):
    return tables.stage_clients(fx.clients(spark, sf_dir))


@register("stage_accounts", fq.with_ctes(_BASE, fq.STAGE["stage_accounts"]))
def q_stage_accounts(spark, sf_dir):
    return tables.stage_accounts(fx.source_accounts(spark, sf_dir))


@register("stage_cards", fq.with_ctes(_BASE, fq.STAGE["stage_cards"]))
def q_stage_cards(spark, sf_dir):
    return tables.stage_cards(fx.source_cards(spark, sf_dir))


# D8-D12, S1/S13 ----------------------------------------------------------------------------
@register("fact_transactions_append", fq.with_ctes(_BASE, fq.FACT_TRANSACTIONS_APPEND))
def q_fact_transactions_append(spark, sf_dir):
    return facts.new_transactions(fx.transactions(spark, sf_dir), fx.stored_transactions(spark, sf_dir))


@register("fact_transactions_append_filtered", ORACLES["fact_transactions_append"])
def q_fact_transactions_append_filtered(spark, sf_dir):
    """The same from the membership filters of five stored batches; batches without one of today's ids are not read."""
    stored = fx.stored_transactions(spark, sf_dir).withColumn("batch", (F.col("trans_id").cast("long") % 5).cast("int"))
    filters = [membership.build(stored.where(F.col("batch") == b), "trans_id").withColumn("batch", F.lit(b)) for b in range(5)]
    held = written(reduce(DataFrame.unionByName, filters), "members")
    return facts.new_transactions_by_filter(fx.transactions(spark, sf_dir), held, "batch",
                                            lambda batches: stored.where(F.col("batch").isin(batches)))


@register("fact_blacklist_append", fq.FACT_BLACKLIST_APPEND)
def q_fact_blacklist_append(spark, sf_dir):
    return facts.new_blacklist_entries(fx.incoming_blacklist(spark, sf_dir), fx.stored_blacklist(spark, sf_dir))


def _dims_after_load(spark, sf_dir) -> dict[str, DataFrame]:
    out = {}
    for d in sch.DIMENSIONS:
        key, attrs = sch.dim_key(d), sch.dim_attrs(d)
        out[sch.DIM_TABLES[d]] = scd.scd1_apply(fx.stored_dimension(spark, sf_dir, d),
                                                fx.todays_snapshot(spark, sf_dir, d), key, attrs, fx.BATCH_TS)
    return out


@register("meta_high_water", fq.meta_sql(stamp=False))
def q_meta_high_water(spark, sf_dir):
    return meta.high_water_marks(meta.seed(spark), _dims_after_load(spark, sf_dir))


@register("meta_load_stamps", fq.meta_sql(stamp=True))
def q_meta_load_stamps(spark, sf_dir):
    m = meta.high_water_marks(meta.seed(spark), _dims_after_load(spark, sf_dir))
    return meta.stamp_load_time(m, sch.FACT_TABLES + list(sch.HIST_TABLES.values()), fx.BATCH_TS)


@register("next_batch_date", fq.NEXT_BATCH_DATE)
def q_next_batch_date(spark, sf_dir):
    return control.batch_days(fx.transactions(spark, sf_dir))


# K1-K6 ---------------------------------------------------------------------------------------
def _staged(spark, sf_dir) -> dict[str, DataFrame]:
    return {"clients": fx.clients(spark, sf_dir), "accounts": fx.accounts(spark, sf_dir),
            "cards": fx.cards(spark, sf_dir), "terminals": fx.terminals(spark, sf_dir),
            "transactions": fx.transactions(spark, sf_dir)}


@register("dq_duplicate_keys", fq.with_ctes(_BASE, fq.DQ_DUPLICATE_KEYS))
def q_dq_duplicate_keys(spark, sf_dir):
    dups = quality.check_all(_staged(spark, sf_dir), ("duplicate_keys",))["duplicate_keys"]
    li = quality.duplicate_keys(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")
    return dups.unionByName(li)


@register("dq_null_keys", fq.with_ctes(_BASE, fq.DQ_NULL_KEYS))
def q_dq_null_keys(spark, sf_dir):
    return quality.check_all(_staged(spark, sf_dir), ("null_keys",))["null_keys"]


@register("dq_orphans", fq.with_ctes(fq.all_dims_ctes(), fq.DQ_ORPHANS))
def q_dq_orphans(spark, sf_dir):
    t = {d: fx.todays_snapshot(spark, sf_dir, d) for d in sch.DIMENSIONS}
    t["transactions"] = fx.transactions(spark, sf_dir)
    return quality.check_all(t, ("orphans",))["orphans"]


@register("dq_dwh_orphans", ORACLES["dq_orphans"])
def q_dq_dwh_orphans(spark, sf_dir):
    """K5 on stored tables, as a daily check keeps it: the findings of day 1 over the whole stored tables, then day 2
    from new and changed rows and from the keys gone."""
    then = {d: fx.stored_dimension(spark, sf_dir, d) for d in sch.DIMENSIONS}
    now = {d: fx.todays_snapshot(spark, sf_dir, d) for d in sch.DIMENSIONS}
    facts_then, facts_now = fx.stored_transactions(spark, sf_dir), fx.transactions(spark, sf_dir)
    found = written(quality.check_all({**then, "transactions": facts_then}, ("orphans",))["orphans"], "open-orphans")
    out = []
    for rel, child, key, fk, parent, pk in quality.FOREIGN_KEYS:
        if child == "transactions":
            new, old = facts_now.join(facts_then.select("trans_id"), "trans_id", "left_anti"), facts_then
        else:
            was = then[child].select(F.col(key).alias("_k"), F.col(fk).alias("_f"))
            same = F.col(key).eqNullSafe(F.col("_k")) & F.col(fk).eqNullSafe(F.col("_f"))
            new, old = now[child].join(was, same, "left_anti"), now[child].join(was, same, "left_semi")
        out.append(quality.orphans_after(found, new, old, key, fk, then[parent], now[parent], pk, rel, child == "transactions"))
    return reduce(DataFrame.unionByName, out)


@register("dq_dwh_duplicate_keys", fq.with_ctes({**_BASE, "dirty": fq.DIRTY_CARDS}, fq.DWH_DUPLICATE_KEYS))
def q_dq_dwh_duplicate_keys(spark, sf_dir):
    """K2 on stored tables: dimensions and facts as a run that sets nothing aside would store them, cards with repeated keys."""
    stored = {t: written(df, f"dwh-{t}") for t, df in {**_staged(spark, sf_dir), "cards": fx.dirty_cards(spark, sf_dir)}.items()}
    return quality.check_all(stored, ("duplicate_keys",))["duplicate_keys"]


@register("dq_bad_amounts", fq.DQ_BAD_AMOUNTS)
def q_dq_bad_amounts(spark, sf_dir):
    path = drop_file(spark, fx.transactions_text(spark, sf_dir), "transactions_file")
    return quality.bad_amount_summary(files.read_text_table(spark, path), "transactions")


_DIRTY = {**_BASE, "dirty": fq.DIRTY_CARDS}


@register("dq_quarantine_cards", fq.with_ctes(_DIRTY, fq.QUARANTINE_CARDS))
def q_dq_quarantine_cards(spark, sf_dir):
    """What the daily run sets aside of cards with repeated and null keys."""
    return quality.set_aside(fx.dirty_cards(spark, sf_dir), ["card_num"], [])[1]


@register("dq_key_findings_cards", fq.with_ctes(_DIRTY, fq.KEY_FINDINGS_CARDS))
def q_dq_key_findings_cards(spark, sf_dir):
    """K1 and K3 on the same cards."""
    c = quality.check_all({"cards": fx.dirty_cards(spark, sf_dir)})
    return (c["duplicate_keys"].select(F.lit("duplicate_key").alias("finding"), "key_value", "n_rows")
            .unionByName(c["null_keys"].select(F.lit("null_key").alias("finding"), F.lit(None).cast("string").alias("key_value"),
                                               F.col("n_null_keys").alias("n_rows"))))


@register("dq_bad_amounts_dirty", fq.DIRTY_AMOUNTS)
def q_dq_bad_amounts_dirty(spark, sf_dir):
    """K6 on amounts that are no number or finer than the column holds."""
    return quality.bad_amount_summary(fx.dirty_amounts(spark, sf_dir), "transactions")


# D14 ------------------------------------------------------------------------------------------
@register("daily_run_report", fq.daily_run_report_sql())
def q_daily_run_report(spark, sf_dir):
    """Two daily runs into a fresh warehouse under the scratch folder; the
    report published by the second."""
    store = Store(spark, scratch_path(spark, "warehouse"))
    run_day(store, "01022024", DailyInputs(**fx.daily_staging(spark, sf_dir, 1)),
            batch_ts="2024-02-01 09:00:00", report_dt="2024-01-31")
    run_day(store, "02022024", DailyInputs(**fx.daily_staging(spark, sf_dir, 2)),
            batch_ts=fx.BATCH_TS, report_dt=fx.REPORT_DT)
    return read_report(store, fx.REPORT_DT)


@register("daily_run_report_same_date",
          f"SELECT * FROM ({fq.daily_run_report_sql(1)}) UNION ALL SELECT * FROM ({fq.daily_run_report_sql(2)})")
def q_daily_run_report_same_date(spark, sf_dir):
    """Two batches that report under one date: both batches' rows."""
    store = Store(spark, scratch_path(spark, "warehouse"))
    for day, label in ((1, "01022024"), (2, "02022024")):
        run_day(store, label, DailyInputs(**fx.daily_staging(spark, sf_dir, day)),
                batch_ts=fx.BATCH_TS, report_dt=fx.REPORT_DT)
    return read_report(store, fx.REPORT_DT)
