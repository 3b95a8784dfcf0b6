"""The fraud rules over the enriched transaction table.

Every rule is a pure function of the DataFrames passed in and of
``report_dt``; run over the full fact history (as the original job does) or
over a batch window, as the caller chooses.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as sch
from ..functions import hour_start, minute_field
from ..session import written
from .enrich import BLACKLISTED, blacklisted_passports, enrich
from .lookback import newest_two
from .sequence import PART, lag_name, ordered_lags, ordered_ranges, range_lags, spanning

DateLike = str | _dt.date


def _report(rows: DataFrame, event_type: str, report_dt: DateLike) -> DataFrame:
    return rows.select(
        F.col("trans_date").alias("event_dt"),
        F.col("passport_num").alias("passport"),
        "fio", "phone",
        F.lit(event_type).alias("event_type"),
        F.lit(str(report_dt)).cast("date").alias("report_dt"),
    )


def _with_blacklist_flag(enriched: DataFrame, blacklist: DataFrame | None) -> DataFrame:
    """The enriched rows with ``passport_blacklisted``: kept if ``enrich``
    already attached it (on the client dimension, the cheap place), else
    joined here from ``blacklist``."""
    if blacklist is None:
        if BLACKLISTED not in enriched.columns:
            raise ValueError("pass the blacklist, or enrich with it")
        return enriched
    return (enriched.drop(BLACKLISTED)
            .join(blacklisted_passports(blacklist), "passport_num", "left")
            .withColumn(BLACKLISTED, F.coalesce(F.col(BLACKLISTED), F.lit(False))))


def fraud_passport(enriched: DataFrame, report_dt: DateLike,
                   blacklist: DataFrame | None = None) -> DataFrame:
    """passport expired before the operation, or blacklisted.

    The expiry date compares as midnight: an operation on the expiry day
    after 00:00:00 counts as expired.  The blacklist has no date test.  One
    row per transaction, however often the passport is listed.  If the
    enriched table already carries ``passport_blacklisted`` (see
    ``enrich(..., blacklist=)``) no further join is needed.
    """
    rows = _with_blacklist_flag(enriched, blacklist)
    hit = (F.col("passport_valid_to") < F.col("trans_date")) | F.col(BLACKLISTED)
    return _report(rows.where(hit), sch.EVENT_PASSPORT, report_dt)


def fraud_contract(enriched: DataFrame, report_dt: DateLike) -> DataFrame:
    """the account's contract ended before the operation."""
    return _report(enriched.where(F.col("valid_to") < F.col("trans_date")),
                   sch.EVENT_CONTRACT, report_dt)


def multi_city_hours(enriched: DataFrame, with_counts: bool = False) -> DataFrame:
    """(client, clock hour) groups with operations in more than one city.

    Null cities are ignored.  ``with_counts`` adds the number of distinct
    cities, as the size of the set of cities (one pre-aggregated pass; the
    set is bounded by the number of cities, not of rows, where a distinct
    count would take two shuffles); without it the test is
    ``min(city) <> max(city)``, the same predicate in one pass.
    """
    g = enriched.groupBy("client_id", hour_start("trans_date").alias("hour"))
    if with_counts:
        return (g.agg(F.size(F.collect_set("terminal_city")).cast("bigint").alias("n_cities"))
                 .where(F.col("n_cities") > 1))
    return (g.agg(F.min("terminal_city").alias("_lo"), F.max("terminal_city").alias("_hi"))
             .where(F.col("_lo") != F.col("_hi")).select("client_id", "hour"))


def fraud_multi_city(enriched: DataFrame, report_dt: DateLike) -> DataFrame:
    """every operation of a client in a clock hour in which the client
    used terminals in different cities; duplicate report rows removed."""
    groups = multi_city_hours(enriched)
    rows = (enriched.withColumn("hour", hour_start("trans_date"))
            .join(groups, ["client_id", "hour"], "left_semi"))
    return _report(rows, sch.EVENT_MULTI_CITY, report_dt).distinct()


LAG_ORDER = ["trans_date", "trans_id"]
LAG_VALUES = ["amt", "oper_result"]


def client_lags(enriched: DataFrame, extra: list[str] | None = None,
                rank_col: str | None = None) -> DataFrame:
    """Per client, ordered by (trans_date, trans_id): the previous two
    operations' time, amount and result."""
    cols = ["client_id", *LAG_ORDER, *LAG_VALUES, *(extra or [])]
    return ordered_lags(enriched.select(*dict.fromkeys(cols)), key=["client_id"],
                        order=LAG_ORDER, values=LAG_VALUES, n=2, rank_col=rank_col)


def _probe_pattern() -> Column:
    r = F.col
    return ((r(lag_name("oper_result", 2)) == sch.OPER_REJECT)
            & (r(lag_name("oper_result", 1)) == sch.OPER_REJECT)
            & (r("oper_result") == sch.OPER_SUCCESS)
            & (r(lag_name("amt", 2)) > r(lag_name("amt", 1)))
            & (r(lag_name("amt", 1)) > r("amt")))


def probe_gap_as_written() -> Column:
    """The time test as the original states it: the *minute field* of
    (t - t1) + (t - t2) is at most 20.  Hours are ignored, and the last gap
    counts twice: 2h05m passes, 25m fails."""
    t = F.col("trans_date")
    gap = (t - F.col(lag_name("trans_date", 1))) + (t - F.col(lag_name("trans_date", 2)))
    return minute_field(gap) <= 20


def probe_gap_elapsed(minutes: int = 20) -> Column:
    """Variant: the three operations lie within ``minutes`` of each other."""
    t = F.col("trans_date")
    return (t - F.col(lag_name("trans_date", 2))) <= F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def fraud_amount_probe(enriched: DataFrame, report_dt: DateLike,
                       gap: Column | None = None) -> DataFrame:
    """two rejected operations with falling amounts followed by a
    successful one with a still lower amount, close in time.

    Reported: the successful operation, and (as the original's join back on
    client and timestamp does) every operation of that client with exactly
    the same timestamp, once per hit at that timestamp.
    """
    gap = probe_gap_as_written() if gap is None else gap
    lagged = client_lags(enriched, extra=["passport_num", "fio", "phone"])
    rows = written(lagged.select("client_id", "trans_date", "passport_num", "fio", "phone", (_probe_pattern() & gap).alias("_f4")), "probe-rows")
    return _report(_probe_copies(rows), sch.EVENT_AMOUNT_PROBE, report_dt)


def _probe_copies(rows: DataFrame) -> DataFrame:
    """The rows at the client and time of a hit (``_f4``), once for each hit there.  Hits are few and written,
    so this is a join with a small table; a third of all rows at one instant is a skewed join, not one group."""
    hits = written(rows.where("_f4").groupBy("client_id", "trans_date").agg(F.count(F.lit(1)).cast("int").alias("_hits")), "probe-hits")
    return (rows.join(hits, ["client_id", "trans_date"])
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_hits")))))


def fraud_amount_probe_elapsed(enriched: DataFrame, report_dt: DateLike,
                               minutes: int = 20) -> DataFrame:
    return fraud_amount_probe(enriched, report_dt, gap=probe_gap_elapsed(minutes))


def fraud_report_by_rule(enriched: DataFrame, report_dt: DateLike,
                         blacklist: DataFrame | None = None) -> DataFrame:
    """F5 as four separate rule queries appended; the reference form of
    ``fraud_report`` (each branch plans its own pass over ``enriched``)."""
    return (fraud_passport(enriched, report_dt, blacklist)
            .unionByName(fraud_contract(enriched, report_dt))
            .unionByName(fraud_multi_city(enriched, report_dt))
            .unionByName(fraud_amount_probe(enriched, report_dt)))


def fraud_report(enriched: DataFrame, report_dt: DateLike,
                 blacklist: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """all four rules, appended (duplicates across rules are kept).

    The enriched rows are range-sorted once by (client, time, id); within the
    ranges F4 looks back over rows and F3 takes the extreme cities of each
    clock hour, and the few hours that reach over the edge of a range are
    summed up on their own.  The flagged rows are written; F1 and F2 are
    filters on them, F4 joins its hits back, and only the F3 rows go through
    a ``distinct``.  Same rows as ``fraud_report_by_rule``.  ``stored``: the
    enriched rows are a plain scan.
    """
    enriched = _with_blacklist_flag(enriched, blacklist)
    t = F.col("trans_date")
    # rows without a time stand last, in an hour of their own
    key, hour = ["client_id"], F.coalesce(hour_start("trans_date"), F.lit("9999-12-31 23:59:59").cast("timestamp_ntz"))
    ranged = ordered_ranges(enriched.select(
        *key, *LAG_ORDER, *LAG_VALUES, "passport_num", "fio", "phone", "terminal_city",
        ((F.col("passport_valid_to") < t) | F.col(BLACKLISTED)).alias("_f1"), (F.col("valid_to") < t).alias("_f2")),
        key, LAG_ORDER, stored).withColumn("hour", hour)
    lagged = range_lags(ranged, key, LAG_ORDER, LAG_VALUES, groups=["hour"])
    over = F.broadcast(spanning(ranged, {"client_id": F.col("client_id"), "hour": F.col("hour")}))  # at most one for each range
    whole = written(ranged.join(over, ["client_id", "hour"]).groupBy("client_id", "hour")
                    .agg(F.min("terminal_city").alias("_lo"), F.max("terminal_city").alias("_hi")), "hours-over-ranges")
    here = Window.partitionBy(*key, PART, "hour")
    cities = (lagged.withColumn("_low", F.min("terminal_city").over(here)).withColumn("_high", F.max("terminal_city").over(here))
              .join(whole, ["client_id", "hour"], "left"))
    flagged = written(cities.select(
        "client_id", "trans_date", "passport_num", "fio", "phone", "_f1", "_f2",
        # a null time has no clock hour; the original's join on it never matches
        ((F.least("_low", "_lo") != F.greatest("_high", "_hi")) & t.isNotNull()).alias("_f3"),
        (_probe_pattern() & probe_gap_as_written()).alias("_f4")), "flagged-rows")
    simple = F.filter(F.array(F.when(F.col("_f1"), F.lit(sch.EVENT_PASSPORT)), F.when(F.col("_f2"), F.lit(sch.EVENT_CONTRACT))),
                      lambda e: e.isNotNull())
    first = flagged.where("_f1 or _f2").withColumn("_event", F.explode(simple))
    report = first.select(F.col("trans_date").alias("event_dt"), F.col("passport_num").alias("passport"), "fio", "phone",
                          F.col("_event").alias("event_type"), F.lit(str(report_dt)).cast("date").alias("report_dt"))
    return (report.unionByName(_report(flagged.where("_f3"), sch.EVENT_MULTI_CITY, report_dt).distinct())
            .unionByName(_report(_probe_copies(flagged), sch.EVENT_AMOUNT_PROBE, report_dt)))


def fraud_report_since(fact: DataFrame, cards: DataFrame, terminals: DataFrame,
                       accounts: DataFrame, clients: DataFrame, blacklist: DataFrame,
                       since, report_dt: DateLike) -> DataFrame:
    """F5 restricted to operations at or after ``since``: exactly the rows of
    the full report with ``event_dt >= since``, without pushing the whole
    history through the enrichment and the look-back.

    * F1, F2 need only the rows themselves; F3 needs whole clock hours, so
      the window starts at the clock hour of ``since``.
    * F4 needs each client's two operations before the window.  The last
      two operations of a client are among the last two of each of its
      cards, so history contributes only a top-2 per card (limited in each
      task before its shuffle), taken over rows that survive the terminal
      join, and enriched like the window rows.

    This form scans the history for the look-back; ``fraud_report_from_state``
    has it at hand.
    """
    start = window_start(since)
    return _report_window(fact.where(F.col("trans_date") >= start), fact.where(F.col("trans_date") < start),
                          cards, terminals, accounts, clients, blacklist, since, report_dt)


def window_start(since) -> Column:
    return hour_start(F.lit(str(since)).cast("timestamp_ntz"))


def fraud_report_from_state(state: DataFrame, late: DataFrame, recent: DataFrame, cards: DataFrame, terminals: DataFrame,
                            accounts: DataFrame, clients: DataFrame, blacklist: DataFrame,
                            since, report_dt: DateLike) -> DataFrame:
    """``fraud_report_since`` from a look-back state (``lookback.merge_state``) and the facts loaded after
    it was taken: ``late`` ones before the clock hour of ``since`` and ``recent`` ones from it on.  All facts
    that the state covers must lie before that hour."""
    return _report_window(recent, state.unionByName(late.select(*state.columns)),
                          cards, terminals, accounts, clients, blacklist, since, report_dt)


def _report_window(recent: DataFrame, older: DataFrame, cards: DataFrame, terminals: DataFrame, accounts: DataFrame,
                   clients: DataFrame, blacklist: DataFrame, since, report_dt: DateLike) -> DataFrame:
    known_terminal = terminals.select(F.col("terminal_id").alias("terminal"))
    lookback = newest_two(older.join(known_terminal, "terminal", "left_semi"), ["card_num"])
    rows = enrich(recent.unionByName(lookback.select(*recent.columns)), cards, terminals, accounts, clients, blacklist=blacklist)
    return fraud_report(rows, report_dt).where(F.col("event_dt") >= F.lit(str(since)).cast("timestamp_ntz"))
