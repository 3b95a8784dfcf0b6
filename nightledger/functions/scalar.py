"""Scalar column expressions.  All are built-in Spark expressions (no UDF),
so they stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMOUNT, BATCH_LABEL_FORMAT

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_skip_nulls(*parts: ColumnOrName) -> Column:
    """Concatenate, treating a null part as the empty string.

    Spark's ``concat`` returns null when any part is null and ``concat_ws``
    drops the separator; here only the null part disappears, separators stay.
    """
    return F.concat(*[F.coalesce(_c(p), F.lit("")) for p in parts])


def full_name(last: ColumnOrName = "last_name", first: ColumnOrName = "first_name",
              middle: ColumnOrName = "patrinymic") -> Column:
    """``last first middle`` with single spaces; a null middle name leaves a
    trailing space."""
    return concat_skip_nulls(last, F.lit(" "), first, F.lit(" "), middle)


def hour_start(ts: ColumnOrName) -> Column:
    """Clock-hour bucket of a wall-clock timestamp, kept as TIMESTAMP_NTZ;
    null stays null.

    Built from the timestamp's own fields, so it works on the wall clock
    only: ``date_trunc`` would return a zoned timestamp and shift times in a
    daylight-saving gap of the session zone, and ``window`` drops rows whose
    time is null.
    """
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def changed(a: ColumnOrName, b: ColumnOrName) -> Column:
    """True when two values differ, with null equal to null; never null."""
    return ~_c(a).eqNullSafe(_c(b))


def any_changed(left: str, right: str, attrs: list[str]) -> Column:
    """At least one attribute differs between the ``left.`` and ``right.``
    qualified columns."""
    return reduce(lambda x, y: x | y,
                  [changed(F.col(f"{left}.{a}"), F.col(f"{right}.{a}")) for a in attrs])


def all_changed(left: str, right: str, attrs: list[str]) -> Column:
    """Every attribute differs."""
    return reduce(lambda x, y: x & y,
                  [changed(F.col(f"{left}.{a}"), F.col(f"{right}.{a}")) for a in attrs])


def strip_whitespace(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace of any kind (spaces, tabs,
    newlines); ``trim`` alone removes spaces only."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def parse_decimal_comma(c: ColumnOrName) -> Column:
    """Text amount with a decimal comma (``8378,05``) to ``decimal(18,2)``.
    Text that does not parse becomes null (see quality.bad_amounts), and so
    does an amount that two decimals cannot hold: it is reported, not rounded."""
    exact = strip_whitespace(F.regexp_replace(_c(c), ",", ".")).try_cast("decimal(38,18)")
    amount = exact.try_cast(AMOUNT)
    return F.when(amount == exact, amount)


def parse_timestamp(c: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Wall-clock text to TIMESTAMP_NTZ; text that does not parse is null
    (also under ANSI mode, where ``to_timestamp_ntz`` would fail the job).

    ``try_to_timestamp`` only tests parseability: it yields a zoned value,
    which would move times inside a daylight-saving gap.
    """
    s = strip_whitespace(c)
    return F.when(F.try_to_timestamp(s, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(s, F.lit(fmt)))


def label_to_date(c: ColumnOrName) -> Column:
    """Batch label ``ddMMyyyy`` to a date (null if it is not one)."""
    return F.try_to_date(_c(c), BATCH_LABEL_FORMAT)


def date_to_label(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), BATCH_LABEL_FORMAT)


def next_label(c: ColumnOrName) -> Column:
    """``ddMMyyyy`` label of the following day."""
    return date_to_label(F.date_add(label_to_date(c), 1))


def minute_field(interval: ColumnOrName) -> Column:
    """Minute field (0-59) of a day-time interval, not its total minutes."""
    return F.extract(F.lit("MINUTE"), _c(interval)).cast("int")


def seconds_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Exact seconds between two wall-clock timestamps as ``decimal(18,6)``;
    independent of the session time zone."""
    micros = F.timestamp_diff("MICROSECOND", _c(earlier), _c(later))
    return (micros.cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
