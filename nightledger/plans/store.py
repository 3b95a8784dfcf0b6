"""Versioned warehouse storage on plain Parquet (S10-S12, the commit step).

Parquet tables cannot be updated in place, so a daily run is an *attempt* at
a batch and writes what it changes - of dimensions and history the changed
buckets (see ``buckets``), of facts and report the batch's own rows - to

    <root>/<table>/v=<batch day>/attempt=<id>/

and last a commit marker ``<root>/_commits/batch=<day>/attempt=<id>/``.  The
marker with the highest number names the attempt that counts; nothing that an
earlier marker names is ever overwritten, so a run (or a rerun) that dies half
way leaves the committed state as it was.  All reads go through the markers; a
committed folder that is missing is an error.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .. import schemas as sch
from .buckets import read_buckets, read_manifest

REPORT_DATE = "report_dt"
BUCKETED = {*sch.DIM_TABLES.values(), *sch.HIST_TABLES.values()}
_ZONES = "day date, attempt string, file string, lo timestamp_ntz, hi timestamp_ntz, n_rows long"
_MERGED = "merged string, level int, day date, attempt string"
_MARKER = "label string, number int, stream string, epoch long, batch date, attempt string"


class Unit(NamedTuple):
    """A folder and the (day, attempt) pairs whose rows it holds; level 0 is a day's own."""
    members: tuple
    folder: str
    level: int


def _no_path(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # paths -------------------------------------------------------------------
    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def folder(self, table: str, day: _dt.date, attempt: str) -> str:
        return self.path(table, f"v={day.isoformat()}", f"attempt={attempt}")

    # commits -----------------------------------------------------------------
    def commits(self) -> dict[_dt.date, tuple[str, str]]:
        """(attempt, next label) of every committed day, ascending (one small row per commit)."""
        try:
            rows = self.spark.read.schema(_MARKER).parquet(self.path("_commits")).collect()
        except AnalysisException as e:
            if not _no_path(e):
                raise
            return {}
        last = {}
        for r in sorted(rows, key=lambda r: (r["batch"], r["number"])):
            last[r["batch"]] = (r["attempt"], r["label"])
        return last

    def committed_days(self) -> list[_dt.date]:
        return list(self.commits())

    def ledger(self, stream: str) -> set[tuple[int, str]]:
        """(epoch, label) of every commit that the stream made (one small row per commit)."""
        try:
            rows = self.spark.read.schema(_MARKER).parquet(self.path("_commits")).where(F.col("stream") == stream).collect()
        except AnalysisException as e:
            if not _no_path(e):
                raise
            return set()
        return {(r["epoch"], label_of_day(r["batch"])) for r in rows}

    def commit(self, day: _dt.date, attempt: str, next_label: str, stream: tuple[str, int] | None = None) -> None:
        """Make the attempt visible; written after every table of the batch.
        The marker also keeps the next batch label (the control table) and, for a
        batch that a stream brought, the stream and its epoch."""
        try:
            number = self.spark.read.parquet(self.path("_commits", f"batch={day.isoformat()}")).count()
        except AnalysisException as e:
            if not _no_path(e):
                raise
            number = 0
        marker = self.spark.createDataFrame([(next_label, number, *(stream or (None, None)))],
                                            "label string, number int, stream string, epoch long")
        marker.coalesce(1).write.parquet(self.path("_commits", f"batch={day.isoformat()}", f"attempt={attempt}"))

    def next_label(self) -> str | None:
        found = list(self.commits().values())
        return found[-1][1] if found else None

    @staticmethod
    def new_attempt() -> str:
        return uuid.uuid4().hex

    # tables ------------------------------------------------------------------
    def write(self, table: str, day: _dt.date, attempt: str, df: DataFrame) -> None:
        df.write.parquet(self.folder(table, day, attempt))

    def read(self, table: str, schema: T.StructType, day: _dt.date | None, attempt: str | None = None) -> DataFrame:
        """One day's rows, of the committed attempt unless one is given; no rows without a day."""
        if day is None:
            return self.spark.createDataFrame([], schema)
        attempt = attempt or self.commits()[day][0]
        if table in BUCKETED:
            return read_buckets(self, table, schema, read_manifest(self, table, day, attempt))
        return self.spark.read.schema(schema).parquet(self.folder(table, day, attempt))

    def read_days(self, table: str, schema: T.StructType | str, days: list[_dt.date],
                  own: tuple[_dt.date, str] | None = None, attempts: dict[_dt.date, str] | None = None) -> DataFrame:
        """The rows of several committed days, and of a running attempt ``own``; other days are never read.
        ``attempts`` are the committed ones, if the caller has them."""
        paths = self._folders(table, days, own, attempts)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _folders(self, table, days, own, attempts) -> list[str]:
        if attempts is None:
            attempts = {d: a for d, (a, _) in self.commits().items()}
        return [u.folder for u in self._units(table, days, attempts)] + ([self.folder(table, *own)] if own else [])

    # compaction --------------------------------------------------------------
    def _units(self, table: str, days: list[_dt.date], attempts: dict[_dt.date, str]) -> list[Unit]:
        """The folders that hold just the given days: merged ones where all their days are asked for and were
        merged from the attempts that count, else the days' own."""
        wanted = [(d, attempts[d]) for d in sorted(days)]
        merged: dict[tuple, list[Unit]] = {}
        for u in self._merged(table):
            merged.setdefault(u.members[0], []).append(u)
        out, at = [], 0
        while at < len(wanted):
            fits = [u for u in merged.get(wanted[at], []) if tuple(wanted[at:at + len(u.members)]) == u.members]
            unit = max(fits, key=lambda u: len(u.members), default=Unit((wanted[at],), self.folder(table, *wanted[at]), 0))
            out.append(unit)
            at += len(unit.members)
        return out

    def _merged(self, table: str) -> list[Unit]:
        try:
            rows = self.spark.read.schema(_MERGED).parquet(self.path("_merged_from", table)).collect()
        except AnalysisException as e:
            if not _no_path(e):
                raise
            return []
        by: dict[str, list] = {}
        for r in sorted(rows, key=lambda r: r["day"]):
            by.setdefault(r["merged"], []).append(r)
        return [Unit(tuple((r["day"], r["attempt"]) for r in rs), self.path("_merged", table, f"id={k}"), rs[0]["level"]) for k, rs in by.items()]

    def compact(self, table: str, schema: T.StructType | str, fan: int = 32) -> int:
        """Merge ``fan`` neighbouring folders of one level to a folder of the next, as often as there are so many, so that
        a history of n days is read from no more than fan folders a level.  The days' own folders stay (an earlier
        version may still read them); a marker written last makes a merged folder count.  Returns the merges."""
        done = 0
        while True:
            attempts = {d: a for d, (a, _) in self.commits().items()}
            units = self._units(table, list(attempts), attempts)
            runs = [units[k:k + fan] for k in range(len(units) - fan + 1) if len({u.level for u in units[k:k + fan]}) == 1]
            if not runs:
                return done
            members = [m for u in runs[0] for m in u.members]
            key = self.new_attempt()
            self.spark.read.schema(schema).parquet(*[u.folder for u in runs[0]]).write.parquet(self.path("_merged", table, f"id={key}"))
            marker = self.spark.createDataFrame([(key, runs[0][0].level + 1, d, a) for d, a in members], _MERGED)
            marker.coalesce(1).write.parquet(self.path("_merged_from", table, f"id={key}"))
            done += 1

    def expire_attempts(self) -> list[str]:
        """Delete the folders of attempts that no commit marker names: of runs that died, or were run again.
        Not beside a running batch, whose attempt is not named yet.  Returns the deleted folders."""
        kept = {(f"v={d.isoformat()}", f"attempt={a}") for d, (a, _) in self.commits().items()}
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = []
        for pattern in ("*/v=*/attempt=*", "*/*/v=*/attempt=*"):
            for f in fs.globStatus(path(self.root, pattern)) or []:
                p = f.getPath()
                if (p.getParent().getName(), p.getName()) not in kept:
                    fs.delete(p, True)
                    gone.append(p.toString())
        return gone

    # zone maps ---------------------------------------------------------------
    def write_zones(self, table: str, day: _dt.date, attempt: str, column: str) -> None:
        """The smallest and largest ``column`` of every file of a batch, beside its rows."""
        rows = self.spark.read.parquet(self.folder(table, day, attempt))
        zones = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("n_rows"))
        self.write(f"_zones/{table}", day, attempt, zones.select(
            F.lit(day).alias("day"), F.lit(attempt).alias("attempt"), "file", F.col("lo").cast("timestamp_ntz").alias("lo"),
            F.col("hi").cast("timestamp_ntz").alias("hi"), "n_rows").coalesce(1))

    def zones(self, table: str, days: list[_dt.date], own: tuple[_dt.date, str] | None = None,
              attempts: dict[_dt.date, str] | None = None) -> DataFrame:
        return self.read_days(f"_zones/{table}", _ZONES, days, own, attempts)

    def files_between(self, zones: DataFrame, table: str, lo=None, hi=None) -> list[str]:
        """The files that may hold values in [lo, hi): chosen before anything of the table is scanned."""
        meets = F.col("lo").isNotNull()
        if lo is not None:
            meets = meets & (F.col("hi") >= lo)
        if hi is not None:
            meets = meets & (F.col("lo") < hi)
        return [f"{self.folder(table, r['day'], r['attempt'])}/{r['file']}" for r in zones.where(meets).select("day", "attempt", "file").collect()]

    def read_files(self, files: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)


def day_of_label(label: str) -> _dt.date:
    return _dt.datetime.strptime(label, "%d%m%Y").date()


def label_of_day(day: _dt.date) -> str:
    return day.strftime("%d%m%Y")
