"""Copy-on-write by hash bucket: dimension and history versions.

A version of a table is a manifest: for every hash bucket of the key, the
batch and attempt whose folder holds its rows, and a digest of its live rows
(count, sum and xor of 64-bit hashes of key and attributes).  The day's
snapshot gets the same digests in one pass.  Where they agree the bucket has
no new, changed or gone key: it is neither read, compared nor written, and
the new manifest names the old folder again.  Only the other buckets are
read, put through the SCD step and written, so reads, joins and bytes written
follow the day's changes.

Buckets hold about ``bucket_rows`` rows; when a table has outgrown its
buckets, the next version is written whole with more of them.  Rows with a
null key have a bucket of their own, which is always worked out again (they
match nothing and are new every day).
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_ROWS = 100_000
NULL_BUCKET = -1
BUCKET = "_bucket"
MANIFEST = "buckets int, bucket int, day date, attempt string, n_rows long, live long, total decimal(38,0), mixed long"

Digest = tuple | None  # (live rows, sum, xor); None: no live row


@dataclass
class Manifest:
    buckets: int
    # bucket -> (day, attempt, rows, digest of the live rows)
    entries: dict[int, tuple[_dt.date, str, int, Digest]] = field(default_factory=dict)


def bucket_of(key: str, buckets: int) -> Column:
    k = F.col(key)
    return F.when(k.isNull(), NULL_BUCKET).otherwise(F.pmod(F.xxhash64(k), F.lit(buckets))).cast("int")


def _hash(columns: list[str], seed: str) -> Column:
    # xxhash64 passes over nulls: say where they are
    return F.xxhash64(F.lit(seed), *columns, *[F.col(c).isNull() for c in columns])


def digests(rows: DataFrame, key: str, attrs: list[str], buckets: int, live: Column) -> dict[int, tuple[int, Digest]]:
    """(rows, digest of the live rows) of every bucket; one row for each bucket reaches the driver."""
    cols = [key, *attrs]
    n = F.sum(live.cast("int"))
    h = F.when(live, _hash(cols, "a"))  # summed by halves, exactly: longs instead of big decimals for every row
    found = rows.groupBy(bucket_of(key, buckets).alias("b")).agg(
        F.count(F.lit(1)).alias("n_rows"), n.alias("live"),
        F.sum(F.shiftright(h, 32)).alias("high"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.bit_xor(F.when(live, _hash(cols, "b"))).alias("mixed"))
    return {r["b"]: (r["n_rows"], (r["live"], (r["high"] << 32) + r["low"], r["mixed"]) if r["live"] else None) for r in found.collect()}


def shared_digests(rows: DataFrame, key: str, attrs: list[str]) -> Callable[[int], dict[int, tuple[int, Digest]]]:
    """``digests`` of a snapshot by the number of buckets, worked out once for the tables that are compared with it."""
    lock, held = threading.Lock(), {}

    def of(buckets: int) -> dict[int, tuple[int, Digest]]:
        with lock:
            if buckets not in held:
                held[buckets] = digests(rows, key, attrs, buckets, F.lit(True))
            return held[buckets]
    return of


def read_manifest(store, table: str, day: _dt.date, attempt: str) -> Manifest:
    rows = store.spark.read.schema(MANIFEST).parquet(store.folder(f"_buckets/{table}", day, attempt)).collect()
    return Manifest(rows[0]["buckets"] if rows else 1, {
        r["bucket"]: (r["day"], r["attempt"], r["n_rows"], (r["live"], int(r["total"]), r["mixed"]) if r["live"] else None)
        for r in rows if r["bucket"] is not None})


def read_buckets(store, table: str, schema: T.StructType, manifest: Manifest, only: set[int] | None = None) -> DataFrame:
    paths = [f"{store.folder(table, day, attempt)}/{BUCKET}={b}" for b, (day, attempt, *_) in sorted(manifest.entries.items())
             if only is None or b in only]
    if not paths:
        return store.spark.createDataFrame([], schema)
    return store.spark.read.schema(schema).parquet(*paths)


def write_version(store, table: str, schema: T.StructType, day: _dt.date, attempt: str,
                  previous: tuple[_dt.date, str] | None, snapshot: DataFrame, key: str, attrs: list[str],
                  step: Callable[[DataFrame, DataFrame], DataFrame], live: Column | None = None,
                  bucket_rows: int = BUCKET_ROWS, seen_by: Callable[[int], dict[int, tuple[int, Digest]]] | None = None) -> Manifest:
    """Write the table's version after ``step(stored rows, snapshot rows)`` and its manifest.

    ``step`` must treat every key on its own; ``live`` says which stored rows
    are what the snapshot shows (all of them by default).  ``seen_by``: the snapshot's ``shared_digests``.
    """
    live = F.lit(True) if live is None else live
    old = read_manifest(store, table, *previous) if previous else None
    seen = (seen_by or shared_digests(snapshot, key, attrs))(old.buckets) if old else None
    n, wanted = sum(rows for rows, _ in seen.values()) if old else snapshot.count(), 1
    while wanted * bucket_rows < n:
        wanted *= 2
    keep = old is not None and 2 * old.buckets > wanted
    buckets = old.buckets if keep else wanted
    if keep:
        stored = {b: e[3] for b, e in old.entries.items()}
        changed = {b for b in {*seen, *stored} if b == NULL_BUCKET or stored.get(b) != (seen[b][1] if b in seen else None)}
        new = Manifest(buckets, {b: e for b, e in old.entries.items() if b not in changed})
        here = bucket_of(key, buckets).isin(*changed) if changed else F.lit(False)
        before, today = read_buckets(store, table, schema, old, changed), snapshot.where(here)
    else:
        new, changed = Manifest(buckets), None
        before = read_buckets(store, table, schema, old) if old else store.spark.createDataFrame([], schema)
        today = snapshot
    if changed is None or changed:
        rows = step(before, today).select(*schema.names).withColumn(BUCKET, bucket_of(key, buckets))
        folder = store.folder(table, day, attempt)
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
        stored_now = store.spark.read.schema(T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])).parquet(folder)
        for b, (n_rows, digest) in digests(stored_now, key, attrs, buckets, live).items():
            new.entries[b] = (day, attempt, n_rows, digest)
    # an empty table still says how many buckets it has
    listed = [(new.buckets, b, d, a, n, *(digest or (0, None, None))) for b, (d, a, n, digest) in new.entries.items()]
    store.write(f"_buckets/{table}", day, attempt, store.spark.createDataFrame(
        [(*r[:6], None if r[6] is None else _decimal(r[6]), r[7]) for r in listed] or [(new.buckets, *[None] * 7)], MANIFEST).coalesce(1))
    return new


def _decimal(v: int):
    from decimal import Decimal
    return Decimal(v)
