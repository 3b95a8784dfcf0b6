"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# A-Z to a-z; digits, letters and bytes of non-ASCII characters stay; all else becomes a space.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 bytes; null has none."""
    return text.translate(ALNUM).split() if text else []


def space_words(text: bytes | None, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes (``bytes.split`` uses just these separators)."""
    if not text:
        return []
    return text.lower().split() if lower else text.split()


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding it."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (names compare without case)."""
    used = {c.lower() for c in df.columns}
    while base.lower() in used:
        base += "_"
    return base


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read again: cuts the
    lineage so that a lost executor costs no recomputation beyond its own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Arrow batches regrouped to tables of about ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        step = max(1, int(b.num_rows * limit / max(b.nbytes, 1)))
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            held.append(part)
            size += part.nbytes
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


_BLOCK = 128


def total(numbers: Column) -> Column:
    """The sum of an array of int."""
    return F.aggregate(numbers, F.lit(0), lambda s, x: s + x)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (an array lambda over the single value)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column, levels: int, whole, join) -> Column:
    """For a lambda variable ``numbers``: what ``whole`` makes of all earlier elements, for each element.
    Elements are taken in blocks and the blocks' own values are run over in the same way, so that
    the work is a fixed number of steps for each element."""
    if levels == 0:
        return F.transform(numbers, lambda _, j: whole(F.slice(numbers, F.lit(1), j)))
    starts = F.sequence(F.lit(0), F.greatest(F.size(numbers) - 1, F.lit(0)), F.lit(_BLOCK))
    inner = lambda p: F.transform(p, lambda _, j: whole(F.slice(p, F.lit(1), j)))
    return let(F.transform(starts, lambda k: F.slice(numbers, k + 1, F.lit(_BLOCK))), lambda parts: let(
        F.transform(parts, whole), lambda of_parts: let(
            _running(of_parts, levels - 1, whole, join), lambda before: F.flatten(F.transform(
                F.arrays_zip(parts.alias("p"), before.alias("b")),
                lambda x: F.transform(inner(x["p"]), lambda v: join(x["b"], v)))))))


def running_totals(numbers: Column) -> Column:
    """For each element of an array of int the sum of all earlier ones."""
    return let(numbers, lambda a: F.when(F.size(a) > 0, _running(a, 2, total, lambda x, y: x + y))
               .otherwise(F.array().cast("array<int>")))


def running_largest(numbers: Column) -> Column:
    """For each element of an array of int the largest of all earlier ones, -1 for the first; elements are -1 or more."""
    largest = lambda a: F.coalesce(F.array_max(a), F.lit(-1))
    return let(numbers, lambda a: F.when(F.size(a) > 0, _running(a, 2, largest, lambda x, y: F.greatest(x, y)))
               .otherwise(F.array().cast("array<int>")))
