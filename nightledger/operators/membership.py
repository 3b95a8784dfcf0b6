"""Membership filters of committed batches: which batches may hold an id.

A blocked Bloom filter as rows.  The hash of an id picks a block and
``BITS`` bits of its four 64-bit words; a batch's filter is one row for each
block, the words or-ed over the batch's ids (a partial aggregate).  An id
whose bits are not all set is surely not in the batch.  At ``BITS_PER_ID``
about one foreign id in a million passes, so of a history with random ids
only the batches that really hold one of today's ids, and next to no others,
are opened for the exact check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ID = 40
WORDS = 4
BITS = 16  # of an id, spread evenly over the words
_BLOCK_BITS = 64 * WORDS


def _words(column: str) -> list[Column]:
    """The words of one id's bits, six bits of a hash for each."""
    per_word = BITS // WORDS
    out = []
    for w in range(WORDS):
        h = F.xxhash64(F.lit(w), F.col(column))
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * b).bitwiseAND(F.lit(63)).cast("int"))
                for b in range(per_word)]
        out.append(reduce(lambda x, y: x.bitwiseOR(y), bits))
    return out


def blocks_for(n_ids: int) -> int:
    """A power of two, so that the batches' filters have few different sizes."""
    blocks = 1
    while blocks * _BLOCK_BITS < n_ids * BITS_PER_ID:
        blocks *= 2
    return blocks


def _block(column: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), F.col(column)), blocks)


def build(ids: DataFrame, column: str) -> DataFrame:
    """The filter of a batch's ids: ``blocks``, ``block``, ``w0`` to ``w3``."""
    ids = ids.select(column).where(F.col(column).isNotNull())
    blocks = F.lit(blocks_for(ids.count())).cast("long")
    return (ids.select(_block(column, blocks).alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(_words(column))])
            .groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
            .select(blocks.alias("blocks"), "block", *[f"w{i}" for i in range(WORDS)]))


def may_hold(ids: DataFrame, column: str, filters: DataFrame) -> DataFrame:
    """``column`` and the other columns of ``filters`` (which batch it is) for every id and batch
    that may hold it.  The filters' sizes are few (powers of two)."""
    sizes = [r["blocks"] for r in filters.select("blocks").distinct().collect()]
    batch = [c for c in filters.columns if c not in ("blocks", "block", *[f"w{i}" for i in range(WORDS)])]
    if not sizes:
        # no batch yet: the ids are not looked at
        return ids.select(column).limit(0).join(filters.select(*batch))
    ids = ids.select(column).where(F.col(column).isNotNull()).distinct()
    probes = ids.select(column, F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("blocks"))
    probes = probes.select(column, "blocks", _block(column, F.greatest("blocks", F.lit(1))).alias("block"),
                           *[w.alias(f"m{i}") for i, w in enumerate(_words(column))])
    held = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}") for i in range(WORDS)])
    return filters.join(probes, ["blocks", "block"]).where(held).select(column, *batch)
