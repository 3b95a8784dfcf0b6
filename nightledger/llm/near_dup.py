"""SimHash near-duplicates by covering locality-sensitive hashing (operator 4).

Fingerprints are 64-bit SimHashes of word shingles; two fingerprints link at ``RADIUS`` or
fewer differing bits.  Every bit position i gets a nonzero vector m(i) of RADIUS + 1 bits;
table v (a nonzero vector) keeps the positions where the inner product <m(i), v> is 1.
For any RADIUS positions some v is orthogonal to all their m(i), so the table of that v
ignores all the differing bits: every pair within the radius collides in some table.

Work is done on distinct fingerprints.  In a table's bucket of two, the pair is compared.
In larger buckets no pairs are formed: a fingerprint is sent to the points at most one bit
away (only along bits that differ within the bucket).  Two fingerprints are within two
bits exactly if they share such a point, and a point has at most 65 members, so all links
of a bucket of any size follow from stars around points - exact, linear in the bucket.

Components are found by alternating large-star and small-star steps over the links
between distinct fingerprints; each step is written to the shared folder.

Defined cases: null, empty and word-less texts have fingerprint zero, which links like any
other; repeated rows each get a row; a component of only null ids has a null id; the
smallest id ignores nulls; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import byte_texts, space_words, written

SHINGLE = 3
RADIUS = 2
SEED = 42
_CHUNK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash as a signed 64-bit integer: a bit is 1 if set in over half the hashes."""
    words = space_words(text, lower=True)
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(len(words) - shingle + 1, 1)
    starts = [0, *(ends[:n - 1]).tolist()]
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = hashes[at:at + _CHUNK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fingerprint`` (signed long) of every document."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = pa.array([fingerprint(t, shingle) for t in byte_texts(b)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), f], names=["doc_id", "text_hash", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, text_hash long, fingerprint long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The 2^(radius+1) - 1 bit masks of the tables, as signed 64-bit integers."""
    vectors = 2 ** (radius + 1) - 1
    of = [i % vectors + 1 for i in range(64)]
    masks = []
    for v in range(1, vectors + 1):
        m = sum(1 << i for i in range(64) if (of[i] & v).bit_count() % 2)
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _flips(bits):
    """0 and every single bit of ``bits``, as values to xor with."""
    ones = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    return F.concat(F.array(F.lit(0).cast("long")), F.filter(ones, lambda b: b.bitwiseAND(bits) != 0))


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a < b) between distinct fingerprints that connect all pairs within ``RADIUS`` bits."""
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).cast("long").alias("mask"))
                       for i, m in enumerate(covering_masks())])
    keyed = (distinct.select("fp", F.explode(tables).alias("x"))
             .select("fp", F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("key")))
    groups = (keyed.groupBy("t", "key")
              .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"),
                   F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("differ"))
              .where("n > 1"))
    two = groups.where((F.col("n") == 2) & (F.bit_count("differ") <= RADIUS)).select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    many = keyed.join(groups.where("n > 2").select("t", "key", "differ"), ["t", "key"])
    points = (many.select("fp", F.explode(_flips(F.col("differ"))).alias("flip"))
              .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point")).distinct())
    # at most 65 members each: the point itself and its 64 neighbours
    stars = points.groupBy("point").agg(F.collect_list("fp").alias("members"), F.min("fp").alias("a")).where(F.size("members") > 1)
    star_edges = stars.select("a", F.explode("members").alias("b")).where("a <> b")
    return two.unionByName(star_edges).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``fp``, ``root`` for every fingerprint with a link; root is the component's smallest fingerprint."""
    current = written(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), "near-dup-links")
    state = None
    for _ in range(max_rounds):
        # large star: larger neighbours move to the smallest neighbour
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u")
        current = written(moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                          .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "near-dup-stars")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.groupBy(F.col("u").alias("fp")).agg(F.min("v").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fingerprint`` (long), ``root`` (the component's smallest
    fingerprint) and ``component_id`` (its smallest doc_id) of every document."""
    prints = written(fingerprints(docs, shingle), "near-dup-prints")
    by_print = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least_id"))
    found = components(links(by_print.select("fp")))
    rooted = by_print.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_print = rooted.select("fp", "root").join(least, "root")
    return (prints.join(of_print, prints["fingerprint"] == of_print["fp"], "left")
            .select("doc_id", "text_hash", "fingerprint", "root", "component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest
    doc_id (nulls last); of several rows with that id, the one with the smallest text hash;
    of fully alike ids and texts, any one row."""
    found = near_duplicates(docs, shingle)
    first = Window.partitionBy("root").orderBy(F.col("doc_id").asc_nulls_last(), F.col("text_hash"))
    keepers = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("root", "doc_id", "text_hash").distinct()
               .withColumn("r", F.row_number().over(first)).where("r = 1")
               .select(F.col("doc_id").alias("k"), F.col("text_hash").alias("h")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = (row.select("row", F.col("row.doc_id").alias("d"), F.xxhash64("row.text").alias("x"))
            .join(keepers, F.col("d").eqNullSafe(F.col("k")) & (F.col("x") == F.col("h")), "left_semi"))
    return kept.groupBy("d", "x").agg(F.first("row").alias("row")).select("row.*")
