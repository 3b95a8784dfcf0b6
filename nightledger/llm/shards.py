"""Sharding by extendible hashing (operator 9).

Documents are hashed over id and text; the directory is indexed by the hash's leading
bits.  A bucket splits on its next bit only while it exceeds the byte limit, so a shard is
the shortest prefix whose documents fit.  The directory is built from sums per prefix: a
round takes ``STEP`` more bits of all buckets that are still too large, sums the bytes of
the finest prefixes (partial sums first) and finds for each the shortest prefix that fits.

Documents with equal hashes are exact copies, which no bit can part.  Where the copies of
one document alone exceed the limit they leave the directory and are dealt to overflow
shards, named by the whole hash and a number, each within the limit.  A single document
above the limit is a shard of its own, marked ``oversized``.

Defined cases: null and empty texts count 0 bytes; a null id hashes as an empty one;
repeated rows each get a row; a table within the limit is the one shard of no bits; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, written
from .prefix import prefix_sums

LIMIT = 256 << 20
STEP = 8
BITS = 64


def hash_bits(doc_id: Column, text: Column) -> Column:
    """The 64 leading bits of MD5 over id and text, as a string of 0 and 1."""
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.lpad(F.conv(F.substring(F.md5(both.cast("binary")), 1, 16), 16, 2), BITS, "0")


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``bits``, ``n_bytes`` and the number ``n`` of fully equal documents."""
    rows = docs.select("doc_id", hash_bits(F.col("doc_id"), F.col("text")).alias("bits"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.groupBy("doc_id", "bits", "n_bytes").agg(F.count(F.lit(1)).alias("n"))


def directory(rows: DataFrame, limit: int, step: int = STEP) -> DataFrame:
    """The buckets (``prefix``, ``depth``) of ``rows`` (``bits``, ``b`` bytes, none above ``limit``)."""
    open_, found = rows, None
    for low in range(0, BITS, step):
        high = low + step
        fine = open_.groupBy(F.left("bits", F.lit(high)).alias("p")).agg(F.sum("b").alias("b"))
        totals = (fine.select("p", "b", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
                  .groupBy(F.expr("left(p, depth)").alias("prefix"), "depth").agg(F.sum("b").alias("b")))
        totals = written(totals, f"directory-{low}")
        # a bucket fits and its parent does not; the first round's root has no parent, and the
        # first depth of a later round holds only buckets known to be too large
        too_large = totals.where(F.col("b") > limit).select(F.col("prefix").alias("pp"), (F.col("depth") + 1).alias("pd"))
        fits = totals.where(F.col("b") <= limit)
        leaves = fits.join(too_large, (F.expr("left(prefix, depth - 1)") == F.col("pp")) & (F.col("depth") == F.col("pd")), "left_semi")
        if low == 0:
            leaves = leaves.unionByName(fits.where("depth = 0"))
        leaves = leaves.select("prefix", "depth")
        found = leaves if found is None else found.unionByName(leaves)
        over = totals.where((F.col("depth") == high) & (F.col("b") > limit)).select(F.col("prefix").alias("op"))
        if not over.take(1):
            break
        open_ = written(open_.join(over, F.left("bits", F.lit(high)) == F.col("op"), "left_semi"), f"open-{high}")
    return found


def leaves_of(rows: DataFrame, limit: int, step: int = STEP) -> tuple[DataFrame, DataFrame]:
    """The directory's buckets (``prefix``, ``depth``), and the hashes whose copies alone exceed ``limit``
    (``bits``), which are not in it.  Neither has more rows than the documents fill shards, about."""
    sums = written(rows.groupBy("bits").agg(F.sum(F.col("n_bytes") * F.col("n")).alias("b")), "hash-sizes")
    return (written(directory(sums.where(F.col("b") <= limit), limit, step), "shard-leaves"),
            written(sums.where(F.col("b") > limit).select("bits"), "shard-heavy"))


def in_directory(at: DataFrame, leaves: DataFrame, heavy: DataFrame) -> DataFrame:
    """``at`` with ``shard`` and ``depth`` of its ``bits``: of heavy hashes the whole hash and depth ``BITS``.

    Rows meet the buckets by the prefix that all buckets have, so rows are neither multiplied nor, where
    Spark can broadcast the directory (its size is known: it is written), moved."""
    low = leaves.agg(F.min("depth")).first()[0] or 0
    named = leaves.select(F.left("prefix", F.lit(low)).alias("l_low"), F.col("prefix").alias("l_prefix"), F.col("depth").alias("l_depth"))
    alone = heavy.select(F.col("bits").alias("h_bits"))
    inside = (F.left("bits", F.lit(low)) == F.col("l_low")) & F.expr("left(bits, l_depth)").eqNullSafe(F.col("l_prefix"))
    return (at.join(alone, F.col("bits") == F.col("h_bits"), "left").join(named, F.col("h_bits").isNull() & inside, "left")
            .withColumn("shard", F.coalesce("h_bits", "l_prefix")).withColumn("depth", F.coalesce("l_depth", F.lit(BITS)))
            .drop("h_bits", "l_low", "l_prefix", "l_depth"))


def placed(docs: DataFrame, limit: int = LIMIT, step: int = STEP) -> DataFrame:
    """Every row of ``docs`` (as ``row``) with its ``shard``, ``depth`` and ``n_bytes``.

    Copies of a document that do not fit one shard together are numbered one by one, by
    prefix sums over the rows themselves, and dealt to overflow shards in that order."""
    rows = written(sized(docs), "shard-sizes")
    leaves, heavy = leaves_of(rows, limit, step)
    per = F.greatest(F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))), F.lit(1))  # copies that fit together
    over = written(rows.join(heavy, "bits").where(F.col("n") > per).select(F.col("bits").alias("o_bits"), F.col("doc_id").alias("o_id"),
                                                                        F.col("n_bytes").alias("o_bytes")), "shard-overflow")
    size = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long")
    at = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
          .select("row", hash_bits(F.col("row.doc_id"), F.col("row.text")).alias("bits"), size.alias("n_bytes")))
    same = (F.col("bits") == F.col("o_bits")) & F.col("row.doc_id").eqNullSafe(F.col("o_id")) & (F.col("n_bytes") == F.col("o_bytes"))
    some = bool(over.take(1))
    plain = in_directory(at.join(over, same, "left_anti") if some else at, leaves, heavy).select("row", "shard", "depth", "n_bytes")
    if not some:
        return plain
    group = F.concat_ws(":", "bits", F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")), F.col("n_bytes").cast("string"))
    hot = written(at.join(over, same, "left_semi").select("row", "bits", "n_bytes", group.alias("g"), F.monotonically_increasing_id().alias("number"),
                                                          F.lit(1).cast("long").alias("one")), "shard-copies")
    dealt = prefix_sums(hot, "g", ["number"], "one", "shard-copies")
    return plain.unionByName(dealt.select("row", F.concat_ws("+", "bits", F.floor(F.col("before") / per).cast("string")).alias("shard"),
                                          F.lit(BITS).alias("depth"), "n_bytes"))


def assign(docs: DataFrame, limit: int = LIMIT, step: int = STEP) -> DataFrame:
    """``doc_id``, ``shard``, ``depth``, ``n_bytes`` and ``oversized`` of every document."""
    return placed(docs.select("doc_id", "text"), limit, step).select(
        "row.doc_id", "shard", F.col("depth").cast("int").alias("depth"), "n_bytes", (F.col("n_bytes") > limit).alias("oversized"))


def write(docs: DataFrame, path: str, limit: int = LIMIT, step: int = STEP) -> None:
    """Write ``docs``, with all their columns, to a folder per shard (shard=b<prefix>), placed as ``assign`` says."""
    name = free_name(docs, "shard")
    at = placed(docs, limit, step).select("row.*", F.concat(F.lit("b"), "shard").alias(name))
    at.repartition(F.col(name)).write.partitionBy(name).parquet(path)


def read(spark: SparkSession, path: str, limit: int = LIMIT) -> DataFrame:
    """What ``assign`` says, from the files that ``write`` wrote (of documents without a column ``shard``)."""
    prefix = F.substring("shard", 2, 200)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return (spark.read.parquet(path).withColumn("shard", F.col("shard").cast("string"))
            .select("doc_id", prefix.alias("shard"), F.length(F.substring_index(prefix, "+", 1)).alias("depth"), size.alias("n_bytes"), (size > limit).alias("oversized")))
