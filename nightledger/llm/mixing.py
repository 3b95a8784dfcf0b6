"""Mixing sources to target weights by prefix sums over hash-random keys (operator 12).

Every document gets a hash-random key.  The rows are range-sorted by source and key, and
distributed prefix sums of the sizes (words) say how much of its source stands before each
document.  A source's budget is cut exactly: as many whole epochs as fit, then documents in key
order until the rest is used up; the document at the cut gives its first words only.

Targets: sources in code-point order (null last) weigh ``WEIGHTS`` in turn and share ``SHARE`` of
all words by weight; a target stops at ``MOST`` times its source's size, and what is over goes
to the others by weight until none is above (the level of the water: a few rounds of one small
aggregate over the sources each).  Budgets are targets rounded to whole words.

Keys are hashes of id and text, so a rerun makes the same mix; fully repeated rows have the same
key, are told apart by a row number that is written once, and are alike in the result.

Defined cases: a null or word-less text has size 0 and is never taken; null ids and null sources
are ordinary values; repeated rows each count; an empty table gives an empty result; columns that
share a name with those made here are kept apart in ``row``.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .prefix import prefix_sums

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST = 2
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def hash_key(seed: int) -> Column:
    """The hash-random key of a row: hex, from its id and text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(F.col("text"), F.lit(""))))


def targets(sources: DataFrame, weights: Sequence[int], share: Fraction, most: int) -> DataFrame:
    """``group``, ``target`` (double) from ``group``, ``size``, ``weight`` of every source."""
    big = lambda c: F.col(c).cast("decimal(38,0)")
    all_words, all_weight = sources.agg(F.sum("size"), F.sum("weight")).first()
    words, weight, stopped = share * (all_words or 0), all_weight or 0, F.lit(False)
    while weight:
        # the level words / weight is exact: whole numbers on both sides
        above = big("size") * F.lit(most * words.denominator * weight).cast("decimal(38,0)") < big("weight") * F.lit(words.numerator).cast("decimal(38,0)")
        n, full, heavy = sources.where(above).agg(F.count(F.lit(1)), F.sum("size"), F.sum("weight")).first()
        stopped = above
        left = (share * all_words - most * (full or 0), all_weight - (heavy or 0))
        if left == (words, weight):
            break
        words, weight = left
    level = (F.col("weight") * F.lit(words.numerator)).cast("double") / F.lit(float(words.denominator * max(weight, 1)))
    return sources.select("group", F.when(stopped if weight else F.lit(True), (F.col("size") * most).cast("double"))
                          .otherwise(level).alias("target"))


def plan(docs: DataFrame, keep: Sequence[str] = ("doc_id",), weights: Sequence[int] = WEIGHTS,
         share: Fraction = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """For every document ``row`` (its ``keep`` columns), ``size``, ``source_size``, ``target``,
    ``epochs`` (whole copies), ``cut`` (words of one more, partial or whole) and ``taken``."""
    group = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source")))
    rows = written(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.when(F.col("source").isNull(), "t").otherwise(group).alias("group"),  # null last
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hash_key(seed).alias("key"), F.monotonically_increasing_id().alias("number")), "mix-rows")
    sources = written(rows.groupBy("group").agg(F.sum("size").alias("size")), "mix-sources")
    ranks = prefix_sums(sources.withColumn("all", F.lit("")).withColumn("one", F.lit(1).cast("long")), "all", ["group"], "one", "mix-ranks")
    turn = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("before") % len(weights)).cast("int"))
    weighed = written(ranks.select("group", "size", turn.alias("weight")), "mix-weights")
    found = prefix_sums(rows, "group", ["key", "number"], "size", "mix", targets(weighed, weights, share, most))
    budget = F.floor(F.col("target") + 0.5)
    some = F.col("whole") > 0
    epochs = F.when(some, F.floor(budget / F.col("whole"))).otherwise(0)
    found = found.withColumn("epochs", epochs.cast("long"))
    rest = budget - F.col("epochs") * F.col("whole")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before"))).cast("long")
    return (found.withColumn("cut", F.when(some, cut).otherwise(0).cast("long"))
            .select("row", "size", F.col("whole").alias("source_size"), "target", "epochs", "cut",
                    (F.col("epochs") * F.col("size") + F.col("cut")).alias("taken")))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most: int = MOST,
        seed: int = SEED) -> DataFrame:
    """The mixed documents: every row as often as it is taken, with its own columns.  The copy at a
    source's cut holds its first words, space-joined."""
    found = plan(docs, docs.columns, weights, share, most, seed).where("taken > 0")
    times = F.array_repeat(F.col("size"), F.col("epochs").cast("int"))
    copies = F.concat(times, F.when(F.col("cut") > 0, F.array(F.col("cut"))).otherwise(F.array().cast("array<long>")))
    # the name of the copies' column must not be one of the row's
    shown = found.select("row", "size", F.explode(copies).alias("words"))
    part = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("words").cast("int")), " ")
    text = F.when(F.col("words") == F.col("size"), F.col("row.text")).otherwise(part)
    return shown.select(F.col("row").withField("text", text).alias("row")).select("row.*")
