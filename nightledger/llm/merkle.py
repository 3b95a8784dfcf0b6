"""Merkle dataset manifest with pointer-jumping proofs (operator 13).

Leaves are numbered within their source by distributed prefix sums.  The tree is built level by
level: ``FANOUT`` consecutive nodes are one group of a shuffle on (source, number / FANOUT), so a
hot source spreads over all tasks.  The sources' roots are the leaves of an upper tree.

Proofs: a node holds the segment of sibling digests between itself and an ancestor, at first its
parent.  A round joins the nodes with the nodes they point to, appends their segments and takes
over their pointers, which doubles the distance; after a logarithm of the height every leaf's
segment reaches its subroot, and one more join appends the subroot's own segment.  Nodes whose
level is no multiple of the distance are not needed any more and are left out.

Defined cases: null fields are hashed as ``-``; null ids come first in their source; rows with one
id are ordered by their leaf, repeated rows each are a leaf; a lone document or source has no
siblings there; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .prefix import prefix_sums

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
_DIGEST = 32  # bytes


def field(value: Column) -> Column:
    """A field as it is hashed: ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(row: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in row.values()]), 256)


def _joined(digests: Column) -> Column:
    """An array of binary digests as one binary."""
    return F.aggregate(digests, F.lit(b""), lambda s, d: F.concat(s, d))


def _hashed(digests: Column) -> Column:
    """H of binary digests as hex text, as a binary digest."""
    return F.unhex(F.sha2(F.lower(F.hex(_joined(digests))), 256))


def build(nodes: DataFrame, fanout: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """From the leaves ``tree``, ``n`` (leaves of the tree), ``i``, ``digest`` (binary) and
    ``payload``: for each level the ``runs`` of its nodes, and the roots ``tree``, ``digest``."""
    levels = []
    largest = nodes.agg(F.max("n")).first()[0] or 0
    here = nodes.withColumn("left", F.col("n"))  # nodes of the tree on this level
    roots = here.where("left = 1").select("tree", "digest")
    while largest > 1:
        runs = written(here.where("left > 1").groupBy("tree", "n", "left", F.floor(F.col("i") / fanout).alias("up"))
                       .agg(F.array_sort(F.collect_list(F.struct("i", "digest", "payload"))).alias("run")), f"{name}-level")
        levels.append(runs)
        here = runs.select("tree", "n", F.ceil(F.col("left") / fanout).alias("left"), F.col("up").alias("i"),
                           _hashed(F.col("run.digest")).alias("digest"),
                           F.lit(None).cast(nodes.schema["payload"].dataType).alias("payload"))
        roots = roots.unionByName(here.where("left = 1").select("tree", "digest"))
        largest = -(-largest // fanout)
    return levels, written(roots, f"{name}-roots")


def segments(levels: list[DataFrame], name: str) -> DataFrame:
    """``tree``, ``n``, ``i``, ``payload`` and ``segment`` (the siblings up to the tree's root, binary)
    of every leaf that has a parent, by pointer jumping."""
    def own(runs: DataFrame, level: int) -> DataFrame:
        node = runs.select("tree", "n", "up", "run", F.explode("run").alias("x"))
        others = F.transform(F.filter("run", lambda y: y["i"] != F.col("x.i")), lambda y: y["digest"])
        return node.select("tree", "n", F.lit(level).alias("level"), F.col("x.i").alias("i"), F.col("x.payload").alias("payload"),
                           _joined(others).alias("segment"), F.lit(level + 1).alias("to_level"), F.col("up").alias("to_i"))

    held = {level: own(runs, level) for level, runs in enumerate(levels)}
    step = 1
    while step < len(levels):
        jumped = {}
        for level in range(0, len(levels), 2 * step):
            far = held.get(level + step)
            jumped[level] = held[level]
            if far is not None:
                to = far.select(F.col("tree").alias("t"), F.col("i").alias("j"), F.col("segment").alias("rest"),
                                F.col("to_level").alias("l"), F.col("to_i").alias("k"))
                on = (F.col("tree") == F.col("t")) & (F.col("to_i") == F.col("j")) & (F.col("to_level") == level + step)
                met = F.col("t").isNotNull()
                jumped[level] = written(held[level].join(to, on, "left").select(
                    "tree", "n", "level", "i", "payload",
                    F.when(met, F.concat("segment", "rest")).otherwise(F.col("segment")).alias("segment"),
                    F.when(met, F.col("l")).otherwise(F.col("to_level")).alias("to_level"),
                    F.when(met, F.col("k")).otherwise(F.col("to_i")).alias("to_i")), f"{name}-jump")
        held, step = jumped, 2 * step
    return held[0].select("tree", "n", "i", "payload", "segment")


def proofs(nodes: DataFrame, fanout: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Every leaf with its ``segment``, and the roots of the trees."""
    levels, roots = build(nodes, fanout, name)
    lone = nodes.where("n = 1").select("tree", "n", "i", "payload", F.lit(b"").alias("segment"))
    return (lone.unionByName(segments(levels, name)) if levels else lone), roots


def fold(start: Column, segment: Column, at: Column, n: Column, fanout: int, height: int) -> Column:
    """The root (hex) that a leaf at place ``at`` of ``n`` gives with the siblings in ``segment``."""
    def digests(state: Column, count: Column, skip: Column) -> Column:
        return F.lower(F.hex(F.substring(segment, state["at"] + skip * _DIGEST + 1, count * _DIGEST)))

    def step(s: Column, _: Column) -> Column:
        place = s["i"] % fanout
        others = F.least(F.lit(fanout).cast("long"), s["n"] - s["i"] + place) - 1
        text = F.concat(digests(s, place, F.lit(0)), s["digest"], digests(s, others - place, place))
        up = F.struct(F.sha2(text, 256).alias("digest"), F.floor(s["i"] / fanout).alias("i"), F.ceil(s["n"] / fanout).alias("n"),
                      (s["at"] + others * _DIGEST).cast("int").alias("at"))
        return F.when(s["n"] > 1, up).otherwise(s)

    first = F.struct(start.alias("digest"), at.cast("long").alias("i"), n.cast("long").alias("n"), F.lit(0).alias("at"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(height, 1))), first, step, lambda s: s["digest"])


def _height(n: int, fanout: int) -> int:
    h = 0
    while n > 1:
        n, h = -(-n // fanout), h + 1
    return h


def manifest(docs: DataFrame, changed_text: Column | None = None, fields: Sequence[str] = FIELDS,
             fanout: int = FANOUT) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root`` (hex), ``proof`` (the sibling digests, binary),
    and ``folded_root``, ``verified``: the root recomputed from the leaf of ``changed_text`` (the
    text itself if none) and the proof."""
    row = {c: F.col(f"`{c}`") for c in fields}
    tree = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source")))  # null first
    other = {**row, "text": row["text"] if changed_text is None else changed_text}
    rows = written(docs.select(
        tree.alias("tree"), "doc_id", F.unhex(leaf(row)).alias("digest"), F.unhex(leaf(other)).alias("seen"),
        F.monotonically_increasing_id().alias("number"), F.lit(1).cast("long").alias("one")), "merkle-leaves")
    nodes = (prefix_sums(rows, "tree", ["doc_id", "digest", "number"], "one", "merkle")
             .select("tree", F.col("whole").alias("n"), F.col("before").alias("i"), "digest",
                     F.struct("doc_id", "digest", "seen").alias("payload")))
    found, subroots = proofs(written(nodes, "merkle-nodes"), fanout, "merkle")
    ranked = prefix_sums(subroots.withColumn("all", F.lit("")).withColumn("one", F.lit(1).cast("long")), "all", ["tree"], "one", "merkle-sources")
    tops = written(ranked.select(F.col("all").alias("tree"), F.col("whole").alias("n"), F.col("before").alias("i"), "digest",
                                 F.struct("tree", "digest").alias("payload")), "merkle-subroots")
    over, roots = proofs(tops, fanout, "merkle-top")
    root = roots.first()
    digest = F.lit(bytes(root["digest"]) if root else None).cast("binary")
    over = written(over.select(F.col("payload.tree").alias("t"), F.col("payload.digest").alias("subroot"), F.col("segment").alias("rest"),
                               F.col("i").alias("rank"), F.col("n").alias("of")), "merkle-top-proofs")
    most, tops_n = found.agg(F.max("n")).first()[0] or 0, over.count()
    text = lambda c: F.lower(F.hex(c))
    whole = found.join(over, F.col("tree") == F.col("t"))
    sub = fold(text(F.col("payload.seen")), F.col("segment"), F.col("i"), F.col("n"), fanout, _height(most, fanout))
    return (whole.withColumn("sub", sub)
            .select(F.col("payload.doc_id").alias("doc_id"), text(F.col("payload.digest")).alias("leaf"), text(F.col("subroot")).alias("subroot"),
                    text(digest).alias("root"), F.concat("segment", "rest").alias("proof"),
                    fold(F.col("sub"), F.col("rest"), F.col("rank"), F.col("of"), fanout, _height(tops_n, fanout)).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
