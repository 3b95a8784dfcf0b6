"""Personal data by generators, boosted trees and calibrated thresholds (operator 1).

High-recall generators propose spans, which may overlap: the four base kinds (e-mail
addresses, IP addresses, card and phone numbers) and wider ones (dotted numbers, digit
groups, key-like strings).  Gradient-boosted trees score every candidate from its format
and its context; the trees are trained on a bounded sample of candidates (``train_rows``, dealt
evenly to kinds and labels; rare ones enter whole)
with labels from exact validity rules (address ranges, Luhn sums, digit counts, an assignment to
a secret's name).  Every candidate is also scored by trees that were trained without its
fold; per kind, the lowest score from which these reach ``precision`` is the threshold, by
the same rule however many candidates there are; kinds that never reach it add nothing.
Base spans that pass their rules are always kept; a scored span inside a base span is not
repeated.

Everything is DataFrame functions; the trained trees become one column expression.

Positions are code points, end exclusive.  Defined cases: null and empty texts have no
spans; repeated rows are treated alike; a table without candidates (or with one class
only) trains no trees and returns base spans only; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _BLOCK, free_name, let, running_largest, running_totals, written

# Possessive quantifiers and run starts give the same matches as the plain patterns
# without recursion or quadratic rescans on very long runs.
GENERATORS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "dotted": r"(?<![0-9.])[0-9]++(?:[.,][0-9]++){2,}+",
    "number": r"(?<![0-9])[0-9](?:[ ./()-]{0,2}[0-9]){6,}+",
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+",
}
BASE = ("email", "ip", "card", "phone")
NEEDS = {"email": "@", "phone": "+", "ip": ".", "dotted": None, "card": None, "number": None, "secret": None}
FEATURES = ("n_chars", "n_digits", "n_letters", "n_upper", "n_blank", "n_dash", "n_dots", "at", "plus", "hex",
            "before", "after", "secret_word", "phone_word")
INPUTS = (*FEATURES, "order")  # of the trees: the features and the kind


@dataclass(frozen=True)
class Training:
    train_rows: int = 20_000   # candidates, in expectation, that the trees are fitted on
    trees: int = 12
    depth: int = 4
    precision: float = 0.95
    folds: int = 2             # each is scored by trees of the others


def _count(m: Column, chars: str) -> Column:
    return F.length(m) - F.length(F.translate(m, chars, ""))


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _char_class(c: Column) -> Column:
    """0: none or space, 1: letter or digit, 2: quote, 3: other."""
    return (F.when((c == "") | c.rlike(r"^\s"), 0).when(c.rlike(r"^[\p{L}\p{N}]"), 1)
            .when(c.rlike("^[\"'`]"), 2).otherwise(3))


SECRET_WORD = r"(?i)(token|secret|passw|api.?key|access.?key|credential)[^A-Za-z0-9]*$"
ASSIGNED = r"(?i)(token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"' ]*[:=] ?[\"']?$"
PHONE_WORD = r"(?i)(tel|phone|call|fax|mobile)[^A-Za-z0-9]*$"


def _luhn(digits: Column) -> Column:
    from_end = F.reverse(digits)
    plain = F.regexp_replace(from_end, "(.).?", "$1")
    doubled = F.translate(F.regexp_replace(from_end, ".(.?)", "$1"), "0123456789", "0246813579")
    both = F.concat(plain, doubled)
    total = F.aggregate(F.sequence(F.lit(1), F.length(both)), F.lit(0),
                        lambda s, i: s + F.substring(both, i, F.lit(1)).cast("int"))
    return total % 10 == 0


def _valid(kind: str, m: Column, before: Column) -> Column:
    """The exact rule of a kind: base spans must pass it; for the others it is the training label."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    address = m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    card = F.when((n >= 14) & (n <= 19), _luhn(digits)).otherwise(F.lit(False))
    return {"email": F.lit(True), "ip": address, "dotted": address, "card": card, "number": card,
            "phone": (n >= 10) & (n <= 15),
            "secret": before.rlike(ASSIGNED) & m.rlike("[0-9]")}[kind]


def _candidates(kind: str, order: int) -> Column:
    parts, hits = F.col(f"parts_{kind}"), F.col(f"hits_{kind}")
    steps = F.zip_with(F.slice(parts, F.lit(1), F.size(hits)), hits, lambda p, h: F.length(p) + F.length(h))
    after = F.slice(parts, F.lit(2), F.greatest(F.size(hits), F.lit(1)))

    def span(x: Column) -> Column:
        m, before, after = x["hits"], F.right(x["parts"], F.lit(32)), F.left(x["after"], F.lit(1))
        start = x["at"] + F.length(x["parts"])
        f = {"n_chars": F.length(m), "n_digits": _count(m, _DIGITS), "n_letters": _count(m, _LOWER + _UPPER),
             "n_upper": _count(m, _UPPER), "n_blank": _count(m, " "), "n_dash": _count(m, "-"), "n_dots": _count(m, "."),
             "at": F.instr(m, "@"), "plus": F.startswith(m, F.lit("+")).cast("int"),
             "hex": m.rlike("^[0-9a-f]+$").cast("int"), "before": _char_class(F.right(before, F.lit(1))),
             "after": _char_class(after), "secret_word": before.rlike(SECRET_WORD).cast("int"),
             "phone_word": before.rlike(PHONE_WORD).cast("int")}
        return F.struct(start.alias("start"), F.lit(order).alias("order"), (start + F.length(m)).alias("end"),
                        F.lit(kind).alias("kind"), F.coalesce(_valid(kind, m, before), F.lit(False)).alias("valid"),
                        *[f[c].cast("double").alias(c) for c in FEATURES])

    rows = F.arrays_zip(hits.alias("hits"), F.slice(parts, F.lit(1), F.size(hits)).alias("parts"),
                        after.alias("after"), F.col(f"at_{kind}").alias("at"))
    return F.transform(F.filter(rows, lambda x: x["hits"].isNotNull()), span), steps


def candidates(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with the array ``out`` of all candidate spans and their features."""
    keep = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    t = F.col("t")
    digits = t.rlike("[0-9]")
    df = docs.select(row, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    gate = {k: (F.contains(t, F.lit(c)) if c else F.lit(True)) & (digits if k != "email" else F.lit(True)) for k, c in NEEDS.items()}
    none = F.array().cast("array<string>")
    df = df.select("row", *[
        x for k, p in GENERATORS.items() for x in (
            F.when(gate[k], F.split(t, p, -1)).otherwise(none).alias(f"parts_{k}"),
            F.when(gate[k], F.regexp_extract_all(t, F.lit(p), F.lit(0))).otherwise(none).alias(f"hits_{k}"))])
    spans = {k: _candidates(k, i) for i, k in enumerate(GENERATORS)}
    df = df.select("*", *[steps.alias(f"steps_{k}") for k, (_, steps) in spans.items()])
    df = df.select("*", *[running_totals(F.col(f"steps_{k}")).alias(f"at_{k}") for k in GENERATORS])
    return df.select("row", F.concat(*[s for s, _ in spans.values()]).alias("found")).select("row.*", F.col("found").alias(out))


# --- boosted trees as a column -------------------------------------------------

def _tree(lines: list[str], feature) -> Column:
    """One printed regression tree as nested CASE expressions."""
    line = lines.pop(0)
    if m := re.fullmatch(r"\s*Predict: (\S+)", line):
        return F.lit(float(m[1]))
    m = re.fullmatch(r"\s*If \(feature (\d+) <= (\S+)\)", line)
    low = _tree(lines, feature)
    lines.pop(0)  # Else
    high = _tree(lines, feature)
    return F.when(feature(int(m[1])) <= float(m[2]), low).otherwise(high)


@dataclass
class Model:
    trees: list[tuple[float, str]]
    thresholds: dict[str, float]
    start: float = 0.0  # margin before any tree

    def score(self, feature) -> Column:
        """Probability of personal data; ``feature(i)`` is the i-th feature's column."""
        margin = F.lit(self.start)
        for weight, text in self.trees:
            body = [x for x in text.splitlines()[1:] if x.strip()]
            margin = margin + F.lit(float(weight)) * _tree(body, feature)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))

    def selects(self, span: Column) -> Column:
        if not self.thresholds:
            return F.lit(False)
        bar = F.lit(2.0)
        for kind, t in self.thresholds.items():
            bar = F.when(span["kind"] == kind, F.lit(t)).otherwise(bar)
        return self.score(lambda i: span[INPUTS[i]]) >= bar


def _fit(rows: DataFrame, options: Training) -> Model:
    """The trees of ``rows``, without thresholds; every kind and label weighs the same however
    rare it is.  Rows of one label score 0 or 1."""
    counts = {(r["kind"], r["label"]): r["count"] for r in rows.groupBy("kind", "label").count().collect()}
    labels = {label for _, label in counts}
    if len(labels) < 2:
        return Model([], {}, 30.0 if labels == {1.0} else -30.0)
    weight = F.lit(0.0)
    for (kind, label), n in counts.items():
        weight = F.when((F.col("kind") == kind) & (F.col("label") == label), F.lit(sum(counts.values()) / (len(counts) * n))).otherwise(weight)
    vectors = VectorAssembler(inputCols=list(INPUTS), outputCol="features").transform(rows.withColumn("weight", weight))
    gbt = GBTClassifier(maxIter=options.trees, maxDepth=options.depth, maxBins=32, seed=7, checkpointInterval=-1, weightCol="weight")
    fitted = gbt.fit(vectors.select("features", "label", "weight"))
    return Model([(w, t.toDebugString) for w, t in zip(fitted.treeWeights, fitted.trees)], {})


def _shares(counts: list[int], total: int) -> list[float]:
    """The share of each group to take so that all have the same bound and ``total`` rows in sum."""
    left, bound = total, 0.0
    for at, n in enumerate(sorted(counts)):
        bound = left / (len(counts) - at)
        if n > bound:
            break
        left -= n
        bound = n
    return [1.0 if n <= bound else bound / n for n in counts]


def train(docs: DataFrame, options: Training = Training()) -> Model:
    """Trees of a bounded sample of the candidates of all documents, thresholds of all candidates."""
    found = candidates(docs.select("doc_id", "text"), "text", "found")
    # (an outer explode: else Spark evaluates the whole array once more, for a filter on its size)
    found = found.select("doc_id", F.explode_outer("found").alias("c")).where("c is not null")
    rows = found.select("doc_id", "c.*").withColumn("key", F.xxhash64(F.col("doc_id").cast("string"), "start", "kind"))
    rows = written(rows.select("kind", "key", F.col("valid").cast("double").alias("label"), *INPUTS), "pii-candidates")
    # each kind and label is cut into folds, and has its own share in what the trees are fitted on
    strata = rows.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(
        "key", [(k + 1) / options.folds for k in range(options.folds - 1)], 10_000).alias("at")).collect()
    shares = _shares([r["n"] for r in strata], options.train_rows)
    fold, share = F.lit(0), F.lit(0.0)
    for r, part in zip(strata, shares):
        here = (F.col("kind") == r["kind"]) & (F.col("label") == r["label"])
        fold = F.when(here, sum(((F.col("key") > F.lit(c)).cast("int") for c in r["at"]), F.lit(0))).otherwise(fold)
        share = F.when(here, F.lit(part)).otherwise(share)
    rows = rows.withColumn("fold", fold)
    sample = written(rows.where(F.xxhash64("key") / F.lit(2.0 ** 64) + 0.5 <= share).repartition(2), "pii-sample")
    model = _fit(sample, options)
    if not model.trees:
        return Model([], {})
    others = [_fit(sample.where(F.col("fold") != k), options) for k in range(options.folds)]
    score = F.lit(0.0)
    for k, m in enumerate(others):
        score = F.when(F.col("fold") == k, m.score(lambda i: F.col(INPUTS[i]))).otherwise(score)
    scored = rows.select("kind", "label", F.floor(score * 50).alias("bin"))
    bins = scored.groupBy("kind", "bin").agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).collect()
    for kind in {b["kind"] for b in bins}:
        good = n = 0
        for b in sorted((b for b in bins if b["kind"] == kind), key=lambda b: -b["bin"]):
            good, n = good + b["good"], n + b["n"]
            if good > 0 and good >= options.precision * n:
                model.thresholds[kind] = b["bin"] / 50
    return model


def find(docs: DataFrame, out: str, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the array ``out`` of spans (start, order, end, kind, base), by start and kind."""
    name = free_name(docs, "candidates")
    df = candidates(docs, text, name)
    brief = lambda c, base: F.struct(c["start"].alias("start"), c["order"].alias("order"), c["end"].alias("end"),
                                     c["kind"].alias("kind"), F.lit(base).alias("base"))
    base = F.transform(F.filter(F.col(name), lambda c: c["kind"].isin(*BASE) & c["valid"]), lambda c: brief(c, True))
    kept = free_name(df, "base_spans")
    df = df.withColumn(kept, base)
    more = F.filter(F.col(name), lambda c: ~(c["kind"].isin(*BASE) & c["valid"]) & model.selects(c))
    # by start, longer ones first, base spans before others: a span lies within a base span exactly if a base
    # span before it ends no earlier
    both = F.array_sort(F.concat(
        F.transform(F.col(kept), lambda b: F.struct(b["start"].alias("start"), (-b["end"]).alias("back"), F.lit(0).alias("added"), b.alias("span"))),
        F.transform(more, lambda c: F.struct(c["start"].alias("start"), (-c["end"]).alias("back"), F.lit(1).alias("added"), brief(c, False).alias("span")))))

    def outer(b: Column) -> Column:
        covered = running_largest(F.transform(b, lambda x: F.when(x["added"] == 0, -x["back"]).otherwise(-1)))
        return F.transform(F.filter(F.arrays_zip(b.alias("x"), covered.alias("to")), lambda y: (
            y["x"]["added"] == 0) | (y["to"] < -y["x"]["back"])), lambda y: y["x"]["span"])

    spans = F.array_sort(let(both, outer))
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], spans.alias(out))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def detect(docs: DataFrame, options: Training = Training()) -> DataFrame:
    """``doc_id`` and the array ``found`` of every document's spans."""
    docs = docs.select("doc_id", "text")
    return find(docs, "found", train(docs, options)).drop("text")


def redact(docs: DataFrame, options: Training = Training()) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; spans that overlap
    are replaced together, under the first one's kind."""
    spans = free_name(docs, "spans")
    df = find(docs, spans, train(docs, options))
    # a span starts a group of overlapping ones if all earlier spans end before it; a group ends where the
    # next one's earlier spans do
    def groups(spans: Column) -> Column:
        before = running_largest(F.transform(spans, lambda s: s["end"]))
        heads = F.filter(F.arrays_zip(spans.alias("s"), before.alias("b")), lambda x: x["b"] <= x["s"]["start"])
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return let(heads, lambda h: F.transform(F.arrays_zip(h.alias("h"), F.concat(F.transform(F.slice(h, F.lit(2), F.size(h)), lambda x: x["b"]), F.array(last)).alias("e")), lambda x: F.struct(
            x["h"]["s"]["start"].alias("start"), x["e"].alias("end"), x["h"]["s"]["kind"].alias("kind"))))

    merged = free_name(df, "merged")
    df = df.withColumn(merged, F.when(F.size(spans) > 0, let(F.col(spans), groups)))
    masked = F.when(F.size(spans) > 0, let(F.struct(F.col("text").alias("text"), F.col(merged).alias("spans")),
                                           lambda x: _masked(x["text"], x["spans"], F.lit(0), 2))).otherwise(F.col("text"))
    return df.select(*[masked.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def _masked(text: Column, spans: Column, start: Column, levels: int) -> Column:
    """``text``, which begins at code point ``start``, with the spans replaced.  A long list of spans is cut into
    blocks with their own pieces of text, as a substring is searched from the beginning of its text."""
    if levels == 0:
        pieces = F.transform(spans, lambda x, i: F.concat(
            let(F.when(i == 0, start).otherwise(F.get(spans, i - 1)["end"]),
                lambda at: F.substring(text, at - start + 1, x["start"] - at)),
            F.lit("["), F.upper(x["kind"]), F.lit("]")))
        rest = F.substring(text, F.element_at(spans, -1)["end"] - start + 1, F.length(text))
        return F.concat(F.array_join(pieces, ""), rest)
    block = _BLOCK ** levels
    starts = F.sequence(F.lit(0), F.size(spans) - 1, F.lit(block))

    def part(k: Column) -> Column:
        lo = F.when(k == 0, start).otherwise(F.get(spans, k)["start"])
        hi = F.coalesce(F.get(spans, k + block)["start"], start + F.length(text))
        return let(F.struct(lo.alias("lo"), hi.alias("hi")), lambda c: let(
            F.struct(F.substring(text, c["lo"] - start + 1, c["hi"] - c["lo"]).alias("t"), F.slice(spans, k + 1, F.lit(block)).alias("s"), c["lo"].alias("at")),
            lambda x: _masked(x["t"], x["s"], x["at"], levels - 1)))

    return F.array_join(F.transform(starts, part), "")
