"""Quality rules by distribution divergence (operator 3).

Each document's character-class histogram and common-word histogram are compared with
the reference of its language by Jensen-Shannon distance (square root of the base-2
divergence, 0 to 1).  References are statistics of all documents of a language.

Defined cases: null and empty texts have no words and fail the base rules; documents
with fewer words (or words of the common-word list missing a reference) than the guards
are not judged by the histograms; a null language is compared with the pooled reference
of all documents, every other language with its own, however many languages there are and
however few documents they have; repeated rows are judged alike; an empty table gives an
empty result.  The references of the ``held_languages`` with the most words are sent to all
tasks; documents of further languages are joined with theirs.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import byte_texts, free_name, space_words, written

SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "punctuation", "symbol", "wide", "control")


def _class_of(b: int) -> int:
    if 97 <= b <= 122:
        return 0
    if 65 <= b <= 90:
        return 1
    if 48 <= b <= 57:
        return 2
    if b == 32 or 9 <= b <= 13:
        return 3
    if b in b".,;:!?'\"()-":
        return 4
    if 33 <= b <= 126:
        return 5
    return 6 if b >= 128 else 7


CLASS_TABLE = bytes(_class_of(b) for b in range(256))


@dataclass(frozen=True)
class Limits:
    min_words: int = 50             # base rule
    max_repeat_pct: int = 50        # base rule
    common_words: int = 100         # size of each language's common-word list
    held_languages: int = 256       # references that all tasks hold: languages x common words
    guard_chars: int = 200          # documents below either guard keep the base verdict
    guard_words: int = 50
    max_char_distance: float = 0.35
    max_word_distance: float = 0.44
    word_noise: float = 0.6         # short texts scatter: the word limit grows by this / sqrt(words)


def char_histogram(text: bytes) -> np.ndarray:
    """Counts of the byte classes (a non-ASCII character counts once per byte)."""
    return np.bincount(np.frombuffer(text.translate(CLASS_TABLE), np.uint8), minlength=len(CLASSES))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the base-2 Jensen-Shannon divergence of two count vectors."""
    p, q = p / max(p.sum(), 1), q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(d / 2, 0.0)))


def repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur at least twice in the text, first ones included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    n = Counter(windows)
    hit = bytearray(len(words))
    for i, w in enumerate(windows):
        if n[w] > 1:
            hit[i] = hit[i + 1] = hit[i + 2] = 1
    return sum(hit)


def dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


Reference = tuple[np.ndarray, list[bytes], np.ndarray]  # class counts; common words; their counts, and of all others


def _reference(chars: dict[int, int], words: list[tuple[str, int]], total: int) -> Reference:
    h = np.zeros(len(CLASSES))
    for c, n in chars.items():
        h[c] = n
    return h, [w.encode() for w, _ in words], np.array([*(n for _, n in words), max(total - sum(n for _, n in words), 0)], float)


def references(docs: DataFrame, limits: Limits = Limits()) -> tuple[dict[str | None, Reference], DataFrame | None]:
    """(references by language, the pooled one under null; a table of the further languages' references,
    if there are more than ``held_languages``).

    Counts cover all documents and words.  Each task pre-aggregates its own words; what reaches the
    driver is bounded by ``held_languages`` x (``common_words`` + classes) short rows.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars: dict = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))
        words: dict = defaultdict(Counter)

        def flush():
            rows = [(lang, None, c, int(v)) for lang, h in chars.items() for c, v in enumerate(h) if v]
            rows += [(lang, w.decode(errors="replace"), None, n) for lang, cs in words.items() for w, n in cs.items()]
            rows += [(lang, None, -1, sum(cs.values())) for lang, cs in words.items()]
            chars.clear()
            words.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.int64()))],
                names=["lang", "word", "cls", "n"])

        for b in batches:
            for lang, text in zip(b.column(1).to_pylist(), byte_texts(b)):
                if text:
                    chars[lang] += char_histogram(text)
                    words[lang].update(space_words(text, lower=True))
            if sum(map(len, words.values())) > 200_000:
                yield flush()
        if chars:
            yield flush()

    counts = (docs.select("text", "lang").mapInArrow(count, "lang string, word string, cls int, n long")
              .groupBy("lang", "word", "cls").agg(F.sum("n").alias("n")))
    counts = written(counts, "quality-counts")
    # a language's few class rows all pass the same limit as its words
    ranked = Window.partitionBy("lang", F.col("cls").isNull()).orderBy(F.desc("n"), "word")
    top = written(counts.withColumn("r", F.row_number().over(ranked))
                  .where(F.col("r") <= max(limits.common_words, len(CLASSES) + 1)).where(f"cls is not null or r <= {limits.common_words}"), "quality-references")
    pooled_words = (counts.where("cls is null").groupBy("word").agg(F.sum("n").alias("n"))
                    .orderBy(F.desc("n"), "word").limit(limits.common_words).collect())
    pooled_classes = {r["cls"]: r["n"] for r in counts.where("cls is not null").groupBy("cls").agg(F.sum("n").alias("n")).collect()}
    held = written(top.where("cls = -1 and lang is not null").orderBy(F.desc("n"), "lang").limit(limits.held_languages)
                   .select(F.col("lang").alias("held")), "quality-languages")
    chars: dict = defaultdict(dict)
    words: dict = defaultdict(list)
    for r in top.join(held, F.col("lang") == F.col("held"), "left_semi").orderBy("lang", "r").collect():
        if r["cls"] is None:
            words[r["lang"]].append((r["word"], r["n"]))
        else:
            chars[r["lang"]][r["cls"]] = r["n"]
    refs = {lang: _reference({c: n for c, n in h.items() if c >= 0}, words[lang], h[-1]) for lang, h in chars.items()}
    refs[None] = _reference({c: n for c, n in pooled_classes.items() if c >= 0}, [(r["word"], r["n"]) for r in pooled_words], pooled_classes.get(-1, 0))
    if len(refs) <= limits.held_languages:
        return refs, None
    further = top.where("lang is not null").join(held, F.col("lang") == F.col("held"), "left_anti")
    pair = lambda k: F.struct(F.col(k).alias("k"), F.col("n").alias("n"))
    return refs, (further.groupBy(F.col("lang").alias("of_lang")).agg(
        F.array_sort(F.collect_list(F.when(F.col("cls").isNull(), F.struct((-F.col("n")).alias("m"), "word")))).alias("common"),
        F.collect_list(F.when(F.col("cls") >= 0, pair("cls"))).alias("classes"),
        F.sum(F.when(F.col("cls") == -1, F.col("n"))).alias("total")))


def measure(text: bytes | None, ref: Reference, limits: Limits) -> dict:
    """All figures of one document and its verdict."""
    text = text or b""
    words = space_words(text)
    n, repeated = len(words), repeat_words(words)
    out = {"n_words": n, "word_chars": len(b"".join(words).decode(errors="replace")),
           "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
           "n_dup_lines": dup_lines(text), "n_repeat_words": repeated,
           "base_failed": n < limits.min_words or 100 * repeated > limits.max_repeat_pct * n,
           "char_distance": None, "word_distance": None}
    chars, names, common = ref
    if n >= limits.guard_words and len(text) >= limits.guard_chars and chars.sum():
        out["char_distance"] = js_distance(char_histogram(text), chars)
        seen = Counter(space_words(text, lower=True))
        own = [seen.get(w, 0) for w in names]
        out["word_distance"] = js_distance(np.array([*own, n - sum(own)], float), common)
    out["kept"] = not (out["base_failed"] or (out["char_distance"] or 0) > limits.max_char_distance
                       or (out["word_distance"] or 0) > limits.max_word_distance + limits.word_noise / max(n, 1) ** 0.5)
    return out


FIGURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, char_distance double, word_distance double, kept boolean")


def judged(docs: DataFrame, lang: str, limits: Limits, out: T.StructType, rows_of) -> DataFrame:
    """``docs`` through ``rows_of(batch, figures)``, every document measured against its language's reference.
    ``lang`` and ``text`` are columns of ``docs``; ``out`` is the result's schema."""
    refs, further = references(docs.select("text", F.col(lang).alias("lang")), limits)
    none = _reference({}, [], 0)  # of a language without any text

    def measured(b: pa.RecordBatch, ref_of) -> pa.RecordBatch:
        langs = b.column(b.schema.get_field_index(lang)).to_pylist()
        return rows_of(b, [measure(t, ref_of(g, k), limits) for k, (t, g) in enumerate(zip(byte_texts(b), langs))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield measured(b, lambda g, _: refs.get(g) or none)

    if further is None:
        return docs.mapInArrow(run, out)
    known = [g for g in refs if g is not None]
    here = F.col(lang).isNull() | F.col(lang).isin(known)
    rest = docs.where(~here).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(lang).alias("g"))
    joined = rest.join(further, F.col("g") == F.col("of_lang"), "left").select("row", "common", "classes", "total")

    def run_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, common, classes, totals = (b.column(k) for k in range(4))
            found: dict[str, Reference] = {}

            def ref_of(g, k):
                if g not in found:
                    found[g] = none if totals[k].as_py() is None else _reference({x["k"]: x["n"] for x in classes[k].as_py()}, [(x["word"], -x["m"]) for x in common[k].as_py()], totals[k].as_py())
                return found[g]

            yield measured(pa.RecordBatch.from_arrays(row.flatten(), names=[f.name for f in row.type]), ref_of)

    return docs.where(here).mapInArrow(run, out).unionByName(joined.mapInArrow(run_rest, out))


def score(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: ``doc_id``, the figures and ``kept``."""
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
    names = [x.split()[0] for x in FIGURES.split(", ")]

    def rows_of(b: pa.RecordBatch, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array([r[k] for r in rows], t) for k, t in zip(names, types))], names=["doc_id", *names])

    docs = docs.select("doc_id", "text", "lang")
    kinds = [T.LongType()] * 5 + [T.BooleanType(), T.DoubleType(), T.DoubleType(), T.BooleanType()]
    out = T.StructType([docs.schema["doc_id"], *[T.StructField(n, k) for n, k in zip(names, kinds)]])
    return judged(docs, "lang", limits, out, rows_of)


def filter_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that are kept, with all their columns."""
    lang = free_name(docs, "judged_lang")
    out = T.StructType([*docs.schema.fields, T.StructField(lang, docs.schema["lang"].dataType)])

    def rows_of(b: pa.RecordBatch, rows: list[dict]) -> pa.RecordBatch:
        return b.filter(pa.array([r["kept"] for r in rows], pa.bool_()))

    return judged(docs.withColumn(lang, F.col("lang")), lang, limits, out, rows_of).drop(lang)
