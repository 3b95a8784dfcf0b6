"""Benchmark decontamination by suffix arrays over shards of the documents (operator 10).

Every task cuts its documents into shards of about ``shard_bytes`` of text, numbers the
words that occur in the benchmark and builds the shard's word-level suffix array.  The
suffixes are bucketed first by their leading words: a bucket that no test suffix can
reach is dropped unsorted, which loses no match.  All test suffixes (cut at the window
length) are then binary-searched in the array at once; the ranges give every occurrence,
and occurrences on one diagonal join to maximal verbatim matches with their locations.

The benchmark is taken in blocks of at most ``block_bytes`` of text (a longer single item
is its own block), each sent to the tasks on its own, so the size of what is broadcast
is bounded whatever the size of the benchmark; the documents pass through block after block.

Defined cases: null and empty texts have no words and are never contaminated; items
without words match nothing; an item of fewer words than the window is one window; repeated
documents each get their row; repeated items (same id) count once by id; a null item id
is left out of the item list but its words count as hit; empty tables give no rows, or
rows without hits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import alnum_words, byte_texts, free_name, sliced

WINDOW = 13
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_starts", T.ArrayType(T.LongType())),    # disjoint runs of hit words
    T.StructField("hit_ends", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()), T.StructField("item_start", T.LongType()),
        T.StructField("doc_start", T.LongType()), T.StructField("n_words", T.LongType())])))])
FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()), ("hit_starts", pa.list_(pa.int64())), ("hit_ends", pa.list_(pa.int64())),
    ("items", pa.list_(pa.string())),
    ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()),
                                    ("doc_start", pa.int64()), ("n_words", pa.int64())])))])
KEY = np.dtype(">u4")


class Block:
    """The test suffixes of some benchmark items, ready to be searched."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        items = [x for x in items if x[1]]
        self.window = window
        self.ids = [i for i, _ in items]
        self.vocabulary = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(w for _, w in items)), 1)}
        numbered = [np.array([self.vocabulary[w] for w in words], np.int64) for _, words in items]
        # one test suffix per window: (words, length) -> the places it has in the items
        places: dict[bytes, list[tuple[int, int]]] = {}
        for k, words in enumerate(numbered):
            n = min(window, len(words))
            for at in range(len(words) - n + 1):
                places.setdefault(words[at:at + n].astype(KEY).tobytes(), []).append((k, at))
        self.suffixes = list(places)
        self.lengths = np.array([len(s) // 4 for s in places], np.int64)
        counts = np.array([len(p) for p in places.values()], np.int64)
        flat = list(chain.from_iterable(places.values()))
        self.place_item = np.array([k for k, _ in flat], np.int64)
        self.place_start = np.array([at for _, at in flat], np.int64)
        self.place_first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        # places of whole windows as positions in all items, one item behind the other with a gap between them:
        # the suffix that stands at each position (-1: none)
        self.item_first = np.cumsum([1, *(len(w) + 1 for w in numbered)])[:-1].astype(np.int64)
        self.position = (self.item_first[self.place_item] if len(flat) else self.place_item) + self.place_start
        suffix = np.repeat(np.arange(len(counts)), counts)
        whole = self.lengths[suffix] == window
        self.suffix_at = np.full(sum(len(w) + 1 for w in numbered) + 2, -1, np.int64)
        self.suffix_at[self.position[whole]] = suffix[whole]
        # leading word pairs (single words for one-word suffixes) that a test suffix starts with
        base = len(self.vocabulary) + 1
        heads = [np.frombuffer(s, KEY)[:2].astype(np.int64) for s in self.suffixes]
        self.pairs = np.unique(np.array([h[0] * base + h[1] for h in heads if len(h) > 1], np.int64))
        self.singles = np.zeros(base, bool)
        self.singles[[h[0] for h in heads if len(h) == 1]] = True
        # pairs that occur anywhere in a window at least 4 words long: the second bucket level
        tails = [np.frombuffer(s, KEY)[2:4].astype(np.int64) for s in self.suffixes if len(s) >= 16]
        self.second = np.unique(np.array([t[0] * base + t[1] for t in tails], np.int64))
        self.short = bool((self.lengths[self.lengths > 1] < 4).any())

    def _among(self, codes: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(codes), bool)
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        return known[at] == codes

    def suffix_array(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted suffixes (as fixed-width keys of ``window`` words) of the reachable buckets, and their places."""
        base = len(self.vocabulary) + 1
        ahead = np.concatenate([words, np.zeros(max(self.window, 4), words.dtype)])
        n = len(words)
        at = np.flatnonzero((words > 0) & (ahead[1:n + 1] > 0))
        at = at[self._among(words[at] * base + ahead[at + 1], self.pairs)]
        if not self.short:
            third, fourth = ahead[at + 2], ahead[at + 3]
            ok = (third > 0) & (fourth > 0)
            at, third, fourth = at[ok], third[ok], fourth[ok]
            at = at[self._among(third * base + fourth, self.second)]
        if self.singles.any():
            at = np.union1d(at, np.flatnonzero(self.singles[words]))
        keys = ahead[at[:, None] + np.arange(self.window)].astype(KEY)
        keys = np.ascontiguousarray(keys).view(f"S{4 * self.window}").ravel()
        order = np.argsort(keys, kind="stable")
        return keys[order], at[order]

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(suffix, place) of every occurrence of every test suffix in ``words`` (0: any other word or a gap)."""
        keys, places = self.suffix_array(words)
        if not len(keys) or not self.suffixes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        width = 4 * self.window
        low = np.array(self.suffixes, f"S{width}")
        high = np.array([s + b"\xff" * (width - len(s)) for s in self.suffixes], f"S{width}")
        left, right = np.searchsorted(keys, low, "left"), np.searchsorted(keys, high, "right")
        counts = right - left
        which = np.repeat(np.arange(len(low)), counts)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        return which, places[left[which] + inside]

    def scan(self, texts: list[bytes | None]) -> list[dict]:
        """What one shard's documents hold of the items, one result per document."""
        get = self.vocabulary.get
        split = [alnum_words(t) for t in texts]
        sizes = np.array([len(s) for s in split], np.int64)
        # documents stand one behind the other with a gap (0) between them
        ends = np.cumsum(sizes + 1)
        starts = ends - sizes - 1
        words = np.fromiter(chain.from_iterable(chain((get(w, 0) for w in s), (0,)) for s in split),
                            np.int64, int(ends[-1]) if len(ends) else 0)
        which, place = self.search(words)
        out = [{"n_words": int(n), "hit_starts": [], "hit_ends": [], "items": [], "matches": []} for n in sizes]
        if not len(which):
            return out
        # hit words: the union of all occurrences
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, place, 1)
        np.add.at(change, place + self.lengths[which], -1)
        hit = np.diff(np.concatenate([[0], (np.cumsum(change) > 0).astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)):
            d = int(np.searchsorted(ends, a, "right"))
            out[d]["hit_starts"].append(int(a - starts[d]))
            out[d]["hit_ends"].append(int(b - starts[d]))
        for place, position, length in (self._short_matches(which, place), self._window_matches(which, place)):
            item = np.searchsorted(self.item_first, position, "right") - 1
            doc = np.searchsorted(ends, place, "right")
            order = np.lexsort((place, place - position, item, doc))
            for k in order.tolist():
                d, name = int(doc[k]), self.ids[item[k]]
                out[d]["matches"].append({"item_id": name, "item_start": int(position[k] - self.item_first[item[k]]),
                                          "doc_start": int(place[k] - starts[d]), "n_words": int(length[k])})
                if name is not None:
                    out[d]["items"].append(name)
        return out

    def _places(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix its places in the items: (index into ``which``, position)."""
        n = self.place_first[which + 1] - self.place_first[which]
        each = np.repeat(np.arange(len(which)), n)
        at = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + self.place_first[which[each]]
        return each, self.position[at]

    def _short_matches(self, which: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, position, length) of the occurrences of items shorter than the window: each is a match."""
        short = self.lengths[which] < self.window
        which, place = which[short], place[short]
        each, position = self._places(which)
        return place[each], position, self.lengths[which[each]]

    def _window_matches(self, which: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, position, length) of the maximal matches of whole windows.  A match starts at an occurrence and
        one of its places in the items if the words before them are no occurrence together, and ends likewise.
        Which places these are depends on the suffixes at two neighbouring places only, so it is worked out once
        for each two suffixes that follow each other, and not for every occurrence and place."""
        whole = np.flatnonzero(self.lengths[which] == self.window)
        whole = whole[np.argsort(place[whole], kind="stable")]
        which, place = which[whole], place[whole]  # one suffix at each place
        edges = []
        for step in (-1, 1):
            beside = np.full(len(which), -2, np.int64)
            follows = place[1:] == place[:-1] + 1
            if step < 0:
                beside[1:][follows] = which[:-1][follows]
            else:
                beside[:-1][follows] = which[1:][follows]
            pairs, kind = np.unique(np.stack([which, beside], 1), axis=0, return_inverse=True)
            kind = kind.reshape(-1)
            each, position = self._places(pairs[:, 0])
            edge = self.suffix_at[position + step] != pairs[each, 1]
            each, position = each[edge], position[edge]
            first = np.searchsorted(each, np.arange(len(pairs) + 1))
            n = (first[1:] - first[:-1])[kind]
            at = np.repeat(np.arange(len(which)), n)
            inside = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            position, at = position[first[kind[at]] + inside], place[at]
            order = np.lexsort((at, at - position))
            edges.append((at[order], position[order]))
        # along a diagonal starts and ends take turns
        (at, position), (last, _) = edges
        return at, position, last - at + self.window


def merge(old: dict | None, new: dict) -> dict:
    """The findings of two benchmark blocks in one document."""
    spans = sorted(zip(new["hit_starts"], new["hit_ends"]))
    if old:
        spans = sorted([*spans, *zip(old["hit_starts"], old["hit_ends"])])
    joined: list[list[int]] = []
    for a, b in spans:
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(b, joined[-1][1])
        else:
            joined.append([a, b])
    return {"n_words": new["n_words"], "hit_starts": [a for a, _ in joined], "hit_ends": [b for _, b in joined],
            "items": sorted({*new["items"], *(old["items"] if old else ())}),
            "matches": [*(old["matches"] if old else ()), *new["matches"]]}


def blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items, read partition by partition, in blocks of bounded size."""
    held, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).toLocalIterator():
        text = (r["t"] or "").encode()
        if held and size + len(text) > block_bytes:
            yield held
            held, size = [], 0
        held.append((r["i"], alnum_words(text)))
        size += len(text)
    yield held


def _task(block: Block, column: str, shard_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sliced(batches, shard_bytes):
            shard = table.combine_chunks().to_batches()
            for b in shard:
                at = b.schema.get_field_index(column)
                found = block.scan(byte_texts(b))
                old = b.column(at).to_pylist()
                rows = [merge(o, n) for o, n in zip(old, found)]
                yield b.set_column(at, pa.field(column, FOUND_ARROW), pa.array(rows, FOUND_ARROW))
    return run


def find(docs: DataFrame, benchmark: DataFrame, column: str, window: int = WINDOW,
         block_bytes: int = 4 << 20, shard_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with the struct ``column`` of findings (fields of ``FOUND``) added."""
    out = docs.withColumn(column, F.lit(None).cast(FOUND))
    schema = T.StructType([*docs.schema.fields, T.StructField(column, FOUND)])
    for items in blocks(benchmark, block_bytes):
        out = out.mapInArrow(_task(Block(items, window), column, shard_bytes), schema)
    return out


def n_hit(column: str) -> Column:
    ends, starts = F.col(f"{column}.hit_ends"), F.col(f"{column}.hit_starts")
    return F.aggregate(F.zip_with(ends, starts, lambda b, a: b - a), F.lit(0).cast("long"), lambda s, x: s + x)


def contaminated(column: str) -> Column:
    """A hit, and at least a twentieth of the words hit."""
    return (n_hit(column) > 0) & (20 * n_hit(column) >= F.col(f"{column}.n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: counts, items, verdict, longest match and all maximal matches."""
    f = find(docs.select("doc_id", "text"), benchmark, "found", **options)
    return f.select(
        "doc_id", F.col("found.n_words").alias("n_words"), n_hit("found").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"), F.col("found.items").alias("items"),
        contaminated("found").alias("contaminated"),
        F.coalesce(F.array_max("found.matches.n_words"), F.lit(0)).alias("longest"),
        F.col("found.matches").alias("matches"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    column = free_name(docs, "found")
    return find(docs, benchmark, column, **options).where(~contaminated(column)).drop(column)
