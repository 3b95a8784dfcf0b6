"""Spelling variant grouping by K-d trees over letter-count vectors (operator 11).

One edit changes the letter counts by at most two: a replaced letter takes one letter away and
adds another, an inserted one adds a letter.  For every word length there is a K-d tree over the
words' count vectors; a word searches the tree of its own length for vectors one up and one down,
and the tree of the next length for vectors one up.  Boxes that are out of reach are pruned, and
what the boxes leave is verified letter by letter, so the result is exact.

The top of a tree is fitted by Spark: a cell (leaf) of more than ``CELL`` words is split at the
letter count that halves it best, found from counts of all its words; what the driver holds is one
entry for each ``CELL`` words.  A word goes to the cells its search reaches, and each cell is a
group whose task builds the rest of the tree.  Between words of one length every pair is found
once: from the word that comes first in the tree's order.  Words with equal vectors can't be split;
they are compared block by block.

Vectors have ``DIMS`` counts, one for each letter a-z and six shared by the other letters, held at
``MOST`` at most; sharing and holding only bring vectors closer, so no pair is lost.

Defined cases: null and letterless texts have no words; a null id counts as an empty string; repeated
rows each count; very long words are ordinary; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
ERROR_RATE = 31
CELL = 1 << 16
LEAF = 32
DIMS = 32
MOST = 7
_FLUSH = 200_000  # words counted before they are passed on
_BLOCK = 1 << 14  # queries compared with a leaf at once
_PAIRS = 1 << 19  # candidates verified at once

# One byte a code point: A-Z to a-z, other letters stay, all else a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_DIM = np.array([b - 97 if 97 <= b <= 122 else 26 + b % (DIMS - 26) for b in range(256)], np.int64)


def runs(text: str | None) -> list[bytes]:
    """The runs ``[A-Za-z\\u00C0-\\u00FF]+`` of a text, A-Z lower-cased, in Latin-1."""
    return text.encode("latin-1", "replace").translate(LETTERS).split() if text else []


def misspelled(run: bytes, before: int) -> bytes:
    """The run, in some cases less one letter; ``before`` is the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
    if h % ERROR_RATE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """``word``, ``n``: the counts over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in found], pa.string()),
                                               pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                before = zlib.crc32(f"{'' if key is None else key}:".encode())
                for w, n in Counter(runs(text)).items():
                    if len(w) >= least and len(w := misspelled(w, before)) >= least:
                        found[w] += n
                if len(found) >= _FLUSH:
                    yield out()
                    found.clear()
        yield out()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def vectors(texts: list[bytes]) -> np.ndarray:
    """Letter counts, one row a word."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.repeat(np.arange(len(texts)) * DIMS, sizes) + _DIM[np.frombuffer(b"".join(texts), np.uint8)]
    return np.minimum(np.bincount(at, minlength=len(texts) * DIMS), MOST).astype(np.int8).reshape(-1, DIMS)


class Split:
    """A K-d tree: ``nodes[k]`` is (letter, count, left, right), words above the count go right, or None for a leaf."""

    def __init__(self, nodes: list | None = None):
        self.nodes = nodes or [None]

    def reached(self, vecs: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, in the tree's order, and the rows of ``vecs`` that may have a partner there: one with at most ``up``
        letters more and ``down`` fewer.  The letters of a path that need it differ, so the needs add up."""
        n = len(vecs)
        todo = [(0, np.arange(n), np.full(n, up, np.int8), np.full(n, down, np.int8))]
        while todo:
            k, rows, ups, downs = todo.pop()
            if self.nodes[k] is None:
                yield k, rows
                continue
            letter, count, left, right = self.nodes[k]
            c = vecs[rows, letter]
            for child, u, d in ((right, ups - np.maximum(count + 1 - c, 0), downs), (left, ups, downs - np.maximum(c - count, 0))):
                ok = (u >= 0) & (d >= 0)
                if ok.any():
                    todo.append((child, rows[ok], u[ok], d[ok]))

    def order(self) -> dict[int, int]:
        """The place of every leaf in the tree's order."""
        todo, out = [0], {}
        while todo:
            k = todo.pop()
            if self.nodes[k] is None:
                out[k] = len(out)
            else:
                todo += [self.nodes[k][3], self.nodes[k][2]]
        return out


def halving(vecs: np.ndarray) -> tuple[int, int, int]:
    """The letter and count that halve the words best, and how many are above."""
    above = np.stack([(vecs > c).sum(0) for c in range(MOST)])
    count, letter = divmod(int(np.abs(2 * above - len(vecs)).argmin()), DIMS)
    return letter, count, int(above[count, letter])


def fit_cells(counted: DataFrame, cell: int = CELL) -> dict[int, Split]:
    """The tops of the trees, by word length, of the lengths that have more than ``cell`` words."""
    large = counted.groupBy(F.length("word").alias("t")).count().where(F.col("count") > cell).collect()
    trees, open_ = {r["t"]: Split() for r in large}, {(r["t"], 0) for r in large}
    while open_:
        looked = frozenset(open_)

        def run(batches: Iterator[pa.RecordBatch], looked=looked) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            sizes: Counter[tuple[int, int]] = Counter()
            for b in batches:
                texts = [w.encode("latin-1") for w in b.column(0).to_pylist()]
                for t, some in _by_length(texts):
                    if t not in trees:
                        continue
                    vecs = vectors([texts[i] for i in some])
                    for leaf, rows in trees[t].reached(vecs, 0, 0):
                        if (t, leaf) in looked:
                            sums[t, leaf] = sums.get((t, leaf), 0) + np.stack([(vecs[rows] > c).sum(0) for c in range(MOST)])
                            sizes[t, leaf] += len(rows)
            for (t, leaf), above in sums.items():
                letter, count = np.tile(np.arange(DIMS), MOST), np.repeat(np.arange(MOST), DIMS)
                same = lambda x: np.full(MOST * DIMS, x)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (same(t), same(leaf), letter, count, above.ravel(), same(sizes[t, leaf]))],
                                                 names=["t", "leaf", "letter", "count", "above", "n"])

        sums = (counted.select("word").mapInArrow(run, "t long, leaf long, letter long, count long, above long, n long")
                .groupBy("t", "leaf", "letter", "count").agg(F.sum("above").alias("above"), F.sum("n").alias("n")))
        best = sums.groupBy("t", "leaf").agg(F.min_by(F.struct("letter", "count", "above", "n"), F.struct(F.abs(2 * F.col("above") - F.col("n")), "count", "letter")).alias("b"))
        open_ = set()
        for r in best.collect():  # one row for each cell that is still too large
            letter, count, above, n = r["b"]
            if 0 < above < n:
                nodes = trees[r["t"]].nodes
                nodes[r["leaf"]] = (letter, count, len(nodes), len(nodes) + 1)
                nodes += [None, None]
                open_ |= {(r["t"], k) for k, size in ((len(nodes) - 2, n - above), (len(nodes) - 1, above)) if size > cell}
    return trees


def _by_length(texts: list[bytes]) -> list[tuple[int, np.ndarray]]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return [(int(t), np.flatnonzero(sizes == t)) for t in np.unique(sizes)]


def routed(counted: DataFrame, trees: dict[int, Split]) -> DataFrame:
    """``t``, ``cell``, ``word``, ``n``, ``query``: every word in its cell of the tree of its length, and as a
    query in the other cells that its search reaches."""
    order = {t: tree.order() for t, tree in trees.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [w.encode("latin-1") for w in b.column(0).to_pylist()]
            for t, some in _by_length(texts):
                vecs = vectors([texts[i] for i in some])
                own = np.zeros(len(some), np.int64)
                for leaf, rows in trees.get(t, Split()).reached(vecs, 0, 0):
                    own[rows] = order[t][leaf] if t in trees else 0
                sent = [(t, own, some, np.zeros(len(some), bool))]
                for to, up, down in ((t, 1, 1), (t + 1, 1, 0)):
                    if to == t and t not in trees:
                        continue
                    for leaf, rows in trees.get(to, Split()).reached(vecs, up, down):
                        at = order[to][leaf] if to in trees else 0
                        if to == t:
                            rows = rows[own[rows] < at]
                        sent.append((to, np.full(len(rows), at), some[rows], np.ones(len(rows), bool)))
                for to, cell, rows, query in sent:
                    part = b.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), to), pa.int64()), pa.array(cell, pa.int64()), *part.columns, pa.array(query)],
                                                     names=["t", "cell", "word", "n", "query"])

    return counted.select("word", "n").mapInArrow(run, "t long, cell long, word string, n long, query boolean")


_GUARD = np.uint64(0x8888888888888888)


def _packed(vecs: np.ndarray) -> np.ndarray:
    """Counts as half bytes: two 64-bit integers a row."""
    halves = vecs.astype(np.uint8).reshape(-1, DIMS // 2, 2)
    return np.ascontiguousarray(halves[:, :, 0] | halves[:, :, 1] << 4).view(np.uint64)


def _letters(texts: list[bytes], size: int) -> np.ndarray:
    """The letters of words of one size, rows filled to whole 64-bit integers with zeros."""
    out = np.zeros((len(texts), -(-size // 8) * 8), np.uint8)
    if texts:
        out[:, :size] = np.frombuffer(b"".join(texts), np.uint8).reshape(-1, size)
    return out


def one_replaced(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of the pairs of rows (i, j) those that differ in exactly one letter."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    live, differ = np.arange(len(i)), np.zeros(len(i), np.int64)
    for k in range(a.shape[1]):
        x = a[i[live], k] ^ b[j[live], k]
        for s in (4, 2, 1):
            x |= x >> np.uint64(s)
        differ[live] += np.bitwise_count(x & np.uint64(0x0101010101010101))
        live = live[differ[live] <= 1]
    return live[differ[live] == 1]


def one_inserted(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
    """Of the pairs those where row j of ``b`` (of ``size`` letters) is row i of ``a`` with one more letter."""
    out = []
    step = max(1, (1 << 24) // size)
    for at in range(0, len(i), step):
        short, long = a[i[at:at + step], :size - 1], b[j[at:at + step], :size]
        head = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
        tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
        out.append(at + np.flatnonzero(head + tail >= size - 1))
    return np.concatenate(out) if out else np.empty(0, np.int64)


class Cell:
    """The words of one cell in a K-d tree; row numbers are those of the cell's table."""

    def __init__(self, texts: list[bytes], rows: np.ndarray, size: int, leaf: int = LEAF):
        vecs = vectors(texts)
        order, nodes, spans = np.arange(len(texts)), [None], {}
        todo = [(0, 0, len(texts))]
        while todo:
            k, lo, hi = todo.pop()
            some = order[lo:hi]
            letter, count, above = halving(vecs[some]) if hi - lo > leaf else (0, 0, 0)
            if not 0 < above < hi - lo:
                spans[k] = (lo, hi)
                continue
            right = vecs[some, letter] > count
            order[lo:hi] = np.concatenate([some[~right], some[right]])
            nodes[k] = (letter, count, len(nodes), len(nodes) + 1)
            nodes += [None, None]
            todo += [(len(nodes) - 1, hi - above, hi), (len(nodes) - 2, lo, hi - above)]
        self.tree, self.spans, self.size, self.rows = Split(nodes), spans, size, rows[order]
        self.vecs = vecs[order]
        self.packed, self.letters = _packed(self.vecs), _letters([texts[k] for k in order], size)

    def near(self, vecs: np.ndarray, letters: np.ndarray, longer: bool, among: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, place in the tree) at one edit, for queries of the same size or (``longer``: the tree's words
        are longer) one letter shorter.  ``among``: the queries are the tree's own words, in its order."""
        packed = self.packed if among else _packed(vecs)
        held, n = [], 0

        def verified() -> tuple[np.ndarray, np.ndarray]:
            i, j = (np.concatenate(x) for x in zip(*held))
            keep = one_inserted(letters, self.letters, i, j, self.size) if longer else one_replaced(letters, self.letters, i, j)
            return i[keep], j[keep]

        for leaf, queries in self.tree.reached(vecs, 1, 0 if longer else 1):
            lo, hi = self.spans[leaf]
            if among:
                queries = queries[queries < hi]
            for at in range(0, len(queries), _BLOCK):
                q = queries[at:at + _BLOCK]
                for start in range(lo, hi, LEAF):
                    stop = min(start + LEAF, hi)
                    # half bytes of the difference: 1 for a letter more, 15 for one fewer
                    bits = sum(np.bitwise_count(((packed[q, h] | _GUARD)[:, None] - self.packed[None, start:stop, h]) ^ _GUARD) for h in (0, 1))
                    i, j = np.nonzero(bits <= (4 if longer else 5))
                    i, j = q[i], j + start
                    if among:
                        later = i < j
                        i, j = i[later], j[later]
                    held.append((i, j))
                    n += len(i)
                    if n >= _PAIRS:
                        yield verified()
                        held, n = [], 0
        if held:
            yield verified()


def cell_neighbours(table: pa.Table) -> pa.Table:
    """``word``, ``near``, ``best_n``, ``best`` of the words that have near words in one cell."""
    size = table.column("t")[0].as_py()
    texts = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    n, query = table.column("n").to_numpy(), table.column("query").to_numpy()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    own = np.flatnonzero(~query)
    src, dst = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if len(own):
        cell = Cell([texts[k] for k in own], own, size)
        sides = [(cell.rows, cell.vecs, cell.letters, False, True)]
        for longer in (False, True):
            rows = np.flatnonzero(query & (lengths == size - longer))
            some = [texts[k] for k in rows]
            if some:
                sides.append((rows, vectors(some), _letters(some, size - longer), longer, False))
        for rows, vecs, letters, longer, among in sides:
            for i, j in cell.near(vecs, letters, longer, among):
                a, b = rows[i], cell.rows[j]
                src += [a, b]
                dst += [b, a]
    a, b = np.concatenate(src), np.concatenate(dst)
    place = np.empty(len(texts), np.int64)
    place[sorted(range(len(texts)), key=texts.__getitem__)] = np.arange(len(texts))
    by = np.lexsort((place[b], -n[b], a))
    a, b = a[by], b[by]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.empty(0, np.int64)
    word = table.column("word").combine_chunks()
    return pa.table({"word": word.take(pa.array(a[first])), "near": pa.array(np.diff(np.r_[first, len(a)]), pa.int64()),
                     "best_n": pa.array(n[b[first]], pa.int64()), "best": word.take(pa.array(b[first]))})


def neighbours(counted: DataFrame, cell: int = CELL) -> DataFrame:
    """``word``, ``n_near`` and the near word of largest count (ties: first in code-point order): ``best``, ``best_n``."""
    sent = routed(counted, fit_cells(counted, cell))
    found = sent.groupBy("t", "cell").applyInArrow(cell_neighbours, "word string, near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), top.alias("top"))
            .select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.m")).alias("best_n")))


def roots(links: DataFrame) -> DataFrame:
    """``word``, ``root`` from ``word``, ``form``: pointers doubled until they rest.  A form's count is ``RATIO``
    times its word's, so chains are no longer than the logarithm of the largest count."""
    now = written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        to = now.select(F.col("word").alias("via"), F.col("root").alias("next"))
        then = written(now.join(to, F.col("root") == F.col("via"), "left")
                       .select("word", F.coalesce("next", "root").alias("root"), F.col("via").isNotNull().alias("moved")), "spelling-roots")
        now = then.drop("moved")
        if not then.where("moved").limit(1).count():
            return now


def variants(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word."""
    counted = written(words(docs), "spelling-words")
    near = neighbours(counted, cell)
    is_form = F.col("best_n") >= RATIO * F.col("n")
    formed = written(counted.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    rooted = roots(formed.where("form is not null"))
    return (formed.join(rooted, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
