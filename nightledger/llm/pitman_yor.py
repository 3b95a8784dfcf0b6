"""Language-model scoring by a hierarchical Pitman-Yor model (operator 2).

Every word is a context with a Chinese restaurant of the words that follow it; all context
restaurants share one parent restaurant of single words, whose own base is uniform over
the vocabulary and one unknown word.  The seating (how many tables serve a word) is sampled
by Gibbs sweeps; ``SAMPLES`` states give predictive probabilities that are averaged.

    P(w|u) = (c_uw - d t_uw) / (theta + c_u) + (theta + d t_u) / (theta + c_u) * P(w)

A sweep reseats all restaurants at once against the table totals of the sweep before;
the parent's customers are the tables of its children.

How the work is laid out: documents form blocks of about ``BLOCK_BYTES`` of text, written
once with their words numbered per block.  Three exchanges follow, each of packed arrays
that a block sends to buckets and gets back in the same order: (1) words by hash: counts
and global numbers; (2) pairs by context: counts and tables of each sampled state; (3)
words again: the parent's customers and tables.  A block sends each distinct word or pair
once, so nothing grows with a word's frequency; a context of more than ``CONTEXT_PART``
tokens is split over several buckets by the following word.  Words are told apart by
64-bit hashes (for a billion words, a chance of about 3 % that any two fall together).

Defined cases: null and empty texts are the end token alone; a null doc_id counts as the
text '' (held out); repeated rows are scored alike and each counts as training text; with no
training tokens all counts are 0 and the score is that of the uniform base; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_texts, sliced, space_words, written

BLOCK_BYTES = 3 << 20
BUCKET_ENTRIES = 500_000
JOINT = 4096                         # bytes of arrays that are compressed in one piece
CONTEXT_PART = 1 << 22
DISCOUNT, STRENGTH = 0.8, 1.0        # of the context restaurants
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 1.0
BURN_IN, SAMPLES = 2, 3
SMALL = 12                           # words with more customers are reseated as a whole
END, START = 0, -1                   # the end token's word hash; the context of a first word
SEED = 20_240
PACKED = "none"                      # tables of packed arrays: a codec would only hold buffers outside the heap


# --- packed arrays ---------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays, the bytes of equal weight together, compressed: small ones in one piece."""
    planes, head = [], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes.append(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if len(a) else b"")
        head += [ord(a.dtype.char), len(a)]
    if sum(map(len, planes)) < JOINT:
        planes = [b"".join(planes)]
    data = [zstandard.ZstdCompressor(level=1).compress(p) for p in planes]
    return b"".join([np.array([len(arrays), len(data), *head, *map(len, data)], "<u4").tobytes(), *data])


def unpack(data: bytes) -> list[np.ndarray]:
    n, pieces = np.frombuffer(data, "<u4", 2).tolist()
    head = np.frombuffer(data, "<u4", 2 * n + pieces, 8).tolist()
    kinds, sizes = [np.dtype(chr(c)) for c in head[:2 * n:2]], head[1:2 * n:2]
    at, raw = 8 + 4 * len(head), []
    weights = [k.itemsize * m for k, m in zip(kinds, sizes)]
    for size, most in zip(head[2 * n:], weights if pieces == n else [sum(weights)]):
        raw.append(zstandard.ZstdDecompressor().decompress(data[at:at + size], max_output_size=max(most, 1)))
        at += size
    whole, at, out = b"".join(raw), 0, []
    for kind, m, weight in zip(kinds, sizes, weights):
        planes = np.frombuffer(whole, np.uint8, weight, at).reshape(kind.itemsize, m)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += weight
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    """Nonnegative integers in the smallest type that holds them."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 256 else np.uint16 if top < 65_536 else np.uint32 if top < 1 << 32 else np.uint64)


def steps(a: np.ndarray) -> np.ndarray:
    """Differences of neighbours (the first from 0)."""
    return np.diff(a, prepend=np.zeros(1, a.dtype))


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Equal ranges of the hash, in ascending order."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


# --- seating ------------------------------------------------------------------------

def _reseat_small(labels: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """One Gibbs sweep over the customers of words with ``c`` customers each (rows); tables per row.
    ``labels`` holds every customer's table; ``a`` the weight of a new table."""
    n, c = labels.shape
    rows = np.arange(n)
    sizes = np.zeros((n, c), np.int64)
    np.add.at(sizes, (np.repeat(rows, c), labels.ravel()), 1)
    for j in range(c):
        sizes[rows, labels[:, j]] -= 1
        taken = sizes > 0
        weight = np.where(taken, sizes - d, 0.0)
        edge = np.cumsum(weight, axis=1)
        r = rng.random(n) * (edge[:, -1] + a)
        new = r >= edge[:, -1]
        pick = np.where(new, np.argmin(taken, axis=1), np.argmax(edge > r[:, None], axis=1))
        labels[:, j] = pick
        sizes[rows, pick] += 1
    return (sizes > 0).sum(1)


def _reseat_whole(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of words whose customers all sit down anew: one after the other at first, then in
    growing groups that see the tables at the group's start."""
    t, seated = np.ones(len(c), np.int64), np.ones(len(c), np.int64)
    live = np.flatnonzero(seated < c)
    while len(live):
        group = np.minimum(np.maximum(seated[live] // 8, 1), c[live] - seated[live])
        p = a[live] / (a[live] + np.maximum(seated[live] - d * t[live], 1e-9))
        t[live] += rng.binomial(group, np.clip(p, 0, 1))
        seated[live] += group
        live = live[seated[live] < c[live]]
    return t


def seat(c: np.ndarray, context: np.ndarray, p: np.ndarray, parts: np.ndarray, d: float, theta: float,
         rng: np.random.Generator) -> list[np.ndarray]:
    """Sampled table counts for words with ``c`` customers in restaurants ``context``; ``p`` is the
    parent's probability of the word, ``parts`` by how many buckets a restaurant is shared."""
    t = (c > 0).astype(np.int64)
    groups = []
    for k in range(2, SMALL + 1):
        at = np.flatnonzero(c == k)
        if len(at):
            groups.append((at, np.zeros((len(at), k), np.int64)))
    large = np.flatnonzero(c > SMALL)
    out = []
    for sweep in range(BURN_IN + SAMPLES):
        tables = np.bincount(context, t, len(parts)) * parts
        a = (theta + d * tables[context]) * p
        for at, labels in groups:
            t[at] = _reseat_small(labels, a[at], d, rng)
        if len(large):
            t[large] = _reseat_whole(c[large], a[large], d, rng)
        if sweep >= BURN_IN:
            out.append(t.copy())
    return out


# --- blocks ----------------------------------------------------------------------------

def build_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of documents: tokens as numbers of the block's words, which stand in order of their hashes."""
    docs = docs.select("doc_id", "text", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0).alias("held"))
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(kind)),
                           T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("train_docs", T.LongType()),
                           *[T.StructField(c, T.BinaryType()) for c in ("held", "sizes", "tokens", "words")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for table in sliced(batches, BLOCK_BYTES):
            b = table.combine_chunks().to_batches()
            for part in b:
                split = [space_words(t, lower=True) for t in byte_texts(part)]
                sizes = np.array([len(s) + 1 for s in split], np.int64)
                held = np.array(part.column(2).to_pylist(), bool)
                known = list(dict.fromkeys(chain.from_iterable(split)))
                hashes = np.array([END, *(xxhash.xxh64_intdigest(w) | 1 for w in known)], np.uint64)
                order = np.argsort(hashes)
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                index = dict(zip(known, place[1:].tolist()))
                end = int(place[0])
                tokens = np.fromiter(chain.from_iterable(chain(map(index.__getitem__, s), (end,)) for s in split),
                                     np.int64, int(sizes.sum()))
                counts = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(order))
                one = lambda x: pa.array([x], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), part.column(0)),
                     pa.array([len(order)], pa.int64()), pa.array([len(tokens)], pa.int64()), pa.array([int((~held).sum())], pa.int64()),
                     one(pack(held.astype(np.uint8))), one(pack(narrow(sizes))), one(pack(narrow(tokens))),
                     one(pack(steps(hashes[order]), narrow(counts)))],
                    names=[f.name for f in schema])
                number += 1

    return docs.mapInArrow(run, schema)


SENT = "block long, bucket int, data binary"
BACK = "block long, bucket int, data binary, x double, y double, z double"  # with a bucket's totals in one of its rows


def _rows(rows: list[tuple], totals: tuple[float, ...] = ()) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[], [], []]
    out = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary()))]
    names = ["block", "bucket", "data"]
    if totals:
        out += [pa.array([v] + [0.0] * (len(rows) - 1), pa.float64()) for v in totals]
        names += ["x", "y", "z"]
    return pa.Table.from_arrays(out, names=names)


OWN, WORDS, PAIRS, PARENTS, IDS = range(5)  # rows of a block: its own arrays, what came back from each exchange, its documents


def _gathered(blocks: DataFrame, *back: DataFrame) -> DataFrame:
    """The rows of each block: its own arrays and what came back to it.  Grouped, they meet one block at a time, so
    that a task holds one block's arrays however many blocks it gets."""
    own = blocks.select("block", F.lit(OWN).alias("kind"), F.posexplode(F.array("held", "sizes", "tokens")).alias("bucket", "data"))
    out = own.select("block", "kind", "bucket", "data")
    for kind, rows in zip((WORDS, PAIRS, PARENTS), back):
        out = out.unionByName(rows.select("block", F.lit(kind).alias("kind"), "bucket", "data"))
    return out


def _of_block(table: pa.Table) -> tuple[int, dict[int, list[bytes]], list[int]]:
    """(block, data of each kind by bucket, buckets of its words) of a block's group."""
    by: dict[int, list[tuple[int, bytes]]] = {k: [] for k in (OWN, WORDS, PAIRS, PARENTS, IDS)}
    for kind, bucket, data in zip(*(table[c].to_pylist() for c in ("kind", "bucket", "data"))):
        by[kind].append((bucket, data))
    found = {k: sorted(rows, key=lambda x: x[0]) for k, rows in by.items()}
    return table["block"][0].as_py(), {k: [d for _, d in rows] for k, rows in found.items()}, [b for b, _ in found[WORDS]]


def _totals(back: DataFrame) -> tuple[float, float, float]:
    r = back.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in "xyz"]).first()
    return r[0], r[1], r[2]


# Exchange 1: words.

def send_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                hashes, counts = unpack(data)
                hashes = np.cumsum(hashes)
                to = bucket_of(hashes, buckets)
                cut = np.searchsorted(to, np.arange(buckets + 1))
                yield from _rows([(block, k, pack(steps(hashes[s:e]), counts[s:e])) for k, (s, e) in enumerate(zip(cut, cut[1:]))
                                  if e > s]).to_batches()
    return run


def merge_words(table: pa.Table) -> pa.Table:
    """Global numbers and counts of a bucket's words; totals: words seen in training, their tokens."""
    bucket = table["bucket"][0].as_py()
    sent = [unpack(d) for d in table["data"].to_pylist()]
    words, at = np.unique(np.concatenate([np.cumsum(s[0]) for s in sent]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([s[1] for s in sent]).astype(np.float64), len(words)).astype(np.int64)
    cut = np.cumsum([0, *(len(s[0]) for s in sent)])
    rows = [(b, bucket, pack(steps(at[s:e].astype(np.int64)), narrow(counts[at[s:e]])))
            for b, s, e in zip(table["block"].to_pylist(), cut, cut[1:])]
    return _rows(rows, (float((counts > 0).sum()), float(counts.sum()), 0.0))


# A block's view of its words and pairs.

class View:
    """A block's arrays, rebuilt from its row and what came back from the first exchange."""

    def __init__(self, held: bytes, sizes: bytes, tokens: bytes, words: list[bytes], buckets1: list[int], start_count: int):
        self.held = unpack(held)[0].astype(bool)
        self.sizes = unpack(sizes)[0].astype(np.int64)
        tokens = unpack(tokens)[0].astype(np.int64)
        parts = [unpack(w) for w in words]
        self.ranks = [np.cumsum(p[0]) for p in parts]
        self.buckets = buckets1
        self.number = np.concatenate([(np.int64(k) << 32) + r for k, r in zip(buckets1, self.ranks)])
        self.count = np.concatenate([p[1].astype(np.int64) for p in parts])
        # contexts: a word's place + 1, or 0 before the first word of a document
        before = np.concatenate([[0], tokens[:-1] + 1])
        before[np.cumsum(self.sizes)[:-1]] = 0
        n = len(self.count)
        pairs, self.pair_of, = np.unique(before * n + tokens, return_inverse=True)
        self.u, self.w = pairs // n, pairs % n
        train = np.repeat(~self.held, self.sizes)
        self.own = np.bincount(self.pair_of, train, len(pairs)).astype(np.int64)
        self.tokens = tokens
        self.context_number = np.concatenate([[START], self.number])
        self.context_count = np.concatenate([[start_count], self.count])

    def routes(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the pairs that can have been seen: (pair, bucket) by bucket, and the (context, bucket) headers by bucket."""
        parts = -(-self.context_count // CONTEXT_PART)
        seen = np.flatnonzero((self.count[self.w] > 0) & (self.context_count[self.u] > 0))
        u = self.u[seen]
        mix = lambda x: (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        part = (mix(self.number[self.w[seen]]) % np.maximum(parts[u], 1).astype(np.uint64)).astype(np.int64)
        home = mix(self.context_number + 2).astype(np.int64)
        to = (home[u] + part) % buckets
        order = np.argsort(to.astype(np.int32), kind="stable")
        contexts = np.unique(u)
        each = np.minimum(parts[contexts], buckets)
        hu = np.repeat(contexts, each)
        inside = np.arange(len(hu)) - np.repeat(np.cumsum(each) - each, each)
        hto = (home[hu] + inside) % buckets
        horder = np.argsort(hto.astype(np.int32), kind="stable")
        return seen[order], to[order], hu[horder], hto[horder]


# Exchange 2: pairs.

def send_pairs(buckets: int, train_tokens: float, start_count: int):
    def run(table: pa.Table) -> pa.Table:
        block, data, words_in = _of_block(table)
        v = View(*data[OWN], data[WORDS], words_in, start_count)
        pair, to, hu, hto = v.routes(buckets)
        cut, hcut = (np.searchsorted(x, np.arange(buckets + 1)) for x in (to, hto))
        level = np.clip(np.round(-8 * np.log2(np.maximum(v.count, 1) / max(train_tokens, 1))), 0, 255).astype(np.uint8)
        rows = []
        for k in range(buckets):
            s, e, hs, he = cut[k], cut[k + 1], hcut[k], hcut[k + 1]
            if he > hs:
                p, h = pair[s:e], hu[hs:he]
                words, place = np.unique(v.w[p], return_inverse=True)
                rows.append((block, k, pack(
                    steps(v.context_number[h]), narrow(-(-v.context_count[h] // CONTEXT_PART)),
                    narrow(np.diff(np.searchsorted(v.u[p], np.append(h, len(v.context_count))))),
                    steps(v.number[words]), narrow(place), narrow(v.own[p]), level[words])))
        return _rows(rows)
    return run


def merge_pairs(table: pa.Table) -> pa.Table:
    """Counts and sampled tables of a bucket's pairs, sent back in the order they came in; one of the
    blocks that hold a pair is its owner."""
    bucket = table["bucket"][0].as_py()
    sent = [unpack(d) for d in table["data"].to_pylist()]
    heads = [np.cumsum(s[0]) for s in sent]
    contexts, head_at = np.unique(np.concatenate(heads), return_inverse=True)
    parts = np.zeros(len(contexts), np.int64)
    np.maximum.at(parts, head_at, np.concatenate([s[1] for s in sent]).astype(np.int64))
    per_head = np.concatenate([s[2] for s in sent]).astype(np.int64)
    context = np.repeat(head_at, per_head)
    words, word_at = np.unique(np.concatenate([np.cumsum(s[3])[s[4]] for s in sent]), return_inverse=True)
    pairs, first, at = np.unique(context * max(len(words), 1) + word_at, return_index=True, return_inverse=True)
    c = np.bincount(at, np.concatenate([s[5] for s in sent]).astype(np.float64), len(pairs)).astype(np.int64)
    p = np.exp2(-np.concatenate([s[6][s[4]] for s in sent])[first] / 8.0)
    own_context = pairs // max(len(words), 1)
    tables = seat(c, own_context, p, parts, DISCOUNT, STRENGTH, np.random.default_rng([SEED, 2, bucket]))
    totals = [np.bincount(own_context, t, len(contexts)).astype(np.int64) for t in tables]
    owner = np.zeros(len(at), np.uint8)
    owner[first] = 1
    cut, hcut = np.cumsum([0, *(len(s[4]) for s in sent)]), np.cumsum([0, *(len(h) for h in heads)])
    rows = []
    for i, block in enumerate(table["block"].to_pylist()):
        a, h = at[cut[i]:cut[i + 1]], head_at[hcut[i]:hcut[i + 1]]
        more = a[c[a] > 1]  # of the others the tables are as many as the customers
        rows.append((block, bucket, pack(narrow(c[a]), owner[cut[i]:cut[i + 1]], *(narrow(t[more]) for t in tables),
                                         *(narrow(t[h]) for t in totals))))
    return _rows(rows)


class Pairs:
    """A block's pairs with the counts and tables that came back."""

    def __init__(self, v: View, buckets: int, back: list[bytes]):
        pair, _, hu, _ = v.routes(buckets)
        parts = [unpack(d) for d in back]
        join = lambda i: np.concatenate([p[i] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
        self.c = np.zeros(len(v.u), np.int64)
        self.c[pair] = join(0)
        more = self.c[pair] > 1
        self.owner = np.zeros(len(v.u), bool)
        self.owner[pair] = join(1) == 1
        self.t = []
        self.context_tables = []
        for s in range(SAMPLES):
            t = self.c.copy()
            t[pair[more]] = join(2 + s)
            self.t.append(t)
            self.context_tables.append(np.bincount(hu, join(2 + SAMPLES + s), len(v.context_count)))


# Exchange 3: the parent restaurant.

def send_parents(buckets2: int, start_count: int):
    def run(table: pa.Table) -> pa.Table:
        block, data, words_in = _of_block(table)
        v = View(*data[OWN], data[WORDS], words_in, start_count)
        pairs = Pairs(v, buckets2, data[PAIRS])
        new = [np.bincount(v.w, t * pairs.owner, len(v.count)).astype(np.int64) for t in pairs.t]
        cut = np.cumsum([0, *(len(x) for x in v.ranks)])
        return _rows([(block, k, pack(steps(rank), *(narrow(n[s:e]) for n in new)))
                      for k, rank, s, e in zip(v.buckets, v.ranks, cut, cut[1:])])
    return run


def merge_parents(vocabulary: float):
    base = 1.0 / (vocabulary + 1)

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        sent = [unpack(d) for d in table["data"].to_pylist()]
        words, at = np.unique(np.concatenate([np.cumsum(s[0]) for s in sent]), return_inverse=True)
        rng = np.random.default_rng([SEED, 3, bucket])
        customers, tables = [], []
        for i in range(SAMPLES):
            c = np.bincount(at, np.concatenate([s[1 + i] for s in sent]).astype(np.float64), len(words)).astype(np.int64)
            # one restaurant over all buckets: its table total is close to the vocabulary
            a = np.full(len(c), (ROOT_STRENGTH + ROOT_DISCOUNT * vocabulary) * base)
            t = np.where(c > 0, _reseat_whole(np.maximum(c, 1), a, ROOT_DISCOUNT, rng), 0)
            customers.append(c)
            tables.append(t)
        cut = np.cumsum([0, *(len(s[0]) for s in sent)])
        rows = [(b, bucket, pack(*(narrow(x[at[s:e]]) for x in (*customers, *tables))))
                for b, s, e in zip(table["block"].to_pylist(), cut, cut[1:])]
        out = _rows(rows, (0.0, 0.0, 0.0))
        for i in range(SAMPLES):  # a state's totals: customers in x, y, z of row i's field
            out = out.append_column(f"c{i}", pa.array([float(customers[i].sum())] + [0.0] * (len(rows) - 1), pa.float64()))
            out = out.append_column(f"t{i}", pa.array([float(tables[i].sum())] + [0.0] * (len(rows) - 1), pa.float64()))
        return out.drop_columns(["x", "y", "z"])
    return run


PARENT_BACK = SENT + "".join(f", c{i} double, t{i} double" for i in range(SAMPLES))


def score_blocks(buckets2: int, start_count: int, train_tokens: float, vocabulary: float, states: list[tuple[float, float]], out: T.StructType):
    def run(table: pa.Table) -> pa.Table:
        ids = table["doc_ids"].combine_chunks().drop_null().flatten()  # one row of the group has them
        _, data, words_in = _of_block(table)
        v = View(*data[OWN], data[WORDS], words_in, start_count)
        pairs = Pairs(v, buckets2, data[PAIRS])
        parent = [unpack(d) for d in data[PARENTS]]
        cu = v.context_count[v.u]
        p = np.zeros(len(v.u))
        for s, (customers, tables) in enumerate(states):
            c0, t0 = (np.concatenate([x[k] for x in parent]).astype(np.float64) for k in (s, SAMPLES + s))
            root = (ROOT_STRENGTH + ROOT_DISCOUNT * tables) / (ROOT_STRENGTH + customers) / (vocabulary + 1)
            single = (c0 - ROOT_DISCOUNT * t0) / (ROOT_STRENGTH + customers) + root
            seen = (pairs.c - DISCOUNT * pairs.t[s]) / (STRENGTH + cu)
            rest = (STRENGTH + DISCOUNT * pairs.context_tables[s][v.u]) / (STRENGTH + cu)
            p += seen + rest * single[v.w]
        logs = np.log10(p / len(states))[v.pair_of]
        base = np.log10((v.count + 0.1) / (train_tokens + 0.1 * (vocabulary + 1)))[v.tokens]
        start = np.cumsum(v.sizes) - v.sizes
        per = lambda x: np.add.reduceat(x, start)  # noqa: E731 - every document has its end token
        return pa.Table.from_arrays(
            [ids, pa.array(v.held), pa.array(v.sizes), pa.array(per((v.count[v.tokens] > 0).astype(np.int64))),
             pa.array(np.full(len(v.sizes), int(train_tokens))), pa.array(per(base)), pa.array(per(logs))], names=[f.name for f in out])
    return run


def score(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every document."""
    blocks = written(build_blocks(docs), "lm-blocks", PACKED)
    kind = blocks.schema["doc_ids"].dataType.elementType
    out = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()),
                        *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
                        *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]])
    sizes = blocks.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum("train_docs"), F.count(F.lit(1))).first()
    if sizes[0] is None:
        return docs.sparkSession.createDataFrame([], out)
    words_n, pairs_n = (max(1, -(-int(n) // BUCKET_ENTRIES)) for n in sizes[:2])
    start_count = int(sizes[2])

    sent = blocks.select("block", "words").mapInArrow(send_words(words_n), SENT)
    words = written(sent.groupBy("bucket").applyInArrow(merge_words, BACK), "lm-words", PACKED)
    vocabulary, train_tokens, _ = _totals(words)

    sent = _gathered(blocks, words).groupBy("block").applyInArrow(send_pairs(pairs_n, train_tokens, start_count), SENT)
    pairs = written(sent.groupBy("bucket").applyInArrow(merge_pairs, SENT), "lm-pairs", PACKED)

    sent = _gathered(blocks, words, pairs).groupBy("block").applyInArrow(send_parents(pairs_n, start_count), SENT)
    parents = written(sent.groupBy("bucket").applyInArrow(merge_parents(vocabulary), PARENT_BACK), "lm-parents", PACKED)
    t = parents.agg(*[F.sum(f"{c}{i}") for i in range(SAMPLES) for c in "ct"]).first()
    states = [(t[2 * i], t[2 * i + 1]) for i in range(SAMPLES)]
    rows = _gathered(blocks, words, pairs, parents).unionByName(
        blocks.select("block", F.lit(IDS).alias("kind"), F.lit(0).alias("bucket"), "doc_ids"), allowMissingColumns=True)
    return rows.groupBy("block").applyInArrow(score_blocks(pairs_n, start_count, train_tokens, vocabulary, states, out), out)
