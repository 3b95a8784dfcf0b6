"""Token ids in binary shards compressed by a Re-Pair grammar (operator 5).

Documents are encoded, each closed by an end id, and written in ascending doc_id order as
shards of bounded size.  A shard's ids are compressed by Re-Pair: round after round the
most frequent pairs of neighbouring symbols become rules (nonterminals), chosen so that
occurrences of different pairs never overlap, until no pair occurs often enough to pay for its
rule.  A shard row holds the rules, the expansion length of every rule
and the compressed sequence, so any range of ids is decoded alone (``read_range``).

The file format is a Parquet table of shard rows, its binary columns little-endian
unsigned 32-bit integers: rules (left, right per rule), lengths (per rule), symbols and
doc_tokens (ids per document); symbols below ``base`` are ids, others base + rule.

Defined cases: null and empty texts are the end id alone; null doc_ids come first; rows
with the same doc_id are ordered by text hash, fully equal rows in any order; repeated
rows each get their ids; an empty table writes no shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .bpe import Encoder, Vocabulary
from .common import written

END_ID = 2
LEAST = 4  # a rule takes three integers and saves one at each place: with fewer places it would not pay
_HASH_BITS = 20
_SORTED = 1 << 17  # fewer pairs than this are counted by sorting
_AT_ONCE = 1 << 18  # pairs hashed at a time, in little memory
_LINKED = 16  # symbols to a place that is looked at, from which on the symbols are linked
_MIX = np.array([0x9E3779B1, 0x85EBCA77], np.uint32)


def _choose(codes: np.ndarray, counts: np.ndarray, most: int, least: int) -> np.ndarray:
    """The places in ``codes`` of up to ``most`` frequent pairs, by descending count, in which no symbol is both a
    left and a right member; a pair of one symbol with itself shares it with no other pair.  Ascending by pair."""
    best = np.lexsort((codes, -counts))[:4 * most]
    best = best[counts[best] >= least]
    first, second = codes[best] >> np.uint64(32), codes[best] & np.uint64(0xFFFFFFFF)
    left, right, chosen = set(), set(), []
    for i, a, b in zip(best.tolist(), first.tolist(), second.tolist()):
        if len(chosen) == most:
            break
        if a in right or b in left or a == b and a in left:
            continue
        left.add(a)
        right.add(b)
        chosen.append(i)
    found = np.array(chosen, np.int64)
    return found[np.argsort(codes[found])]


def _counted(left: np.ndarray, right: np.ndarray, mix: np.ndarray, per_round: int,
             least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of the places of the round's pairs, their pair's number, the pairs, whether each index may still pay).

    Many pairs are counted by a hash of ``_HASH_BITS``, some at a time: the pair last seen in a slot stands for the
    slot, the heaviest slots give the round's pairs, and only the places in their slots are compared with them.
    A pair that turns out to occur too seldom is left out.  Few pairs, or where that shows none, are counted by sorting."""
    alive = None
    if len(left) > _SORTED:
        slots = np.empty(len(left), np.uint32)
        heavy, last = np.zeros(1 << _HASH_BITS, np.int32), np.zeros(1 << _HASH_BITS, np.int32)
        parts = [slice(a, min(a + _AT_ONCE, len(left))) for a in range(0, len(left), _AT_ONCE)]
        for part in parts:
            slot = np.multiply(left[part], mix[0], out=slots[part])  # wraps
            slot += right[part] * mix[1]
            slot >>= np.uint32(32 - _HASH_BITS)
            slot = slot.astype(np.intp)
            np.add.at(heavy, slot, np.int32(1))
            last[slot] = np.arange(part.start, part.stop, dtype=np.int32)
        pays = heavy >= least
        weights = heavy[pays]
        bar = int(np.partition(weights, -2 * per_round)[-2 * per_round]) if len(weights) >= 2 * per_round else least
        top = np.flatnonzero(heavy >= bar)
        stands = _codes(left[last[top]], right[last[top]])
        chosen = _choose(stands, heavy[top], per_round, least)
        stand_left, stand_right = left[last[top[chosen]]], right[last[top[chosen]]]
        kind = np.where(pays, np.int32(-1), np.int32(-2))
        kind[top[chosen]] = np.arange(len(chosen), dtype=np.int32)
        alive, index, number = np.empty(len(left), bool), [], []
        for part in parts:
            own = kind.take(slots[part])
            np.greater(own, -2, out=alive[part])
            at = np.flatnonzero(own >= 0)
            own = own[at]
            same = (left[part][at] == stand_left[own]) & (right[part][at] == stand_right[own])
            index.append(at[same] + part.start)
            number.append(own[same])
        at, own = np.concatenate(index), np.concatenate(number)
        often = np.bincount(own, minlength=len(chosen)) >= least
        if often.any():
            if not often.all():
                ok = often[own]
                at, own = at[ok], (np.cumsum(often, dtype=np.int32) - np.int32(1))[own[ok]]
            return at, own, stands[chosen][often], alive
    at = np.arange(len(left)) if alive is None else np.flatnonzero(alive)
    pairs, number, counts = np.unique(_codes(left[at], right[at]), return_inverse=True, return_counts=True)
    alive = np.zeros(len(left), bool)
    alive[at[counts[number] >= least]] = True
    chosen = _choose(pairs, counts, per_round, least)
    rule_of = np.full(len(pairs), -1, np.int32)
    rule_of[chosen] = np.arange(len(chosen))
    own = rule_of[number]
    hit = np.flatnonzero(own >= 0)
    return at[hit], own[hit], pairs[chosen], alive


def _codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left.astype(np.uint64)
    out <<= np.uint64(32)
    out |= right
    return out


def compress(ids: np.ndarray, base: int, per_round: int = 8192, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules as rows of left and right, expansion length per rule).

    A round replaces up to ``per_round`` pairs; rounds go on until no pair occurs ``least`` times.  A pair arises
    only beside a place that a round replaces, with all its places at once, and is found less and less often
    from then on: a round looks at the places whose pair may still pay and at those beside the last replacements.
    While these are many, the symbols are moved together after a round; later they are linked."""
    seq = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    n_rules, mix = 0, _MIX.copy()

    def chosen_places(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the places of the round's pairs, their symbols, whether each place may still pay)."""
        nonlocal n_rules, mix
        index, number, pairs, alive = _counted(left, right, mix, per_round, least)
        mix = mix * _MIX[::-1] | np.uint32(1)  # other pairs share a slot in the next round
        found = number.astype(np.uint32)
        found += np.uint32(base + n_rules)
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        n_rules += len(pairs)
        return index, found, alive

    def without_overlap(at: np.ndarray, found: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Only a run of one symbol can overlap itself: every other place counts, from the left."""
        if not follows.any():
            return at, found
        run = np.maximum.accumulate(np.where(np.concatenate([[True], ~follows]), np.arange(len(at)), 0))
        ok = (np.arange(len(at)) - run) % 2 == 0
        return at[ok], found[ok]

    open_ = np.arange(max(len(seq) - 1, 0))  # places whose pair may pay, ascending
    left, right = seq[:-1], seq[1:]
    while _LINKED * len(open_) > len(seq):
        index, found, alive = chosen_places(left, right)
        if not len(index):
            open_ = open_[:0]
            break
        at = open_[index]
        at, found = without_overlap(at, found, at[:-1] + 1 == at[1:])
        held, kept = np.zeros(len(seq), bool), np.ones(len(seq), bool)
        held[open_[alive]] = True
        held[at] = True
        held[at[at > 0] - 1] = True
        kept[at + 1] = False
        seq[at] = found
        seq, held = seq[kept], held[kept]
        held[-1] = False  # the last symbol has no pair
        open_ = np.flatnonzero(held)
        left, right = seq.take(open_), seq.take(open_ + 1)
    n = len(seq)
    seq = np.append(seq, np.uint32(0))
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    while len(open_):
        index, found, alive = chosen_places(left, right)
        if not len(index):
            break
        at = open_[index]
        at, found = without_overlap(at, found, after[at[:-1]] == at[1:])
        gone = after[at]
        beyond = after[gone]
        seq[at] = found
        after[at] = beyond
        before[beyond] = at
        after[gone] = -1
        beside = before[at]
        beside = beside[beside >= 0]
        open_ = np.sort(np.concatenate([open_[alive], at, beside]))
        open_ = open_[np.concatenate([[True], open_[1:] != open_[:-1]]) & (after[open_] >= 0) & (open_ != before[n])]
        left, right = seq[open_], seq[after[open_]]
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    lengths = np.ones(base + len(table), np.int64)
    first = 0
    for r in rules:  # a round's rules use ids and earlier rules only
        part = r.astype(np.int64)
        lengths[base + first:base + first + len(r)] = lengths[part[:, 0]] + lengths[part[:, 1]]
        first += len(r)
    return seq[:n][after[:n] >= 0], table, lengths[base:].astype(np.uint32)


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Expansion length per rule; a rule uses ids and earlier rules only."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((1 if a < base else out[a - base]) + (1 if b < base else out[b - base]))
    return np.array(out, np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids that ``symbols`` stand for.  For many symbols every rule is expanded once and its ids are copied to
    each place, unless all rules together have many more ids than there are symbols."""
    size = np.ones(base + len(rules), np.int64)
    size[base:] = rule_lengths(rules, base) if lengths is None else lengths
    left, right = np.ascontiguousarray(rules[:, 0]), np.ascontiguousarray(rules[:, 1])
    if len(symbols) <= len(size) or int(size.sum()) > 4 * len(symbols):
        return _placed(symbols, left, right, base, size)
    table = _placed(np.arange(len(size), dtype=symbols.dtype), left, right, base, size)
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)]) * table.itemsize
    copies = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(table)])
    return np.frombuffer(copies.take(pa.array(symbols)).buffers()[2], symbols.dtype)


def _placed(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, base: int, size: np.ndarray) -> np.ndarray:
    """The ids that ``symbols`` stand for; each member of a rule is put down at its own place."""
    place = np.cumsum(size[symbols])
    out = np.empty(int(place[-1]) if len(place) else 0, symbols.dtype)
    place -= size[symbols]
    while len(symbols):
        rule = symbols >= base
        plain = ~rule
        out[place[plain]] = symbols[plain]
        number, place = symbols[rule] - np.array(base, symbols.dtype), place[rule]
        first = left[number]
        symbols, place = np.concatenate([first, right[number]]), np.concatenate([place, place + size[first]])
    return out


def read_range(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a shard: only the symbols that cover the range are expanded."""
    size = np.ones(len(symbols), np.int64)
    rule = symbols >= base
    size[rule] = lengths[(symbols[rule] - base).astype(np.int64)]
    ends = np.cumsum(size)
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    skip = start - (int(ends[a - 1]) if a else 0)
    return expand(symbols[a:b], rules, base, lengths)[skip:skip + stop - start]


def _u32(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4")


def shard_schema(doc_id: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
        T.StructField("base", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(doc_id)),
        *[T.StructField(c, T.BinaryType()) for c in ("doc_tokens", "rules", "lengths", "symbols")]])


# PATTERN, written so that the library's matcher never goes back over a run
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


class LibraryEncoder(Encoder):
    """The same ids with a library's merges: tiktoken takes the vocabulary as ranks, which are its ids."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary)
        special = {t.encode() for t in vocabulary.special}
        ranks = {t: i for i, t in enumerate(vocabulary.tokens) if t not in special}
        self.library = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.opens = np.array([t[:1] == b" " for t in vocabulary.tokens])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text.  Texts that single spaces part are cut there and each distinct piece is encoded once;
        the library takes the others whole."""
        out: list[bytes | None] = [None] * len(texts)
        cut = []
        for i, t in enumerate(texts):
            if self.special and self.special.search(t):
                out[i] = self._with_special(t)
            elif self.within_run.search(t):
                out[i] = self._ids_of(t)
            else:
                cut.append(i)
        for i, ids in zip(cut, self._by_piece([texts[i] for i in cut])):
            out[i] = ids
        return out

    def _by_piece(self, texts: list[str]) -> Iterator[bytes]:
        if not texts:
            return
        pieces = pc.split_pattern(pa.array(texts, pa.string()), " ")
        first = pieces.offsets.to_numpy()[:-1].astype(np.int64)
        coded = pieces.flatten().dictionary_encode()
        known = coded.dictionary
        # joined by spaces, pieces are pre-tokens of their own unless white space meets: a token that
        # begins with a space begins the next piece, which has no other space
        edged = pc.or_(pc.equal(known, ""), pc.not_equal(known, pc.utf8_trim_whitespace(known))).to_numpy(zero_copy_only=False)
        plain = known.filter(pa.array(~edged))
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), plain), " ")[0].as_py()
        joined = np.frombuffer(self._ids_of(" " + whole), "<u4") if len(plain) else np.zeros(0, np.uint32)
        sizes = np.diff(np.append(np.flatnonzero(self.opens[joined]), len(joined)))
        # then the other pieces after a space, and those that begin a text
        alone = [np.frombuffer(self._ids_of(p), "<u4") for p in [*(" " + p for p in known.filter(pa.array(edged)).to_pylist()),
                                                                 *(t.partition(" ")[0] for t in texts)]]
        table = np.concatenate([joined, *alone]).astype("<u4", copy=False)
        sizes = np.concatenate([sizes, np.array([len(x) for x in alone], np.int64)])
        row = np.where(edged, len(plain) + np.cumsum(edged) - 1, np.cumsum(~edged) - 1)
        at = row[coded.indices.to_numpy()]
        at[first] = len(sizes) - len(texts) + np.arange(len(texts))
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)]) * 4
        rows = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(table)]).take(pa.array(at))
        ids = rows.buffers()[2].to_pybytes() if len(table) else b""
        cut = np.frombuffer(rows.buffers()[1], np.int64, len(rows) + 1)[np.append(first, len(rows))].tolist()
        yield from (ids[a:b] for a, b in zip(cut, cut[1:]))

    def _ids_of(self, text: str) -> bytes:
        try:
            return self.library.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        except ValueError:  # white space of a million characters is too much for the library's pattern
            return super().encode([text])[0]

    def _with_special(self, text: str) -> bytes:
        out, rest = [], 0
        for m in self.special.finditer(text):
            out += [self._ids_of(text[rest:m.start()]), np.array([self.v.special[m[0]]], "<u4").tobytes()]
            rest = m.end()
        return b"".join([*out, self._ids_of(text[rest:])])


def write_shards(docs: DataFrame, path: str, vocabulary_path: str, shard_tokens: int = 1 << 22) -> None:
    """Encode ``docs`` and write shards of about ``shard_tokens`` ids to ``path``."""
    vocabulary = Vocabulary(vocabulary_path)
    ordered = (docs.select("doc_id", "text").withColumn("h", F.xxhash64("text"))
               .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h"))
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = LibraryEncoder(vocabulary)
        part, shard = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        names: list[pa.Array] = []
        size = 0

        def flush() -> pa.RecordBatch:
            counts = np.array([len(h) // 4 for h in held], "<u4")
            ids = _u32(b"".join(held))
            held.clear()
            symbols, rules, lengths = compress(ids, vocabulary.size)
            doc_ids = pa.concat_arrays(names)
            one = lambda x: pa.array([x.astype("<u4").tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([vocabulary.size], pa.int64()),
                 pa.array([len(ids)], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                 one(counts), one(rules), one(lengths), one(symbols)],
                names=["part", "shard", "base", "n_tokens", "doc_ids", "doc_tokens", "rules", "lengths", "symbols"])

        for whole in batches:
            step = max(1, int(whole.num_rows * (4 << 20) / max(whole.nbytes, 1)))
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                for k, ids in enumerate(encoder.encode([t or "" for t in b.column(1).to_pylist()])):
                    held.append(ids + end)
                    names.append(b.column(0).slice(k, 1))
                    size += len(held[-1]) // 4
                    if size >= shard_tokens:
                        yield flush()
                        held, names, size, shard = [], [], 0, shard + 1
        if held:
            yield flush()

    ordered.mapInArrow(run, shard_schema(docs.schema["doc_id"].dataType)).write.parquet(path)


def read_documents(shards: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` of
    every document, decoded from a table of shards."""
    sizes = shards.select("part", "shard", "n_tokens")
    # parts are as many as the write had tasks; shards are summed up within their part
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    inside = sizes.select("part", "shard", (F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard"))
                                            - F.col("n_tokens")).alias("before_shard"))
    # one small row per shard, written so that Spark knows its size and need not shuffle the shards for it
    starts = written(inside.join(before, "part").select("part", "shard", (F.col("before_part") + F.col("before_shard")).alias("first")), "shard-starts")
    kind = shards.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                doc_ids = b.column(1).slice(i, 1).flatten()
                first, base = b.column(0)[i].as_py(), b.column(2)[i].as_py()
                counts, rules, lengths, symbols = (_u32(b.column(c)[i].as_py()) for c in (3, 4, 5, 6))
                ids = expand(symbols, rules.reshape(-1, 2), base, lengths).astype("<u4")
                ends = np.cumsum(counts.astype(np.int64))
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * a:4 * e]) for a, e in zip(ends - counts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(first + ends - counts, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    out = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()),
                        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    return (shards.select("part", "shard", "doc_ids", "base", "doc_tokens", "rules", "lengths", "symbols").join(starts, ["part", "shard"])
            .select("first", "doc_ids", "base", "doc_tokens", "rules", "lengths", "symbols").mapInArrow(run, out))
