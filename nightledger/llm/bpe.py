"""Byte-level BPE encoding and decoding with an automaton lexicon (operator 8).

The frequent words of the corpus (counted over all documents) are encoded once and
compiled to a minimal acyclic transducer: words share prefixes and, by merging equal
states, suffixes; arc outputs add up to a word's number, which points to its ids.  The
automaton is a flat file that Spark ships to the executors, where tasks memory-map it and
walk it for many words at once.  Words it does not hold are merged exactly, also many at
once: in every round each word applies its lowest-ranked pair at all its places.

Results equal the tokenizers library with ``add_special_tokens=False``: special-token
strings in a text become their ids; decoding joins the tokens' bytes and replaces
malformed UTF-8.

Defined cases: null and empty texts give an empty id list and an empty decoded text;
repeated documents each get a row; an empty table gives an empty result (and an empty
automaton); very long words are merged with a heap instead of in rounds; null ids never
occur; ids outside the vocabulary raise.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import byte_texts, written

# The pre-token pattern of the byte-level vocabulary and its white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Single spaces cut a text into pieces that are pre-tokenized alone, unless a space has
# white space on both sides (a run is then split before its last character only).
WITHIN_RUN = f"[{SPACES}] [{SPACES}]"
MARKS = frozenset(".,;:!?")
LONG_WORD = 256
NONE = np.int64(1) << 60


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merges and special tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        ids = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens: list[bytes] = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for t, i in ids.items():
            self.tokens[i] = t.encode() if t in self.special else bytes(letters[c] for c in t)
        for t, i in self.special.items():
            self.tokens[i] = t.encode()
        self.size = len(self.tokens)
        of_byte = {t: i for i, t in enumerate(self.tokens) if len(t) == 1}
        self.byte_ids = np.array([of_byte[bytes([b])] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        codes = np.array([ids[a] * self.size + ids[b] for a, b in merges], np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        self.table = PairTable(codes)
        self.ranks = {int(c): r for r, c in reversed(list(enumerate(codes)))}
        self.special_pattern = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))


class PairTable:
    """Pair code to merge rank: two-choice hashing, so many codes are looked up by two reads each."""

    BITS = 18
    FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

    def __init__(self, codes: np.ndarray):
        while len(codes) > (1 << self.BITS) // 4:
            self.BITS += 1
        self.codes = np.full((2, 1 << self.BITS), -1, np.int64)
        self.ranks = np.full((2, 1 << self.BITS), NONE, np.int64)
        slots = [self._slot(codes, k) for k in (0, 1)]
        owner: list[dict[int, int]] = [{}, {}]
        for r in range(len(codes)):
            at, side = r, 0
            for _ in range(500):
                slot = int(slots[side][at])
                other = owner[side].get(slot)
                owner[side][slot] = at
                if other is None or codes[other] == codes[at]:
                    break
                at, side = other, 1 - side
            else:
                raise ValueError("pairs do not fit the table")
        for side in (0, 1):
            for slot, r in owner[side].items():
                self.codes[side, slot], self.ranks[side, slot] = codes[r], r

    def _slot(self, codes: np.ndarray, side: int) -> np.ndarray:
        return ((codes.astype(np.uint64) * self.FACTORS[side]) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def rank(self, codes: np.ndarray) -> np.ndarray:
        a = self._slot(codes, 0)
        out = np.where(self.codes[0][a] == codes, self.ranks[0][a], NONE)
        left = np.flatnonzero(out == NONE)
        b = self._slot(codes[left], 1)
        out[left] = np.where(self.codes[1][b] == codes[left], self.ranks[1][b], NONE)
        return out


def merge_long(v: Vocabulary, word: bytes) -> list[int]:
    """Exact merges of one word with a heap of pairs, in n log n."""
    sym = v.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    n = len(sym)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    rank = lambda i: v.ranks.get(sym[i] * v.size + sym[after[i]]) if after[i] >= 0 else None
    heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := rank(i)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if sym[i] != a or j < 0 or sym[j] != b:
            continue
        sym[i], sym[j] = int(v.merged[r]), -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and (x := rank(k)) is not None:
                heapq.heappush(heap, (x, k, sym[k], sym[after[k]]))
    return [s for s in sym if s >= 0]


def merge_words(v: Vocabulary, words: list[bytes]) -> list[bytes]:
    """Exact merges of many words at once; each word's ids as little-endian 32-bit integers."""
    long = {i: np.array(merge_long(v, w), "<u4").tobytes() for i, w in enumerate(words) if len(w) > LONG_WORD}
    sizes = np.array([0 if i in long else len(w) for i, w in enumerate(words)], np.int64)
    sym = v.byte_ids[np.frombuffer(b"".join(w for i, w in enumerate(words) if i not in long), np.uint8)]
    word = np.repeat(np.arange(len(words)), sizes)
    done_sym, done_word = [], []
    while len(sym):
        rank = np.full(len(sym), NONE, np.int64)
        pair = np.flatnonzero(word[:-1] == word[1:])
        rank[pair] = v.table.rank(sym[pair] * v.size + sym[pair + 1])
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        lowest = np.minimum.reduceat(rank, first)
        count = np.diff(np.append(first, len(sym)))
        low = np.repeat(lowest, count)
        open_ = low < NONE
        if not open_.all():
            done_sym.append(sym[~open_])
            done_word.append(word[~open_])
            sym, word, rank, low = sym[open_], word[open_], rank[open_], low[open_]
            if not len(sym):
                break
        hit = rank == low
        # of pairs that overlap (a a a), every other one counts, from the left
        at = np.arange(len(sym))
        start = np.maximum.accumulate(np.where(hit, -1, at))
        hit &= (at - start) % 2 == 1
        sym = np.where(hit, v.merged[np.minimum(low, len(v.merged) - 1)], sym)
        keep = np.concatenate([[True], ~hit[:-1]])
        sym, word = sym[keep], word[keep]
    sym, word = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_sym, done_word))
    order = np.argsort(word, kind="stable")
    flat = sym[order].astype("<u4").tobytes()
    cut = [0, *(np.cumsum(np.bincount(word, minlength=len(words))) * 4).tolist()]
    parts = [flat[a:b] for a, b in zip(cut, cut[1:])]
    return [long.get(i, p) for i, p in enumerate(parts)] if long else parts


class Lexicon:
    """A minimal acyclic transducer over bytes, in flat arrays.

    ``keys`` holds every arc as state * 256 + byte in ascending order, ``target`` the state it
    leads to, ``add`` its output; a word's number is the sum of the outputs on its path and
    selects a slice of ``ids``.
    """

    ARRAYS = ("keys", "target", "add", "final", "first", "ids")
    flat: bytes | None = None  # the ids as little-endian 32-bit integers, and where each word's begin
    cut: list[int]

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, words: dict[bytes, bytes]) -> Lexicon:
        """Sorted insertion: states of the last word that can take no more arcs are merged with an equal state."""
        register: dict[tuple, int] = {}
        arcs: list[dict[int, int]] = []
        final: list[bool] = []

        def settle(node: tuple[bool, dict[int, int]]) -> int:
            key = (node[0], *node[1].items())
            if key not in register:
                register[key] = len(arcs)
                arcs.append(node[1])
                final.append(node[0])
            return register[key]

        path: list[list] = [[False, {}]]  # of the last word: its states that are still open
        last = b""
        ordered = sorted(words)
        for w in [*ordered, b""]:
            same = 0
            while same < min(len(w), len(last)) and w[same] == last[same]:
                same += 1
            for at in range(len(last), same, -1):
                node = path.pop()
                path[at - 1][1][last[at - 1]] = settle((node[0], node[1]))
            path += [[False, {}] for _ in w[same:]]
            if w:
                path[-1][0] = True
            last = w
        root = settle((path[0][0], path[0][1]))
        # states are numbered children first: the words below a state are counted in one pass
        below: list[int] = []
        keys, target, add = [], [], []
        for s, out in enumerate(arcs):
            n = int(final[s])
            for b, t in out.items():
                keys.append(s * 256 + b)
                target.append(t)
                add.append(n)
                n += below[t]
            below.append(n)
        ids = [np.frombuffer(words[w], "<u4") for w in ordered]
        return cls({"keys": np.array(keys, np.int64), "target": np.array(target, np.int64),
                    "add": np.array(add, np.int64), "final": np.array([*final, root], np.int64),
                    "first": np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64),
                    "ids": np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int64)})

    def to_bytes(self) -> bytes:
        sizes = np.array([len(getattr(self, a)) for a in self.ARRAYS], "<i8")
        return sizes.tobytes() + b"".join(getattr(self, a).astype("<i8").tobytes() for a in self.ARRAYS)

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        """The automaton as a view on a memory-mapped file."""
        data = np.memmap(path, "<i8", mode="r")
        cut = np.cumsum([len(cls.ARRAYS), *data[:len(cls.ARRAYS)]])
        return cls({a: data[cut[i]:cut[i + 1]] for i, a in enumerate(cls.ARRAYS)})

    def number(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, -1 where the automaton does not hold it; all words take a step at once."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.keys):
            return out
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        start = np.cumsum(sizes) - sizes
        live = np.flatnonzero(sizes > 0)
        state = np.full(len(live), self.final[-1], np.int64)
        total = np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            key = state * 256 + text[start[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            live, arc, total = live[ok], arc[ok], total[ok] + self.add[arc[ok]]
            state = self.target[arc]
            step += 1
            ended = sizes[live] == step
            held = ended & (self.final[state] == 1)
            out[live[held]] = total[held]
            live, state, total = live[~ended], state[~ended], total[~ended]
        return out

    def ids_of(self, number: int) -> bytes:
        if self.flat is None:
            self.flat, self.cut = self.ids.astype("<u4").tobytes(), (self.first * 4).tolist()
        return self.flat[self.cut[number]:self.cut[number + 1]]


class Encoder:
    """Text to ids.  Pieces between single spaces are looked up in a bounded memory of pieces
    already seen; the new ones of a batch are pre-tokenized, found in the lexicon or merged together.
    A full memory is put aside, and pieces that come again return from there."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None = None, memory: int = 200_000):
        self.v, self.lexicon, self.memory = vocabulary, lexicon, memory
        self.pattern = regex.compile(PATTERN)
        self.within_run = re.compile(WITHIN_RUN)
        self.special = re.compile(vocabulary.special_pattern) if vocabulary.special else None
        self.marks = {m: np.uint32(vocabulary.byte_ids[ord(m)]).tobytes() for m in MARKS}
        self.seen: dict[str, bytes] = {}     # piece after a space -> ids as little-endian 32-bit integers
        self.other: dict[str, bytes] = {}    # the same for pre-tokens and pieces without the space
        self.aside: dict[str, dict[str, bytes]] = {" ": {}, "": {}}  # the full memories before, by the lead

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of single pre-tokens: from the lexicon, else merged together."""
        if self.lexicon is None:
            return merge_words(self.v, words)
        numbers = self.lexicon.number(words).tolist()
        merged = iter(merge_words(self.v, [w for w, n in zip(words, numbers) if n < 0]))
        return [self.lexicon.ids_of(n) if n >= 0 else next(merged) for n in numbers]

    def learn(self, memory: dict[str, bytes], lead: str, new: set[str]) -> None:
        """Add pieces to ``memory``; they start a word (or are one whole run of the text)."""
        marked = [p for p in new if p[-1:] in MARKS and p[:-1].isalpha()]
        new.difference_update(marked)
        new.update({p[:-1] for p in marked}.difference(memory))
        plain = [p for p in new if p.isalpha()]
        memory.update(zip(plain, self._ids([(lead + p).encode() for p in plain])))
        odd = list(new.difference(plain))
        cut = [self.pattern.findall(lead + p) for p in odd]
        # a pre-token is a piece of its own: many are known
        ids = {t: self.seen.get(t[1:]) if t[0] == " " else self.other.get(t) for c in cut for t in c}
        tokens = [t for t, known in ids.items() if known is None]
        for t, new_ids in zip(tokens, self._ids([t.encode() for t in tokens])):
            ids[t] = new_ids
            (self.seen if t[0] == " " else self.other)[t[t[0] == " ":]] = new_ids
        memory.update((p, b"".join([ids[t] for t in c])) for p, c in zip(odd, cut))
        memory.update((p, memory[p[:-1]] + self.marks[p[-1]]) for p in marked)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        plans = [self.plan(t) for t in texts]
        for memory, lead in ((self.seen, " "), (self.other, "")):
            if len(memory) > self.memory:
                self.aside[lead] = memory.copy()
                memory.clear()
            used = (part[1] for p in plans for part in p if type(part) is tuple and part[0] is memory)
            new, aside = set().union(*used).difference(memory), self.aside[lead]
            again = new.intersection(aside)
            memory.update(zip(again, map(aside.__getitem__, again)))
            self.learn(memory, lead, new.difference(again))
        return [self.joined(p) for p in plans]

    @staticmethod
    def joined(plan: list) -> bytes:
        return b"".join([part if type(part) is bytes else b"".join(map(part[0].__getitem__, part[1])) for part in plan])

    def plan(self, text: str) -> list:
        """A text as ids (of special tokens) and lists of pieces, each with the memory that it is found in."""
        plan: list = []
        rest = 0
        for m in self.special.finditer(text) if self.special else ():
            plan += [*self._pieces(text[rest:m.start()]), np.uint32(self.v.special[m[0]]).tobytes()]
            rest = m.end()
        return plan + self._pieces(text[rest:] if rest else text)

    def _pieces(self, text: str) -> list:
        if not text:
            return []
        if self.within_run.search(text):
            return [(self.other, self.pattern.findall(text))]
        first, *rest = text.split(" ")
        return [(self.other, [first] if first else []), (self.seen, rest)]


def decode(v: Vocabulary, ids: bytes) -> str:
    return b"".join(map(v.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", errors="replace")


# --- Spark side ---------------------------------------------------------------

LETTERS = bytes(b if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def frequent_words(docs: DataFrame, size: int) -> list[str]:
    """The most frequent runs of letters, counted over all documents: all above the lowest count
    (on a scale of sixteenths of an octave) that at most ``size`` of them reach."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()

        def flush():
            words = pa.array([w.decode(errors="replace") for w in n], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(n.values(), pa.int64())], names=["word", "n"])

        for b in batches:
            for text in byte_texts(b):
                if text:
                    n.update(text.translate(LETTERS).split())
            if len(n) > 200_000:
                yield flush()
                n.clear()
        yield flush()

    counts = written(docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
                     .where(F.length("word") <= 64), "word-counts")
    # words by sixteenths of an octave of their count: at most 1,024 rows
    octave = F.floor(F.log2("n") * 16)
    bins = counts.groupBy(octave.alias("o")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).collect()
    bar, held = None, 0
    for b in sorted(bins, key=lambda b: -b["o"]):
        held += b["words"]
        if held > size:
            break
        bar = b["least"]
    return [r["word"] for r in counts.where(F.col("n") >= bar).select("word").collect()] if bar else []


def ship(spark: SparkSession, data: bytes, name: str) -> str:
    """Put a small file into the shared folder and let Spark hand it to every executor; its name there."""
    name = f"{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'files')}/{name}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(target)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    spark.sparkContext.addFile(fs.makeQualified(target).toString())
    return name


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, size: int) -> str:
    """Compile the frequent words (each after a space) and ship the automaton; its file name."""
    words = [(" " + w).encode() for w in frequent_words(docs, size)]
    lexicon = Lexicon.compile(dict(zip(words, merge_words(vocabulary, words))))
    return ship(docs.sparkSession, lexicon.to_bytes(), "lexicon")


def encode_documents(docs: DataFrame, vocabulary_path: str, lexicon_size: int = 50_000) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` (the text that the ids decode to) of every document."""
    vocabulary = Vocabulary(vocabulary_path)
    docs = docs.select("doc_id", "text")
    lexicon = build_lexicon(docs, vocabulary, lexicon_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, Lexicon.mapped(SparkFiles.get(lexicon)))
        for whole in batches:
            step = max(1, int(whole.num_rows * (2 << 20) / max(whole.nbytes, 1)))
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                ids = encoder.encode([t or "" for t in b.column(1).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(pa.array(offsets), values),
                     pa.array([decode(vocabulary, x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
