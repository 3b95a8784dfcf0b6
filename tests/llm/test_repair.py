import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from nightledger.llm import repair
from nightledger.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("ids", [
    [], [5], [5, 5], [7] * 1001, [1, 2] * 500, [1, 2, 1, 2, 1] * 300,
    np.random.default_rng(1).integers(0, 4, 20_000).tolist(), np.random.default_rng(2).integers(0, 50_000, 5000).tolist()])
def test_round_trip_and_ranges(ids):
    ids = np.array(ids, np.uint32)
    symbols, rules, lengths = repair.compress(ids, 50_257, per_round=64, least=2)
    assert (repair.expand(symbols, rules, 50_257) == ids).all()
    assert [len(repair.expand(np.array([50_257 + i], np.uint32), rules, 50_257)) for i in range(min(len(rules), 50))] == lengths[:50].tolist()
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2))
        assert (repair.read_range(symbols, rules, lengths, 50_257, a, b) == ids[a:b]).all()


def test_frequent_pairs_shrink_the_sequence():
    ids = np.array([1, 2, 3, 4] * 1000, np.uint32)
    symbols, rules, _ = repair.compress(ids, 50_257)
    assert len(symbols) < 100 and len(rules) < 40


def expected(pairs):
    t = Tokenizer.from_file(PATH)
    at, out = 0, []
    for i, text in pairs:
        x = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    return out


def test_query_matches_the_library(spark, sf_small, small_docs):
    want = expected(sorted((r["doc_id"], r["text"]) for r in small_docs.collect()))
    assert sorted(tuple(r) for r in QUERIES["op5_repair_shards"](spark, sf_small).collect()) == want


def test_odd_rows_small_shards(odd_docs, spark, tmp_path):
    path = str(tmp_path / "shards")
    repair.write_shards(odd_docs, path, PATH, shard_tokens=50)
    shards = spark.read.parquet(path)
    assert shards.count() > 3
    rows = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in repair.read_documents(shards).collect())
    source = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert [r[1] for r in rows] == sorted((i for i, _ in source), key=lambda i: (i is not None, i or 0))
    assert [r[0] for r in rows] == np.cumsum([0, *(r[2] for r in rows)])[:-1].tolist()
    assert sorted(r[2:] for r in rows) == sorted(x[2:] for x in expected(source))


def test_empty_table(no_docs, spark, tmp_path):
    path = str(tmp_path / "none")
    repair.write_shards(no_docs, path, PATH)
    assert repair.read_documents(spark.read.schema(repair.shard_schema(no_docs.schema["doc_id"].dataType)).parquet(path)).count() == 0


def test_the_grammar_is_whole():
    """Rounds go on until no pair pays: every copy of a rare passage becomes one symbol."""
    r = np.random.default_rng(1)
    ids = r.integers(0, 50_000, 400_000).astype(np.uint32)
    passage = ids[:50].copy()
    for k in range(200):
        ids[k * 1990:k * 1990 + 50] = passage
    symbols, rules, lengths = repair.compress(ids, 50_000)
    assert len(symbols) <= 400_000 - 49 * 200 and lengths.max() >= 50
    assert (repair.expand(symbols, rules, 50_000) == ids).all()
    pairs = Counter(zip(symbols[:-1].tolist(), symbols[1:].tolist()))
    assert max(n for (a, b), n in pairs.items() if a != b) < repair.LEAST


def test_rounds_look_only_where_a_pair_may_pay(monkeypatch):
    """Places looked at in all rounds together: a few times the ids, however many rounds there are."""
    looked, counted = [], repair._counted
    monkeypatch.setattr(repair, "_counted", lambda *a: looked.append(len(a[0])) or counted(*a))
    r = np.random.default_rng(5)
    # words of some ids with Zipf frequencies, and prefixes of a chain that share their pairs
    words = [r.integers(0, 5000, k) for k in r.integers(1, 9, 3000)]
    ids = np.concatenate([words[k] for k in np.minimum(r.zipf(1.3, 60_000), 3000) - 1] + [np.arange(6000, 6200)[:k] for k in range(200)] * 5)
    ids = ids.astype(np.uint32)
    symbols, rules, lengths = repair.compress(ids, 50_257)
    assert (repair.expand(symbols, rules, 50_257, lengths) == ids).all()
    assert len(looked) > 10 and sum(looked) < 4 * len(ids)


def test_whitespace_beyond_the_librarys_pattern():
    e = repair.LibraryEncoder(repair.Vocabulary(PATH))
    text = " " * 1_500_000 + "a <|endoftext|>  b"
    tokens = e.v.tokens
    got = np.frombuffer(e.encode([text])[0], "<u4").tolist()
    assert b"".join(tokens[i] for i in got) == text.encode() and e.v.special["<|endoftext|>"] in got
    odd = ["it's  a\tb \n c\x85 <|endoftext|><|endoftext|>\u3000z ", "", " ", "<|endoftext|>", "\u00e9" * 500 + " 12345 ...!"]
    library = Tokenizer.from_file(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(odd)] == [library.encode(t, add_special_tokens=False).ids for t in odd]


def test_a_round_returns_only_the_places_of_its_pairs():
    """Frequent pairs that a round does not replace are counted by their slot, no list of their places is made."""
    r = np.random.default_rng(7)
    ids = np.minimum(r.zipf(1.3, 300_000), 20_000).astype(np.uint32)
    left, right = ids[:-1], ids[1:]
    index, number, pairs, alive = repair._counted(left, right, repair._MIX, 64, repair.LEAST)
    codes = repair._codes(left, right)
    want = Counter(codes.tolist())
    assert 0 < len(pairs) <= 64 and len(index) == sum(want[p] for p in pairs.tolist()) < len(ids) / 2
    assert (codes[index] == pairs[number]).all() and (np.bincount(number) >= repair.LEAST).all()
    assert all(alive[i] for i, c in enumerate(codes.tolist()) if want[c] >= repair.LEAST)


def test_rules_are_expanded_once_for_all_their_places(monkeypatch):
    """Symbols put down one by one: those of the rules, not those of the shard."""
    r = np.random.default_rng(8)
    words = [r.integers(0, 500, k) for k in r.integers(2, 7, 300)]
    ids = np.concatenate([words[k] for k in r.integers(0, 300, 40_000)]).astype(np.uint32)
    symbols, rules, lengths = repair.compress(ids, 500, least=2000)
    put, placed = [], repair._placed
    monkeypatch.setattr(repair, "_placed", lambda s, *a: put.append(len(s)) or placed(s, *a))
    assert (repair.expand(symbols, rules, 500, lengths) == ids).all()
    assert put == [500 + len(rules)] and put[0] < len(symbols)


def test_pieces_with_white_space_at_an_edge():
    e = repair.LibraryEncoder(repair.Vocabulary(PATH))
    library = Tokenizer.from_file(PATH)
    texts = [f"a b{c} c d {c}e b{c} f{c}g {c} h" for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0   ​    　﻿"]
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
