import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from nightledger.llm import bpe
from nightledger.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "\t", "a", "b", "'s", "'", "é", "1", "２", "!", "<|endoftext|>", "<|", "ß", "日本", "　",
         "\xa0", "\x85", "\x1c", "aaaaaa", "The", "ing", "😀", "\r\n", "\x00", "é", "ab" * 200, " word, next"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


@pytest.mark.parametrize("with_lexicon", [False, True])
def test_encode_equals_the_library(library, vocabulary, with_lexicon):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(30))) for _ in range(3000)]
    words = [b" word", b" next", b" The", b"a", b" a", b" wording"]
    lexicon = bpe.Lexicon.compile(dict(zip(words, bpe.merge_words(vocabulary, words)))) if with_lexicon else None
    encoder = bpe.Encoder(vocabulary, lexicon, memory=100)
    for at in range(0, len(texts), 500):
        part = texts[at:at + 500]
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        got = encoder.encode(part)
        assert [ids(x) for x in got] == want
        assert [bpe.decode(vocabulary, x) for x in got] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_long_words_equal_the_library(library, vocabulary):
    rng = random.Random(1)
    for word in ("".join(rng.choices("abcdefgh", k=5000)), "a" * 20_001, "ab" * 9000):
        assert ids(bpe.Encoder(vocabulary).encode([word])[0]) == library.encode(word, add_special_tokens=False).ids


def test_malformed_bytes_decode_like_the_library(library, vocabulary):
    some = [[i] for i in range(300)] + [[102, 103, 104], [50256, 13]]
    assert [bpe.decode(vocabulary, np.array(x, "<u4").tobytes()) for x in some] == [
        library.decode(x, skip_special_tokens=False) for x in some]


def test_lexicon_is_minimal_and_survives_the_file(vocabulary, tmp_path):
    words = [w.encode() for w in ("tap", "taps", "top", "tops", "stop", "stops", "a")]
    lexicon = bpe.Lexicon.compile(dict(zip(words, bpe.merge_words(vocabulary, words))))
    # right languages of the states: each appears once in a minimal automaton
    rights = {p: frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(lexicon.final) - 1 == len(set(rights.values()))
    (tmp_path / "lexicon").write_bytes(lexicon.to_bytes())
    mapped = bpe.Lexicon.mapped(str(tmp_path / "lexicon"))
    probes = [*words, b"", b"ta", b"tapsy", b"z", "é".encode()]
    numbers = mapped.number(probes)
    assert (numbers >= 0).tolist() == [w in words for w in probes]
    assert [mapped.ids_of(n) for n in numbers[:len(words)]] == bpe.merge_words(vocabulary, words)


def test_empty_lexicon(vocabulary):
    lexicon = bpe.Lexicon.compile({})
    assert lexicon.number([b"a", b""]).tolist() == [-1, -1]
    assert ids(bpe.Encoder(vocabulary, lexicon).encode(["a b"])[0]) == ids(bpe.Encoder(vocabulary).encode(["a b"])[0])


def test_query_digests(spark, sf_small, small_docs, library):
    rows = {r["doc_id"]: r for r in QUERIES["op8_transducer_bpe"](spark, sf_small).collect()}
    for r in small_docs.collect():
        want = library.encode(r["text"], add_special_tokens=False).ids
        got = rows[r["doc_id"]]
        assert got["n_tokens"] == len(want)
        assert got["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(odd_docs, no_docs, library):
    rows = bpe.encode_documents(odd_docs, PATH, lexicon_size=10).collect()
    texts = [r["text"] or "" for r in odd_docs.collect()]
    assert sorted(list(r["ids"]) for r in rows) == sorted(library.encode(t, add_special_tokens=False).ids for t in texts)
    assert sorted(r["decoded"] for r in rows) == sorted(texts)
    assert bpe.encode_documents(no_docs, PATH).count() == 0


def test_frequent_words_are_counted_over_all_documents(make_docs):
    docs = make_docs([(i, "often, often; rare%d" % i) for i in range(20)] + [(50, "twice twice")])
    assert bpe.frequent_words(docs, 2)[:1] == ["often"] or "often" in bpe.frequent_words(docs, 2)
    assert "often" in bpe.frequent_words(docs, 5) and bpe.frequent_words(docs, 0) == []


def test_pieces_seen_before_are_not_merged_again(library, vocabulary):
    """Neither after a full memory is put aside, nor as parts of other pieces."""
    encoder, asked = bpe.Encoder(vocabulary, memory=100), []
    known = encoder._ids
    encoder._ids = lambda words: asked.extend(words) or known(words)
    letters = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    a = "x " + " ".join(f"q{letters(i)}z" for i in range(80))
    b = "x " + " ".join(f"u{letters(i)}y" for i in range(60))
    c = "x " + " ".join(f"q{letters(i)}z\nu" for i in range(80))
    for text in (a, b, a, c):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(asked) == len(set(asked))
