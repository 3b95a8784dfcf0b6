"""Spelling variants against brute force over all pairs that share a word less one letter."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from nightledger.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(pairs):
    n = Counter()
    for key, text in pairs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    near = defaultdict(set)
    gap = defaultdict(set)  # words with one place left open, and with one letter left out
    for w in n:
        for k in range(len(w)):
            gap[w[:k] + "\0" + w[k + 1:]].add(w)
            if w[:k] + w[k + 1:] in n:
                near[w].add(w[:k] + w[k + 1:])
                near[w[:k] + w[k + 1:]].add(w)
    for group in gap.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def rows(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in df.collect())


@pytest.mark.parametrize("cell", [300, spelling.CELL])
def test_against_brute_force(spark, small_docs, cell):
    """Also where cells are split several times."""
    pairs = [tuple(r) for r in small_docs.select("doc_id", "text").collect()]
    got = rows(spelling.variants(small_docs, cell))
    assert got == brute(pairs) and len(got) > 1000 and sum(r[1] != "" for r in got) >= 10


def test_chains_accents_and_equal_vectors(spark, make_docs):
    """form of a form, letters that share a count, anagrams in one leaf, ties of the largest count."""
    texts = ["lanterna " * 1000, "lanterma " * 90, "lantermo " * 8, "Lantermò " * 2, "señores señoras " * 3, "señorés × ÷abcdefg÷ " * 4,
             " ".join(a + b + "cdefgh" for a in "abxyz" for b in "abxyz") + " ", "abcdefgh hgfedcba " * 2, "NIÑOSGRANDES niñosgrandes " * 2]
    pairs = [(k, t) for k, t in enumerate(texts)] + [(99, texts[6]), (99, texts[6])]
    got = rows(spelling.variants(make_docs(pairs), 4))
    assert got == brute(pairs)
    chain = {r[0]: r[2] for r in got}
    assert chain.get("lantermo", "lanterna") == "lanterna"


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    pairs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert rows(spelling.variants(odd_docs)) == brute(pairs)
    out = spelling.variants(no_docs)
    assert out.count() == 0 and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_cells_hold_every_pair_once(spark):
    """Random words over few letters: the searches of one tree find each pair at one edit once."""
    r = np.random.default_rng(5)
    texts = sorted({bytes(r.choice(list(b"abc\xe9"), 7).astype(np.uint8)) for _ in range(3000)})
    cell = spelling.Cell(texts, np.arange(len(texts)), 7)
    found = Counter()
    for i, j in cell.near(cell.vecs, cell.letters, False, True):
        found.update(frozenset((int(cell.rows[a]), int(cell.rows[b]))) for a, b in zip(i, j))
    m = np.frombuffer(b"".join(texts), np.uint8).reshape(-1, 7)
    want = {frozenset((a, int(b))) for a in range(len(texts)) for b in np.flatnonzero((m != m[a]).sum(1) == 1)}
    assert set(found) == want and set(found.values()) == {1}
