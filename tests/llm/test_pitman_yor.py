import math
import zlib
from collections import Counter

import numpy as np
import pytest

from nightledger.llm import pitman_yor as py

from .conftest import ODD, prose


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def check_base(docs, rows):
    c = Counter(t for i, x in docs if not held(i) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    want = []
    for i, x in docs:
        t = tokens(x)
        want.append((i, held(i), len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)))
    key = lambda r: (repr(r[0]), r[2], r[3])
    for a, b in zip(sorted(want, key=key), sorted(map(tuple, rows), key=key), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9)
        assert b[6] < 0


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.fixture(scope="module")
def scored(small_docs):
    return py.score(small_docs).collect()


def test_counts_and_base_score_match_brute_force(small_docs, scored):
    check_base(pairs(small_docs), scored)


def test_held_out_text_is_predicted_better_than_by_the_base(scored):
    out = [r for r in scored if r["held_out"]]
    n = sum(r["n_tokens"] for r in out)
    assert sum(r["score"] for r in out) / n > sum(r["base_score"] for r in out) / n + 0.1


def test_blocks_and_split_contexts_do_not_change_the_counts(small_docs, monkeypatch):
    monkeypatch.setattr(py, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(py, "BUCKET_ENTRIES", 3000)
    monkeypatch.setattr(py, "CONTEXT_PART", 500)
    check_base(pairs(small_docs), py.score(small_docs).collect())


def test_continuations_of_a_context_have_at_most_the_whole_probability(make_docs):
    train = [(i, "a b a c a b") for i in range(1, 200) if not held(i)][:8]
    out = next(i for i in range(1000, 2000) if held(i))
    rows = py.score(make_docs(train + [(out, "a " + w) for w in ("a", "b", "c", "unknown")] + [(out, "a")])).collect()
    scores = [r["score"] for r in rows if r["held_out"]]
    assert len(scores) == 5 and sum(10 ** s for s in scores) < 1


def test_gibbs_reaches_the_exact_distribution():
    """Tables of one word with c customers: P(t) is proportional to a^t S(c, t), S by its recurrence."""
    c, a, d = 6, 0.7, 0.5
    s = [[0.0] * (c + 2) for _ in range(c + 1)]
    s[0][0] = 1.0
    for n in range(c):
        for t in range(n + 1):
            s[n + 1][t + 1] += s[n][t]
            s[n + 1][t] += s[n][t] * (n - d * t)
    want = np.array([s[c][t] * a ** t for t in range(1, c + 1)])
    want /= want.sum()
    rng, n = np.random.default_rng(1), 20_000
    labels = np.zeros((n, c), np.int64)
    for _ in range(30):
        t = py._reseat_small(labels, np.full(n, a), d, rng)
    assert np.allclose(np.bincount(t, minlength=c + 1)[1:] / n, want, atol=0.015)


def test_seating_keeps_between_one_and_all_tables():
    rng = np.random.default_rng(2)
    c = np.array([0, 1, 2, 5, 13, 1000, 10 ** 7])
    for t in py.seat(c, np.zeros(7, np.int64), np.full(7, 0.01), np.ones(1, np.int64), 0.8, 1.0, rng):
        assert (t <= c).all() and (t[c > 0] >= 1).all() and t[0] == 0


def test_packing_round_trips():
    arrays = [np.array(x, t) for x, t in (([], np.uint64), ([1, 2, 3], np.uint8), ([2 ** 63, 5], np.uint64), ([-7, 9], np.int64))]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(py.unpack(py.pack(*arrays)), arrays, strict=True))


def test_odd_rows(odd_docs, make_docs):
    docs = pairs(odd_docs)
    check_base(docs, py.score(odd_docs).collect())
    only_held = [(next(i for i in range(1000) if held(i)), prose(1, 30))]
    rows = py.score(make_docs(only_held)).collect()
    assert rows[0]["train_tokens"] == 0 and rows[0]["n_known"] == 0 and rows[0]["score"] == pytest.approx(0.0)
    assert len(ODD) == len(docs)


def test_empty_table(no_docs):
    assert py.score(no_docs).count() == 0


def test_packed_arrays_carry_little_beside_their_bytes():
    """A block sends a few pairs to each of many buckets: seven small arrays go in one compressed piece."""
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 256, 20).astype(np.uint8) for _ in range(7)]
    assert len(py.pack(*arrays)) < sum(a.nbytes for a in arrays) + 7 * 8 + 40
    assert all((a == b).all() for a, b in zip(py.unpack(py.pack(*arrays)), arrays, strict=True))


def test_tables_of_single_customers_are_not_sent():
    """A bucket's answer grows with its repeated pairs, and comes back whole."""
    blocks = [(1, [5, 5, 6, 7, 8]), (2, [5, 6, 9, 9, 9])]
    rows = []
    for block, words in blocks:
        number, own = np.unique(np.array(words, np.int64), return_counts=True)
        rows.append((block, 0, py.pack(py.steps(np.array([3], np.int64)), np.array([1], np.uint8), np.array([len(number)], np.uint8),
                                       py.steps(number), np.arange(len(number), dtype=np.uint8), py.narrow(own), np.full(len(number), 80, np.uint8))))
    back = [py.unpack(d) for d in py.merge_pairs(py._rows(rows))["data"].to_pylist()]
    assert [b[0].tolist() for b in back] == [[3, 2, 1, 1], [3, 2, 3]]
    assert [len(b[2]) for b in back] == [2, 3] and all((1 <= b[2]).all() and (b[2] <= b[0][b[0] > 1]).all() for b in back)


def test_a_task_takes_one_block_at_a_time(small_docs, monkeypatch):
    """However many blocks meet in a partition: a block's arrays are a group of their own, not rows of one batch."""
    monkeypatch.setattr(py, "BLOCK_BYTES", 20_000)
    scored = py.score(small_docs)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Join" not in plan and "FlatMapGroupsInArrow" in plan
    rows = {"block": [7] * 5, "kind": [py.WORDS, py.OWN, py.WORDS, py.OWN, py.OWN], "bucket": [4, 2, 1, 0, 1],
            "data": [b"w4", b"tokens", b"w1", b"held", b"sizes"]}
    assert py._of_block(py.pa.table(rows)) == (7, {py.OWN: [b"held", b"sizes", b"tokens"], py.WORDS: [b"w1", b"w4"], py.PAIRS: [],
                                                   py.PARENTS: [], py.IDS: []}, [1, 4])
