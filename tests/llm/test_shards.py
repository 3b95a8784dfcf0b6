import hashlib
from collections import defaultdict

import pytest

from nightledger.llm import shards

from .conftest import ODD, prose


def by_hand(rows, limit):
    """Split oversized buckets bit by bit."""
    bits = lambda i, t: bin(int(hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()[:16], 16))[2:].zfill(64)
    docs = [(i, bits(i, t), len((t or "").encode())) for i, t in rows]
    own = defaultdict(int)
    for _, b, n in docs:
        own[b] += n
    leaf = {b: b for b, n in own.items() if n > limit}
    todo = [("", [b for b in own if b not in leaf])]
    while todo:
        prefix, members = todo.pop()
        if sum(own[b] for b in members) <= limit:
            leaf.update((b, prefix) for b in members)
        else:
            todo += [(prefix + x, [b for b in members if b[len(prefix)] == x]) for x in "01"]
    out, seen = [], defaultdict(int)
    copies = defaultdict(int)
    for i, b, n in docs:
        copies[i, b, n] += 1
    for i, b, n in docs:
        per = max(limit // max(n, 1), 1)
        extra = len(leaf[b]) == 64 and copies[i, b, n] > per
        out.append((i, leaf[b] + (f"+{seen[i, b, n] // per}" if extra else ""), len(leaf[b]), n, n > limit))
        seen[i, b, n] += 1
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", [1 << 30, 100_000, 9000])
def test_small_tables_match_brute_force(small_docs, limit):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.collect()]
    assert got(shards.assign(small_docs, limit)) == by_hand(rows, limit)
    assert got(shards.assign(small_docs, limit, step=2)) == by_hand(rows, limit)


def test_only_single_documents_exceed_the_limit(small_docs):
    sizes, most = defaultdict(int), defaultdict(int)
    for r in shards.assign(small_docs, 9000).collect():
        sizes[r["shard"]] += r["n_bytes"]
        most[r["shard"]] += r["oversized"]
    assert all(n <= 9000 or most[s] == 1 for s, n in sizes.items())


def test_copies_that_exceed_the_limit_are_dealt_out(make_docs):
    rows = [(1, prose(1, 100))] * 40 + [(i, prose(i, 50)) for i in range(2, 30)]
    limit = 3 * len(rows[0][1]) + 10
    found = got(shards.assign(make_docs(rows), limit))
    assert found == by_hand(rows, limit)
    assert len({s for _, s, _, _, _ in found if "+" in s}) == 14


@pytest.mark.parametrize("limit", [1 << 30, 5000])
def test_odd_rows(odd_docs, limit):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert got(shards.assign(odd_docs, limit)) == by_hand(rows, limit)
    assert len(rows) == len(ODD)


def test_written_shards_hold_all_rows_and_columns(spark, odd_docs, tmp_path):
    path = str(tmp_path / "s")
    shards.write(odd_docs, path, 5000)
    out = spark.read.parquet(path)
    assert out.columns == [*odd_docs.columns, "shard"]
    assert sorted(map(repr, out.drop("shard").collect())) == sorted(map(repr, odd_docs.collect()))
    assert out.select("shard").distinct().count() > 1


def test_written_shards_keep_the_limit_and_agree_with_the_placement(spark, make_docs, tmp_path):
    """A document repeated ten thousand times is dealt by the same rule in the files."""
    text = prose(1, 20)
    docs = make_docs([(i, prose(i, 50)) for i in range(2, 60)]).unionByName(
        make_docs([(1, text)]).crossJoin(spark.range(10_000)).drop("id"))
    limit = 100 * len(text) + 7
    path = str(tmp_path / "s")
    shards.write(docs, path, limit)
    rows = got(shards.read(spark, path, limit))
    assert rows == got(shards.assign(docs, limit))
    sizes = defaultdict(int)
    for _, s, _, n, _ in rows:
        sizes[s] += n
    assert max(sizes.values()) <= limit and len(rows) == 10_058
    assert sum("+" in s for s in sizes) == 100


def test_empty_table(no_docs):
    assert shards.assign(no_docs).count() == 0


def test_documents_are_not_moved_to_meet_the_directory(spark, make_docs):
    """With more hashes than Spark broadcasts, only the write itself moves the texts."""
    docs = make_docs([(i, prose(i, 30)) for i in range(3000)])
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in kept:
            spark.conf.set(k, str(24 << 10))
        found = shards.placed(docs, 60_000)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        assert found.count() == 3000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
