"""The stages one by one against brute force, and the whole run on the smallest tables."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from nightledger.llm import quality

from .conftest import prose
from .test_decontaminate import by_hand as contaminated
from .test_near_dup import by_hand as fingerprint
from .test_near_dup import classes
from .test_pii import by_hand as personal


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "pii_redaction", "bpe_encoding"]


@pytest.fixture(scope="module")
def staged(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = [docs.collect()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = spark.createDataFrame(stage(spark, docs, sf_small).toPandas())
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.append(docs.collect())
    return out


def test_quality_stage(spark, sf_small, staged):
    refs, _ = quality.references(spark.read.parquet(f"{sf_small}/documents.parquet"))
    want = {r["doc_id"] for r in staged[0] if quality.measure(r["text"].encode(), refs[r["lang"]], quality.Limits())["kept"]}
    assert {r["doc_id"] for r in staged[1]} == want


def test_near_dedup_stage(staged):
    prints = {r["doc_id"]: fingerprint(r["text"]) for r in staged[1]}
    of = classes(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[of[p]] = min(i, least.get(of[p], i))
    assert sorted(r["doc_id"] for r in staged[2]) == sorted(least.values())


def test_decontamination_stage(spark, sf_small, staged):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    want = {r["doc_id"] for r in staged[2] if not contaminated(r["text"], items)[3]}
    assert {r["doc_id"] for r in staged[3]} == want


def test_pii_stage(staged):
    before = {r["doc_id"]: r["text"] for r in staged[3]}
    for r in staged[4]:
        spans, old = personal(before[r["doc_id"]]), before[r["doc_id"]]
        assert all(old[s:e] not in r["text"] for s, _, e, _ in spans)
        assert spans or "[" in r["text"] or r["text"] == old
    assert len(staged[4]) == len(staged[3])


def test_bpe_stage(staged):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in staged[4]}
    assert len(staged[5]) == len(texts)
    for r in staged[5]:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_stages_on_odd_and_empty_tables(spark, sf_small, odd_docs, no_docs):
    docs = odd_docs.unionByName(odd_docs.limit(0))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_small)
        empty = stage(spark, no_docs, sf_small)
        assert empty.count() == 0 and (i == 4 or out.columns == odd_docs.columns == empty.columns)
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert prose(5, 80)
