"""Registered queries of the text operators: each applies one operator, with production
parameters, to its whole table and derives the digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from ..session import scratch_path
from . import bpe, decontaminate, licenses, merkle, mixing, near_dup, oracles, pii, pitman_yor, quality, repair, shards, spelling, warc
from .common import documents

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def vocabulary_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def bpe_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          sha256(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
                          sha256(F.col("decoded")).alias("decoded_sha256"))


@register("op1_boosted_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(documents(spark, sf_dir, "doc_id", "text"))
    base = F.filter("found", lambda s: s["base"])
    of = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, sha256(pii.listed(base)).alias("base_sha256"),
                        pii.listed(F.col("found")).alias("spans"))


@register("op2_pitman_yor_score")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(documents(spark, sf_dir, "doc_id", "text"))


@register("op3_quality_divergence")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir, "doc_id", "text", "lang"))


@register("op4_simhash_covering")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@register("op5_repair_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    repair.write_shards(documents(spark, sf_dir, "doc_id", "text"), path, vocabulary_path())
    return repair.read_documents(spark.read.parquet(path))


@register("op6_warc_index", oracles.OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    warc.write_archives(pages, path)
    captures = warc.merge_runs(warc.read_runs(path, pages))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op7_license_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir, "doc_id", "text")).drop("detections")


@register("op8_transducer_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(bpe.encode_documents(documents(spark, sf_dir, "doc_id", "text"), vocabulary_path()))


SHARD_LIMIT = 1 << 20  # small enough that the directory splits on the test tables too


@register("op9_extendible_shards", oracles.op9(SHARD_LIMIT))
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    shards.write(documents(spark, sf_dir, "doc_id", "text"), path, SHARD_LIMIT)
    return shards.read(spark, path, SHARD_LIMIT)


@register("op10_suffix_decontamination", oracles.OP10)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, sf_dir, "doc_id", "text"),
                                        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        sha256(F.concat_ws(",", F.array_sort("items"))).alias("items_sha256"), "contaminated")


@register("op12_prefix_mix", oracles.OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.plan(documents(spark, sf_dir, "doc_id", "source", "text"))
    return found.select("row.doc_id", "size", "source_size", "target", "taken")


@register("op13_merkle_proofs", oracles.op13())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(docs, tampered)
    return found.select("doc_id", "leaf", "subroot", "root", sha256(F.lower(F.hex("proof"))).alias("proof_sha256"), "folded_root", "verified")


@register("op11_kd_spelling")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir, "doc_id", "text"))
