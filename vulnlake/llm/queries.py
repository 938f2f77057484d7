"""The registered queries of the corpus operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from vulnlake.llm import (
    bpe, fim, golay, langid, licenses, mixing, multi_index, packing, repair, secret_scan, shards, simhash, suffixes,
)
from vulnlake.llm.oracles import CONVERSATIONS, FILL_IN_MIDDLE, MIX, REPEATS
from vulnlake.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame], sql: str | None = None):
    QUERIES[run.__name__] = run
    if sql is not None:
        ORACLES[run.__name__] = sql
    return run


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = golay.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs, langid.train(docs), keep=["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score")


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return secret_scan.scan(docs, secret_scan.learn(docs))


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the contract's columns: for documents whose id is divisible by 20, how many others lie within the radius."""
    prints = simhash.fingerprint_documents(table(spark, sf_dir, "documents"))
    return simhash.with_neighbours(prints, F.col("doc_id") % 20 == 0).drop("f1", "f2")


@query
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs).select(
        "doc_id", "repeats.n_bytes", "repeats.n_removed", "repeats.n_spans", "repeats.kept_sha256"
    )


query(op5_suffix_dedup, REPEATS)


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return coded.select("doc_id", "coded.n_tokens", "coded.ids_sha256", "coded.decoded_sha256")


@query
def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


@query
def op8_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audit(repair.damage(table(spark, sf_dir, "conversations")))


query(op11_conversation_repair, CONVERSATIONS)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


query(op12_fill_in_middle, FILL_IN_MIDDLE)


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


query(op13_source_mix, MIX)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
