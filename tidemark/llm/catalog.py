"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import langid, quality, secrets
from .bpe import encode_documents
from .chat import PERSPECTIVES_SQL, mask_text, perspectives
from .common import fold, table
from .embeddedup import DUPLICATES_SQL, embedding_duplicates
from .merkle import MERKLE_SQL, folded, manifest, siblings_hash
from .packing import pack_documents
from .repair import read_ids, write_ids
from .simhash import near_duplicates
from .substrings import PASSAGES_SQL, repeated_passages
from .topk import TOP_K_SQL, top_k
from .trie import TRIE_SQL, prefix_trie


def op1_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "repair-ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_ids(spark, path, with_ids=False)


def op2_int8_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op3_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, query_every=50, scale=256.0)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), max_bits=2, shingle=3, seed=42)


def op5_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    scored = quality.score(docs.select("doc_id", "text"), model)
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", predicted)


def op6_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048, 0)


def op7_ftrl_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold("doc_id", 4) != 2)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op8_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives(table(spark, sf_dir, "conversations")).withColumn("mask", mask_text())


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs)
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = {k})) AS long)").alias(f"n_{secrets.KINDS[k]}") for k in range(3)]
    base = F.sha2(secrets.joined("spans", "x.kind < 3").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secrets.joined("spans").alias("spans"))


def op11_nested_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    made = manifest(table(spark, sf_dir, "documents"), claimed={"text": F.when(chosen, lower).otherwise(F.col("text"))})
    root = F.lit(made.root).alias("root")
    proofs = made.proofs.select("doc_id", "leaf", "subroot", root, siblings_hash().alias("proof_sha256"), folded(F.coalesce("claim", "leaf")).alias("folded_root"))
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_tree_contraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("conv_id") - F.col("conv_id") % 100
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return prefix_trie(table(spark, sf_dir, "conversations"), base, kept)


def op13_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), window=50).drop("spans")


QUERIES_LLM: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repair": op1_repair,
    "op2_int8_tiles": op2_int8_tiles,
    "op3_uniform_threshold": op3_uniform_threshold,
    "op4_simhash": op4_simhash,
    "op5_random_indexing": op5_random_indexing,
    "op6_minimum_bin_slack": op6_minimum_bin_slack,
    "op7_ftrl_language": op7_ftrl_language,
    "op8_perspectives": op8_perspectives,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_randomness_battery": op10_randomness_battery,
    "op11_nested_intervals": op11_nested_intervals,
    "op12_tree_contraction": op12_tree_contraction,
    "op13_suffix_automata": op13_suffix_automata,
}

ORACLE_LLM: dict[str, str] = {
    "op2_int8_tiles": DUPLICATES_SQL,
    "op3_uniform_threshold": TOP_K_SQL,
    "op8_perspectives": PERSPECTIVES_SQL,
    "op11_nested_intervals": MERKLE_SQL,
    "op12_tree_contraction": TRIE_SQL,
    "op13_suffix_automata": PASSAGES_SQL,
}
