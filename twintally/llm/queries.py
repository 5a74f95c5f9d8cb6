"""The registered queries of the corpus operators: thin calls with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.llm import (depth_bands, genetic_packing, grid_join, hamming_search, html_density, jaccard_groups, line_dedup,
                           mixing, quality_trees, repair_tokens, separator_scan, sharded_lloyd, toxicity_knn)
from twintally.llm.common import table


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies; the same place on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code"))
    return hamming_search.hamming_topk(codes, codes.where("id % 20 = 0"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.main_text(table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separator_scan.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=50256)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.drop_boilerplate(docs, report=True)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~toxicity_knn.held_out(F.col("doc_id")))
    model, counts = toxicity_knn.fit_toxicity(table(spark, sf_dir, "documents"), labels)
    return toxicity_knn.toxicity_scores(counts, model)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality_trees.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_trees.quality_report(docs, trees)


def op5_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = repair_tokens.write_shards(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)
    return repair_tokens.read_shards(shards)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genetic_packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_lloyd.cluster_report(table(spark, sf_dir, "embeddings"))


def op13_depth_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depth_bands.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_hamming_topk, op2_html_text, op3_token_counts, op4_line_dedup, op5_repair_tokens, op6_mixing, op7_toxicity,
    op8_ngram_jaccard, op9_quality, op10_packing, op11_grid_join, op12_sharded_lloyd, op13_depth_bands)}
