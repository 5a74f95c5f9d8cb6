"""The corpus pipeline: quality rules, line dedup, near duplicates, source mix, packed sequences.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before
it kept, and returns rows of ``documents`` (the last one: packed pieces). Stages
are written to the shared folder and read back, so an executor lost later costs
one stage's tasks, not the stages before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.llm import genetic_packing, jaccard_groups, line_dedup, mixing, quality_trees
from twintally.llm.common import staged, table
from twintally.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the trees go. The trees learn from ``labels``."""
    trees = quality_trees.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_trees.quality_filter(docs, trees)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on too large a share of their source's distinct texts go; n_chars follows the text."""
    cleaned = line_dedup.drop_boilerplate(docs, F.col("source"), copies_once=True,
                                          more_rules=line_dedup.COMMON_RULES)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one of smallest id."""
    return jaccard_groups.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out, taken, or repeated so that sources meet their target weights."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token pieces placed in sequences."""
    return genetic_packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: trees, exact near duplicates and tokens are beyond SQL; tests hold the result against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
