"""From raw documents to packed training sequences, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import jaccard_join, line_dedup, mixing, packing, toxicity
from tillmark.llm.blocks import fresh_name
from tillmark.llm.token_counts import tokenizer_path
from tillmark.sources.scratch import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model learns from the training labels.

    A model without a lexicon (no usable label, or labels that no word goes with) gives all
    documents one score and tells none apart; then every document stays. Null and empty texts are
    clean, repeated rows share their fate, an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out("doc_id", 5))
    model, weights, linear = toxicity.train(docs, labels)
    if not weights:
        return docs
    score = fresh_name(docs.columns, "toxicity")
    return toxicity.toxicity(docs, model, weights, linear, score).where(F.col(score) < 0.5).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines similar to an earlier one. A document that loses all its text goes; null texts stay."""
    return line_dedup.with_lines_removed(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; texts without words all stay."""
    return jaccard_join.one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes of a document. Repeated rows are documents of their own, a null source is one."""
    return mixing.mix(docs).select([F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens; a null text is an empty document."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The stages hold a trained model, a similarity join, random draws and a tokenizer; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
