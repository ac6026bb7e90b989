"""The corpus pipeline: documents pass through five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm.bpe import bpe_encode
from loomspark.llm.common import Scratch
from loomspark.llm.decontam import decontaminate
from loomspark.llm.linededup import line_dedup
from loomspark.llm.neardup import near_duplicates as without_near_duplicates
from loomspark.llm.queries import WORD_BPE, table
from loomspark.llm.toxicity import fit, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line passages are cut from the texts; ``n_chars`` follows. No document goes: one of which nothing is left has an
    empty text, and the next stage leaves one of those."""
    cut = line_dedup(docs)
    shorter = F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", shorter).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, the one with the smallest identifier stays. A link is a Jaccard similarity of 0.8 or more over five-word shingles;
    SimHash finds the candidates."""
    return without_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token identifiers of every text that is left, with their digests."""
    return bpe_encode(docs, WORD_BPE).drop("decoded")


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("simhash", near_duplicates), ("decontamination", benchmark), ("bpe", encode)]

#: The classifier, the components and the encoder have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
