"""Curation of a corpus: each stage works on all that the one before it kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typerank.llm import neardup, packing, quality, substring, toxicity
from typerank.llm.common import read, staged


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field rejects go. It is fitted on labelled documents that
    are not held out; where none are labelled, all stay."""
    field = quality.train(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(docs, field)
    return scored.where(F.col("_quality") >= quality.THRESHOLD).select(docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go; without toxic labels all stay."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.where(F.col("_severity") < toxicity.THRESHOLD).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest id.
    Documents that repeat an id are judged by their own texts; those without words stay."""
    return neardup.survivors(docs, p=neardup.STAGE)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long passages that repeat are cut out of the texts; every document stays."""
    cut = substring.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 tokens."""
    return packing.pack(docs, packing.public_tokens())


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: The trained stages have no SQL form; tests compare the others with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
