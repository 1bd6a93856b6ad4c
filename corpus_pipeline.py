"""From raw documents to packed training sequences, in five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import exact_dedup, ngram_join, packing, suffix_dedup, toxicity
from curbline.llm.common import dropped, written


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the bar of expected severity."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest id."""
    return exact_dedup.kept_rows(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, four fifths."""
    return ngram_join.kept_rows(docs, words=5, percent=80)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur more than once; ``n_chars`` follows the text."""
    return suffix_dedup.kept_texts(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", clean), ("exact_dedup", distinct), ("ngram_join", unlike), ("suffix_dedup", unrepeated), ("packing", packed)]
#: SQL has neither the regression nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = last = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        last, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if name != STAGES[0][0]:
            dropped(last)
    return STAGES[-1][1](spark, docs, sf_dir)
