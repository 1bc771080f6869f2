"""Training-data pipeline: each stage takes (spark, docs, sf_dir) and returns the documents the next one works on.

Stages in order: toxic documents go; of each group of near copies (five-word shingles, similarity 0.75) the document with the
smallest id stays; benchmark passages are cut out of the texts; personal data is replaced by surrogates; the sources are mixed
to their target weights. All but the last return the columns of ``documents``; ``n_chars`` follows the text.

Defined results: rows without id or text pass every filter; rows of one id stay or go together; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from funnelspark.llm import decontaminate, mixing, ngram_join, pii, toxicity
from funnelspark.session import materialise

#: Key of the surrogates. A parameter: give your own in production.
SURROGATE_KEY = "public-example-key"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the given documents and labels, does not reject."""
    return toxicity.without_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark passages."""
    return decontaminate.without_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    return pii.replace(docs, SURROGATE_KEY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken of each document and its training position."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("decontaminate", cut_benchmark), ("pii", replace_private), ("mixing", mix_sources),
]
#: The scores of fitted models have no SQL form; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
