"""A training-data pipeline over ``documents``: quality rules, line dedup, near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's docs. All but the last return the columns of documents.

Cases, for every stage: null or empty texts, null ids, ties and repeated rows are what the stage's operator says; an empty table gives an empty result; further columns are carried
along by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verdure.llm import linedup, mixing, perplexity, pieces, similar, simhash
from verdure.llm.common import read, workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are inside their language's perplexity bands."""
    return perplexity.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of two lines or more, and of single lines of 50 words or more, are deleted."""
    return linedup.dedup_lines(docs, lines=2, alone=50)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates, by SimHash over five-word shingles at a similarity of 0.8."""
    return simhash.keep_one(docs, similar.similar_documents(docs, k=5, similarity=0.8))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    import public_tokenizers

    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("source mixing", source_mixing),
    ("encoding", encoding),
]

#: Perplexity bands, SimHash, cube sampling and Viterbi aren't SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = workspace(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
