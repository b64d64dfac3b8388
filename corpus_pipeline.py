"""A corpus pipeline: toxicity filter, near-duplicate removal, substring deduplication, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor, whose output was written as
Parquet and read again. All but the last return the columns of documents, and whatever other columns came with them.

Decisions are about rows: rows without an id, or with one that others have too, are judged by their own texts, and come
in the order of id (null last), then text. Null and empty texts pass all filters; texts are whole, however long; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyard.llm import jaccard, packing, substring, toxicity
from tallyard.llm.common import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the network doesn't reject; it learns from the labels of the documents at hand."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group linked by five-word shingles at a Jaccard similarity of 0.8; wordless texts stay."""
    return jaccard.keep_first_of_groups(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that windows of 20 words repeat from earlier rows; rows that lose all words go.

    A text without removed words stays as it is.
    """
    return substring.drop_repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return packing.pack_pieces(docs)


STAGES = [("toxicity", drop_toxic), ("jaccard_join", drop_near_duplicates), ("substring_dedup", drop_repeated_passages), ("best_fit_packing", pack)]

#: A trained network and a learned vocabulary can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
