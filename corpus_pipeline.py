"""Corpus pipeline: toxicity, near copies, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and read again as the next stage's docs. All but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cytolake.llm.common import materialise
from cytolake.llm.decontamination import without_leaks
from cytolake.llm.near_dedup import near_duplicates
from cytolake.llm.packing import pack_documents
from cytolake.llm.queries import vocabulary
from cytolake.llm.substring_dedup import cut_repeats
from cytolake.llm.toxicity import without_toxic

#: SQL can't express these stages; tests compare each with a brute-force version.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity grade is 0; the others go. Every row is judged by its own text: null and empty ones stay, repeated rows stay or go alike, ids and other columns don't matter, and an empty table stays empty."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the least id.

    Rows with the same id are one document and stay or go together; rows without
    an id and texts without words stay; an empty table stays empty.
    """
    copies = near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of a smaller id has.

    A document of which nothing is left goes; rows without an id, texts without
    words and shorter ones stay as they are; rows with the same id are cut alike.
    """
    return cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them. Every row is judged by its own text, so null and empty ones stay, and repeated rows stay or go alike."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids; a null or empty text is its end id alone, each repeated row a document of its own, and no documents give no pieces."""
    return pack_documents(docs, vocabulary())


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("decontamination", decontamination), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, with a table between them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
