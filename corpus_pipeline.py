"""From raw documents to packed sequences: five stages, each a table the next one reads."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.joins import measured
from tidemark.llm import decontaminate, jaccard, lines, packing, quality
from tidemark.llm.common import numbered, saved, with_row_key
from tidemark.llm.queries import TOKENIZER, table


def _without(docs: DataFrame, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``find`` does not name: it sees a number of each row as ``doc_id``, so no row goes with another.

    The numbers found are written first: the plan that writes the rows stays small, and few numbers move no text.
    """
    rows = numbered(docs)
    gone = saved(find(rows.select(F.col("number").alias("doc_id"), "row.text")).select(
        F.col("doc_id").alias("gone_id")).distinct(), "pipeline-gone")
    return rows.join(measured(gone), F.col("number") == F.col("gone_id"), "left_anti").select(*[
        F.col("row")[c].alias(c, metadata=docs.schema[c].metadata) for c in docs.columns])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, each with a key of its row."""
    return with_row_key(quality.good(docs, table(spark, sf_dir, "labels")))


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document, or line, has too; short lines only if they are equal."""
    return lines.drop_repeated_lines(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return _without(docs, lambda rows: jaccard.jaccard_components(rows, size=5, percent=80).where("doc_id != component_id"))


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return _without(docs, lambda rows: decontaminate.find_leaks(rows, table(spark, sf_dir, "benchmark")))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token sequences, packed."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", new_lines),
    ("n-gram Jaccard join", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("packing", sequences),
]

# Neither the trained classifier nor the tokenizer has a form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = saved(docs, f"pipeline-{k}")
    return docs
