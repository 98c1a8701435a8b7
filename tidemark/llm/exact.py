"""Exact duplicates by content hash, with the bytes compared inside each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.joins import measured
from tidemark.llm.common import saved, texts

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(text, SPACES, " ")


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per document.

    Texts are equal when their normalised bytes are. Rows are grouped by the
    hash; texts of groups with several rows are then grouped by hash and text,
    so two texts that share a hash stay apart. All grouping combines before the
    shuffle, so a group that holds a third of the table costs a task one row.

    A null text counts as empty, and empty texts form one group. A null
    ``doc_id`` is larger than any number. Of rows that repeat both id and text
    one is kept. An empty table gives no rows.
    """
    plain = texts(docs).select("doc_id", normalised(F.col("text")).alias("norm"))
    plain = plain.withColumn("hash", digest(F.col("norm")))
    keys = saved(
        plain.groupBy("hash", "doc_id", F.sha2("norm", 256).alias("text_sha256")).agg(F.count("*").alias("copies")),
        "exact-keys",
    )
    groups = keys.groupBy("hash").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))

    # The bytes: one row per text among the hashes that several rows share.
    shared = groups.where(F.col("group_size") > 1).select("hash")
    compared = saved(
        plain.join(measured(shared), "hash", "left_semi")
        .groupBy("hash", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "exact-texts",
    )
    clashing = compared.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    if clashing.isEmpty():
        found = keys.join(groups, "hash")
    else:
        apart = plain.join(clashing, "hash", "left_semi").groupBy("hash", "norm", "doc_id").agg(
            F.count("*").alias("copies"), F.first(F.sha2("norm", 256)).alias("text_sha256"))
        found = keys.join(groups.join(clashing, "hash", "left_anti"), "hash").unionByName(
            apart.join(compared, ["hash", "norm"]).drop("norm")
        )
    # Rows that repeat an id and its text were counted as one; they come back here.
    return found.select(
        "doc_id", "keep_id", "group_size", "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )
