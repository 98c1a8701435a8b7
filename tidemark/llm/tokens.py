"""Token counts from a cache of digests: a text is encoded once per tokenizer version, whoever holds it."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from importlib.metadata import version as installed

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.joins import measured
from tidemark.llm.common import batch_of, chunks, saved, worker_state

LIMIT = 4096
# A digest with more than one row in so many is joined by broadcast: fewer digests than this can be so frequent.
HOT_SHARE = 1000

CACHE = "digest binary, n_tokens long, version string"
_COUNTS = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])


def library(path: str) -> str:
    return "sentencepiece" if path.endswith(".model") else "tokenizers"


def version(path: str) -> str:
    """Digest of what decides the counts: the vocabulary file, the library and its version."""
    found = hashlib.sha256(f"{library(path)} {installed(library(path))}\n".encode())
    with open(path, "rb") as file:
        for part in iter(lambda: file.read(1 << 20), b""):
            found.update(part)
    return found.hexdigest()


def normalised(text: Column) -> Column:
    """Null as empty. Nothing else: the tokenizers here tell cases and all kinds of white space apart."""
    return F.coalesce(text.cast("string"), F.lit(""))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Numbers of tokens of texts, without begin, end or added special tokens."""
    if library(path) == "sentencepiece":
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda values: [len(ids) for ids in pieces.encode(values, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda values: [len(e.ids) for e in tokenizer.encode_batch_fast(values, add_special_tokens=False)]


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("counters")
        if path not in state:
            state[path] = counter(path)
        for batch in chunks(batches):
            yield batch_of(_COUNTS, digest=batch.column(0), n_tokens=state[path](batch.column(1).to_pylist()))
    return run


def cached(spark: SparkSession, cache: str, tokenizer_version: str) -> DataFrame:
    """``(digest, n_tokens)`` stored for one tokenizer version, one row per digest.

    Two runs that append at the same time may both store a digest; their counts agree.
    """
    spark.createDataFrame([], CACHE).write.mode("ignore").partitionBy("version").parquet(cache)
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == tokenizer_version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def add_missing(texts: DataFrame, missing: DataFrame, path: str, cache: str, tokenizer_version: str) -> None:
    """Encode one text ``(digest, text)`` of each missing digest and append its count to the cache.

    Equal texts are combined before the shuffle. Few missing digests filter the
    texts where they are read, many are matched after the shuffle.
    """
    each = texts.groupBy("digest").agg(F.max("text").alias("text")).join(measured(missing), "digest", "left_semi")
    found = each.mapInArrow(_counts(path), "digest binary, n_tokens long")
    found.withColumn("version", F.lit(tokenizer_version)).write.mode("append").partitionBy("version").parquet(cache)


def token_counts(docs: DataFrame, path: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per document.

    ``cache`` is the folder of a table ``(digest, n_tokens, version)``, made if
    absent, that outlives the run: digests it holds for this tokenizer version
    are not encoded again, new ones are appended. ``n_bytes`` is the length in
    UTF-8; ``over_limit`` says that a text has more than ``limit`` tokens.

    A null text counts as empty: no bytes, no tokens. Rows that repeat an id, a
    text or both each have their row; a null ``doc_id`` stays null. Other
    columns of the documents, whatever their names, are not looked at. An empty
    table gives no rows and leaves the cache as it is.
    """
    spark, now = docs.sparkSession, version(path)
    texts = docs.select("doc_id", normalised(F.col("text")).alias("text")).withColumn("digest", digest(F.col("text")))
    keys = saved(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "token-keys")
    copies = saved(keys.groupBy("digest").agg(F.count("*").alias("copies")), "token-digests")
    missing = copies.select("digest").join(cached(spark, cache, now), "digest", "left_anti")
    add_missing(texts.select("digest", "text"), missing, path, cache, now)

    known = cached(spark, cache, now)
    total = copies.agg(F.sum("copies")).first()[0] or 0
    hot = copies.where(F.col("copies") * HOT_SHARE > total).select("digest").join(known, "digest")
    hot = F.broadcast(spark.createDataFrame(hot.select("digest", "n_tokens").collect(), "digest binary, n_tokens long"))
    found = keys.join(hot, "digest").unionByName(keys.join(hot, "digest", "left_anti").join(known, "digest"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
