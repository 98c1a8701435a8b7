"""Token counts against the library, and what the cache saves."""

import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import tokens

SCHEMA = "doc_id long, text string, digest string, n_tokens string, version int, copies int"
PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", "one two", "one two", "One  two", "</s> <s> <0x0A>", "tab\tand\n\nbreaks ", "é😀 中文 \u0000 ▁", "word " * 5000, "a" * 1_200_000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "d", "x", 1, 2) for k, t in enumerate(TEXTS)]
    rows += [rows[2], (2, "other", None, None, None, None), (None, "one two", None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def wanted(docs, path=PATH):
    if path.endswith(".model"):
        encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
    else:
        from tokenizers import Tokenizer

        plain = Tokenizer.from_file(path)
        encode = lambda t: plain.encode(t, add_special_tokens=False).ids
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    return sorted(((d, len(t.encode()), len(encode(t)), len(encode(t)) > tokens.LIMIT) for d, t in rows), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_counts_equal_the_library(docs, folder):
    assert got(tokens.token_counts(docs, PATH, f"{folder}/cache")) == wanted(docs)


def test_other_library(docs, folder):
    path = public_tokenizers.path("word_bpe_49k.json")
    small = docs.where("doc_id is null or doc_id < 8")
    assert got(tokens.token_counts(small, path, f"{folder}/cache")) == wanted(small, path)


def test_only_new_texts_are_encoded(spark, docs, folder, monkeypatch):
    cache, asked = f"{folder}/cache", []
    add = tokens.add_missing

    def listen(texts, missing, *more):
        asked.append(missing.count())
        add(texts, missing, *more)

    monkeypatch.setattr(tokens, "add_missing", listen)
    first = docs.where("doc_id < 4")
    tokens.token_counts(first, PATH, cache)
    assert got(tokens.token_counts(docs, PATH, cache)) == wanted(docs)
    assert got(tokens.token_counts(docs, PATH, cache)) == wanted(docs)
    assert asked == [3, 6, 0]
    stored = spark.read.schema(tokens.CACHE).parquet(cache)
    assert stored.count() == 9 and stored.select("version").distinct().count() == 1


def test_counts_of_other_versions_are_not_used(spark, docs, folder):
    cache = f"{folder}/cache"
    wrong = docs.select(tokens.digest(tokens.normalised(docs.text)).alias("digest")).distinct().selectExpr("digest", "99L as n_tokens", "'old' as version")
    wrong.write.partitionBy("version").parquet(cache)
    assert got(tokens.token_counts(docs, PATH, cache)) == wanted(docs)


def test_a_digest_stored_twice_gives_one_row(docs, folder):
    cache = f"{folder}/cache"
    tokens.token_counts(docs, PATH, cache)
    again = docs.sparkSession.read.schema(tokens.CACHE).parquet(cache)
    docs.sparkSession.createDataFrame(again.collect(), tokens.CACHE).write.mode("append").partitionBy("version").parquet(cache)
    assert got(tokens.token_counts(docs, PATH, cache)) == wanted(docs)


def test_empty_table(docs, folder):
    assert tokens.token_counts(docs.limit(0), PATH, f"{folder}/cache").isEmpty()
