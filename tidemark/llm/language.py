"""Stupid backoff: n-gram counts by hash partition, joined to the n-grams of the documents.

Documents are dealt into blocks. A block lists its distinct n-grams, cut by the
partition of their hash; each partition adds the counts up and answers every
block in the order it asked. The n-grams of a block thus travel once, sorted and
as differences, not once per occurrence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, saved, texts
from tidemark.llm.rolling import U, joined_hashes, word_hashes

BACKOFF = 0.4
# Bytes of text in a block, and so of n-grams in a partition.
BLOCK_BYTES = 12 << 20

_ASKED = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("order", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary()),
])
ASKED = "part int, block int, order int, hashes binary, counts binary"
_TOLD = pa.schema([("block", pa.int32()), ("order", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
TOLD = "block int, order int, part int, counts binary"
_SUMS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_sum", pa.float64()), ("n_unigram", pa.int64())])
SUMS = "doc_id long, n_words long, log_sum double, n_unigram long"


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight together: what compresses well is then in one place."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def grams(values: list[str], order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words per text; for each n the n-gram hashes, and where in the word list their last words are."""
    words, counts = word_hashes([v.encode() for v in values])
    begin = np.repeat(np.cumsum(counts) - counts, counts)
    place = np.arange(len(words)) - begin
    hashes, last = [], []
    for n in range(1, order + 1):
        found = joined_hashes(words, n)
        inside = np.flatnonzero(place[n - 1 :] >= n - 1) if n > 1 else np.arange(len(words))
        hashes.append(found[inside])
        last.append(inside + n - 1)
    return counts, hashes, last


def _rows(block: int, n: int, found: np.ndarray, bits: int) -> list[tuple]:
    """The distinct n-grams of a block and how often each occurs, a row for each partition of their hashes."""
    distinct, counts = np.unique(found, return_counts=True)
    cuts = np.searchsorted(distinct, np.arange(1, 1 << bits, dtype=U) << U(64 - bits)) if bits else []
    return [
        (part, block, n, planes(np.diff(own, prepend=U(0))), planes(held.astype(np.uint32)))
        for part, (own, held) in enumerate(zip(np.split(distinct, cuts), np.split(counts, cuts))) if len(own)
    ]


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([batch_of(schema, **dict(zip(schema.names, map(list, zip(*rows)))))] if rows else [], schema=schema)


def _ask(bits: int):
    """Words and word pairs."""
    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        _, hashes, _ = grams(table.column("text").to_pylist(), 2)
        return _table(_ASKED, [r for n, found in enumerate(hashes, 1) for r in _rows(block, n, found, bits)])
    return run


def _ask_longer(n: int, bits: int):
    """The n-grams that can occur twice: both shorter ones in them do."""
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _ASKED.empty_table()
        counts, hashes, last = grams(docs.column("text").to_pylist(), n)
        asked = _totals(counts, hashes, last, told, n - 1)[1]
        return _table(_ASKED, _rows(docs.column("block")[0].as_py(), n, hashes[n - 1][asked[n - 1]], bits))
    return run


def _totals(counts: np.ndarray, hashes: list, last: list, told: pa.Table, order: int) -> tuple[list, list]:
    """Occurrences in the corpus of the n-gram that ends at each word, for n up to ``order``; and which n-grams were asked for.

    One more n than told is marked: those to ask for next.
    """
    words = int(counts.sum())
    orders, parts = told.column("order").to_numpy(), told.column("part").to_numpy()
    totals, asked = [], []
    for n, found in enumerate(hashes, 1):
        mine = np.ones(len(found), dtype=bool)
        if n > 2:
            mine = (totals[n - 2][last[n - 1]] > 1) & (totals[n - 2][last[n - 1] - 1] > 1)
        asked.append(mine)
        if n > order:
            break
        inverse = np.unique(found[mine], return_inverse=True)[1]
        rows = np.flatnonzero(orders == n)
        rows = rows[np.argsort(parts[rows], kind="stable")]
        answer = [unplanes(told.column("counts")[int(k)].as_py(), np.int64) for k in rows]
        sums = np.concatenate(answer) if answer else np.zeros(0, dtype=np.int64)
        total = np.zeros(words, dtype=np.int64)
        total[last[n - 1]] = 1
        total[last[n - 1][mine]] = sums[inverse]
        totals.append(total)
    return totals, asked


def _tell(table: pa.Table) -> pa.Table:
    part = table.column("part")[0].as_py()
    rows = []
    orders = table.column("order").to_numpy()
    for n in np.unique(orders).tolist():
        mine = table.filter(pa.array(orders == n))
        asked = [np.cumsum(unplanes(h.as_py(), U)) for h in mine.column("hashes")]
        held = np.concatenate([unplanes(c.as_py(), np.uint32) for c in mine.column("counts")]).astype(np.int64)
        every = np.concatenate(asked)
        order = np.argsort(every)
        ranked = every[order]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        sums = np.add.reduceat(held[order], first)
        totals = np.empty_like(held)
        totals[order] = np.repeat(sums, np.diff(np.append(first, len(ranked))))
        cuts = np.cumsum([len(a) for a in asked])[:-1]
        for block, own in zip(mine.column("block").to_pylist(), np.split(totals, cuts)):
            rows.append((block, n, part, planes(own)))
    return _table(_TOLD, rows)


def _score(order: int):
    penalty = np.log(BACKOFF)

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _SUMS.empty_table()
        counts, hashes, last = grams(docs.column("text").to_pylist(), order)
        words = int(counts.sum())
        total = _totals(counts, hashes, last, told, order)[0]
        # Without the occurrence itself.
        rest = np.maximum(total[0] - 1, 0)
        value = np.where(rest > 0, np.log(np.maximum(rest, 1)), penalty)
        unigram = np.ones(words, dtype=bool)
        for n in range(2, order + 1):
            at = last[n - 1]
            seen = total[n - 1][at] > 1
            context = total[n - 2][at - 1]
            value[at] = np.where(
                seen, np.log(np.maximum(total[n - 1][at] - 1, 1)) - np.log(np.maximum(context - 1, 1)), value[at] + penalty)
            unigram[at[seen]] = False
        owner = np.repeat(np.arange(len(counts)), counts)
        return pa.Table.from_batches([batch_of(
            _SUMS, doc_id=docs.column("doc_id").combine_chunks(), n_words=counts,
            log_sum=np.bincount(owner, value, len(counts)), n_unigram=np.bincount(owner, unigram, len(counts)).astype(np.int64),
        )], schema=_SUMS)
    return run


def backoff_scores(docs: DataFrame, order: int = 3) -> DataFrame:
    """``(doc_id, n_words, log_score, mean_log_score)``, one row per document; ``order`` is 2 or more.

    A word scores the relative count of the longest n-gram that ends in it and
    also occurs elsewhere in the table, times 0.4 for each step back: counts
    leave out the occurrence that is scored. A word that occurs nowhere else
    scores 0.4 / number of words. Scores are natural logarithms.

    Words are what ASCII white space separates, with A-Z lowered. A null or
    empty text has no words, score 0 and a null mean. Repeated rows count as
    often as they occur. An empty table gives no rows.
    """
    plain = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = plain.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 1
    blocks = size // BLOCK_BYTES + 1
    bits = int(blocks - 1).bit_length()
    dealt = plain.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    told = dealt.groupBy("block").applyInArrow(_ask(bits), ASKED).groupBy("part").applyInArrow(_tell, TOLD)
    for n in range(3, order + 1):
        told = told.repartition(blocks, "block")
        longer = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_ask_longer(n, bits), ASKED)
        told = told.unionByName(longer.groupBy("part").applyInArrow(_tell, TOLD))
    sums = saved(dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_score(order), SUMS), "language-sums")
    words = sums.agg(F.sum("n_words")).first()[0] or 1
    score = F.col("log_sum") - F.col("n_unigram") * F.log(F.lit(float(words)))
    return sums.select("doc_id", "n_words", score.alias("log_score"),
                       F.when(F.col("n_words") > 0, score / F.col("n_words")).alias("mean_log_score"))
