"""Alignment of two tokenizers: which tokens of one stand where tokens of the other do, and how many documents show it.

Tokens of both sides that end at the same byte close a group; all pairs across
a group are links. For each pair of ids the documents that hold it linked are
kept as bitmaps, a container per block of documents; how often a document holds
it are further planes of bits. Planes are OR-merged and popcounted for the
documents of a pair, and read again to give each document its scores.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, chunks, saved, texts, worker_state

# A block ends at so many documents, or once it has so many pairs of documents and ids.
BLOCK_DOCS = 1 << 16
BLOCK_POSTINGS = 2_000_000
# Groups with more links are counted by distinct ids.
LARGE = 1024

# Fixed value: how byte-level vocabularies of this kind part a text before they merge bytes.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Libraries may class other letters than these differently.
_OTHER = re.compile(r"[^\t\n\r -~\u00a1-\u024f]")

_FOUND = pa.schema([
    ("block", pa.int64()), ("at", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("plane", pa.int32()),
    ("n_docs", pa.int64()), ("n_bits", pa.int64()), ("dense", pa.bool_()), ("docs", pa.binary()),
])
FOUND = (
    "block long, at int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, plane int, n_docs long, n_bits long, dense boolean, docs binary"
)
_SCORES = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])
SCORES = "block long, at int, n_best long, count_sum long"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves, others follow U+0100."""
    own = {b for first, last in ((33, 126), (161, 172), (174, 255)) for b in range(first, last + 1)}
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and how ids are written."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        entries = self.a.get_vocab()
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes_a[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.len_a, self.len_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        most = max(len(self.bytes_a), len(self.bytes_b))
        width = len(str(most)) + 1
        self.most = most
        self.written = np.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(most)], dtype=f"S{width}")
        self.fast = self._fast(path_a)

    def _fast(self, path: str):
        """The first vocabulary in a faster library, if it merges plainly: by number of id, with no other rules."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, level = spec["model"], spec["pre_tokenizer"] or {}
        merges = ["".join(m.split(" ", 1) if isinstance(m, str) else m) for m in model.get("merges") or []]
        plain = (
            model["type"] == "BPE" and spec["normalizer"] is None and level.get("type") == "ByteLevel" and level.get("use_regex", True)
            and not level.get("add_prefix_space") and not model.get("ignore_merges")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
            and all(model["vocab"].get(m) == 256 + k for k, m in enumerate(merges)))
        if not plain:
            return None
        import tiktoken

        ranks = {self.bytes_a[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("first", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def ids_a(self, text: str) -> np.ndarray:
        if self.fast is not None and _OTHER.search(text) is None:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.a.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, one text after the other, and their numbers per text; none where the tokens' bytes are not the text's."""
        none = np.zeros(0, dtype=np.uint32)
        side_a, side_b = [], []
        for text, found in zip(values, self.b.encode(values, num_threads=1)):
            data = b" " + text.encode()
            a, b = (self.ids_a(" " + text), np.array(found, dtype=np.uint32)) if text else (none, none)
            if len(a) and (int(self.len_a[a].sum()) != len(data) or b"".join(map(self.bytes_b.__getitem__, found)) != data
                           or b"".join(map(self.bytes_a.__getitem__, a.tolist())) != data):
                a = b = none
            side_a.append(a)
            side_b.append(b)
        (a, n_a), (b, n_b) = ((np.concatenate([none, *x]).astype(np.int64), np.fromiter(map(len, x), dtype=np.int64, count=len(x)))
                              for x in (side_a, side_b))
        return a, n_a, b, n_b

    def align(self, values: list[str]) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
        """Columns per text, the links as ``(a * |B| + b) << 16 | text``, sorted, each once, and how often each occurs."""
        a, n_a, b, n_b = self.encode(values)
        # Both sides of a text have the same bytes, so places in all texts together can be compared.
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        size_a, size_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        links = size_a * size_b
        upto_a = np.cumsum(n_a)
        text = np.searchsorted(upto_a, np.cumsum(size_a))  # of each group
        n_groups, n_links = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
        np.add.at(n_groups, text, 1)
        np.add.at(n_links, text, links)

        found, often = self._links(a, b, size_a, size_b, links, text)
        hashes = self._hashes(a, b, group_a, group_b, size_a, size_b, n_a + n_b)
        columns = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": hashes}
        return columns, found, often

    def _links(self, a, b, size_a, size_b, links, text):
        first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        wide = len(self.bytes_b)
        small = np.flatnonzero(links <= LARGE)
        # Small groups: every A token with every B token.
        total = links[small]
        nth = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        per = np.repeat(size_b[small], total)
        one = a[np.repeat(first_a[small], total) + nth // per] * wide + b[np.repeat(first_b[small], total) + nth % per]
        parts = [np.unique(one << 16 | np.repeat(text[small], total), return_counts=True)]
        for g in np.flatnonzero(links > LARGE).tolist():
            ids_a, times_a = np.unique(a[first_a[g] : first_a[g] + size_a[g]], return_counts=True)
            ids_b, times_b = np.unique(b[first_b[g] : first_b[g] + size_b[g]], return_counts=True)
            parts.append((((ids_a[:, None] * wide + ids_b) << 16 | text[g]).ravel(), (times_a[:, None] * times_b).ravel()))
        if len(parts) == 1:
            return parts[0]
        found, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        often = np.zeros(len(found), dtype=np.int64)
        np.add.at(often, where, np.concatenate([p[1] for p in parts]))
        return found, often

    def _hashes(self, a, b, group_a, group_b, size_a, size_b, tokens) -> list[str]:
        """Digest of each text's groups, written out; of nothing: the empty string."""
        before_a, before_b = np.cumsum(size_a), np.cumsum(size_b) - size_b
        place_a = np.arange(len(a)) + before_b[group_a]
        place_b = np.arange(len(b)) + before_a[group_b]
        mark = np.empty(len(a) + len(b), dtype=np.int64)
        mark[place_a] = a + np.concatenate((group_a[1:] != group_a[:-1], [True]))[: len(a)] * self.most
        mark[place_b] = b + np.concatenate((group_b[1:] != group_b[:-1], [True]))[: len(b)] * 2 * self.most
        out, begin = [], 0
        for n in tokens.tolist():
            line = self.written[mark[begin : begin + n]].tobytes().translate(None, b"\0")
            out.append(hashlib.sha256(line[:-1]).hexdigest() if n else "")
            begin += n
        return out


def containers(docs: np.ndarray, size: np.ndarray, n_docs: int) -> tuple[pa.Array, np.ndarray]:
    """Sorted document numbers, in runs of ``size``: each as 16-bit numbers, or as bits where those are shorter."""
    width = -(-n_docs // 8)
    dense = 2 * size > width
    upto = np.cumsum(size)
    sizes = np.where(dense, width, 2 * size)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    data = np.zeros(ends[-1], dtype=np.uint8)
    plain = np.repeat(~dense, size)
    data[np.repeat(~dense, sizes)] = docs[plain].astype("<u2").view(np.uint8)
    for k in np.flatnonzero(dense).tolist():
        bits = np.zeros(width * 8, dtype=np.uint8)
        bits[docs[upto[k] - size[k] : upto[k]]] = 1
        data[ends[k] : ends[k + 1]] = np.packbits(bits)
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary()), dense


def members(container: bytes, dense: bool) -> np.ndarray:
    """The documents of a container."""
    if dense:
        return np.flatnonzero(np.unpackbits(np.frombuffer(container, dtype=np.uint8)))
    return np.frombuffer(container, dtype="<u2").astype(np.int64)


def planes(block: int, keys: np.ndarray, often: np.ndarray, n_docs: int, wide: int) -> Iterator[pa.RecordBatch]:
    """A block's bitmaps: plane ``k`` holds the documents whose number of links has bit ``k``.

    ``n_docs`` counts those that no lower plane holds, so over all planes the
    documents of their union; ``n_bits`` counts all.
    """
    order = np.argsort(keys, kind="stable")
    keys, often = keys[order], often[order]
    pair, doc = keys >> 16, keys & 0xFFFF
    plane = 0
    while len(often) and (often.max() >> plane):
        held = (often >> plane & 1).astype(bool)
        ids, docs = pair[held], doc[held]
        new = (often[held] & ((1 << plane) - 1)) == 0
        starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))[: len(ids)])
        size = np.diff(np.append(starts, len(ids)))
        if len(starts):
            packed, dense = containers(docs, size, n_docs)
            yield _rows(
                len(starts), block=np.full(len(starts), block, np.int64), a=(ids[starts] // wide).astype(np.int32),
                b=(ids[starts] % wide).astype(np.int32), plane=np.full(len(starts), plane, np.int32),
                n_docs=np.add.reduceat(new.astype(np.int64), starts), n_bits=size, dense=dense, docs=packed)
        plane += 1


def _rows(n: int, **columns) -> pa.RecordBatch:
    return batch_of(_FOUND, **{f.name: columns.get(f.name, pa.nulls(n, f.type)) for f in _FOUND})


def _aligned(path_a: str, path_b: str, block_postings: int):
    """A row per document and a row per pair of ids and plane, block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("aligned")
        if (path_a, path_b) not in state:
            state[path_a, path_b] = Pair(path_a, path_b)
        pair = state[path_a, path_b]
        wide = len(pair.bytes_b)
        block, n_docs, keys, often = TaskContext.get().partitionId() << 32, 0, [], []
        for batch in chunks(batches):
            for k in range(0, batch.num_rows, BLOCK_DOCS // 2):
                some = batch.slice(k, BLOCK_DOCS // 2)
                if n_docs + some.num_rows > BLOCK_DOCS or sum(map(len, keys)) > block_postings:
                    yield from planes(block, np.concatenate(keys), np.concatenate(often), n_docs, wide)
                    block, n_docs, keys, often = block + 1, 0, [], []
                columns, found, times = pair.align(some.column(1).to_pylist())
                keys.append(found + n_docs)
                often.append(times)
                at = np.arange(n_docs, n_docs + some.num_rows, dtype=np.int32)
                yield _rows(len(at), block=np.full(len(at), block, np.int64), at=at, doc_id=some.column(0), **columns)
                n_docs += some.num_rows
        if n_docs:
            yield from planes(block, np.concatenate(keys), np.concatenate(often), n_docs, wide)
    return run


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The scores of each block's documents, from rows sorted by block."""
    now, sums = None, None

    def done() -> Iterator[pa.RecordBatch]:
        if now is not None:
            at = np.flatnonzero(sums[0])
            yield batch_of(_SCORES, block=np.full(len(at), now, np.int64), at=at.astype(np.int32), n_best=sums[1][at], count_sum=sums[0][at])

    for batch in batches:
        blocks, plane, count = (batch.column(k).to_numpy() for k in range(3))
        best, dense = (np.array(batch.column(k).to_pylist(), dtype=bool) for k in (3, 4))
        cut = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(blocks)]):
            if lo == hi:
                continue
            if blocks[lo] != now:
                yield from done()
                now, sums = blocks[lo], np.zeros((2, BLOCK_DOCS), dtype=np.int64)
            docs = [members(c, d) for c, d in zip(batch.column(5)[lo:hi].to_pylist(), dense[lo:hi].tolist())]
            size = np.fromiter(map(len, docs), dtype=np.int64, count=len(docs))
            docs, times = np.concatenate(docs), np.int64(1) << plane[lo:hi].astype(np.int64)
            np.add.at(sums[0], docs, np.repeat(count[lo:hi] * times, size))
            np.add.at(sums[1], docs, np.repeat(best[lo:hi] * times, size))
    yield from done()


def aligned(docs: DataFrame, path_a: str, path_b: str, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Documents (``at`` is not null) and bitmaps of pairs, as one saved table."""
    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return saved(rows.mapInArrow(_aligned(path_a, path_b, block_postings), FOUND), "alignment")


def pair_counts(found: DataFrame) -> DataFrame:
    """``(a, b, n_docs, n_links, best)`` over the whole corpus; ``best``: no other pair of the same ``a`` has more documents."""
    counts = saved(
        found.where("a is not null").groupBy("a", "b").agg(
            F.sum("n_docs").alias("n_docs"), F.sum(F.expr("shiftleft(n_bits, plane)")).alias("n_links")), "alignment-counts")
    # One row per id of the first vocabulary at most.
    most = F.broadcast(counts.groupBy("a").agg(F.max("n_docs").alias("most")))
    return counts.join(most, "a").select("a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


def token_alignment(docs: DataFrame, path_a: str, path_b: str, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per document.

    A encodes a space and the text, B the text, to which it adds that space.
    ``count_sum`` adds up, over the document's links, how many documents hold
    the link's pair of ids linked; ``n_best`` counts the links whose pair has
    the most documents of all pairs with its A id, ties included.

    Null and empty texts, and texts that the tokens' bytes do not give back,
    have no tokens: zeros and an empty digest. A null ``doc_id`` stays null;
    every row is a document, also where ids or texts repeat. Other columns,
    whatever their names, are not looked at. An empty table gives no rows.
    """
    found = aligned(docs, path_a, path_b, block_postings)
    counts = pair_counts(found).select("a", "b", F.col("n_docs").alias("count"), "best")
    postings = found.where("a is not null").select("block", "plane", "a", "b", "dense", "docs").join(counts, ["a", "b"])
    scores = postings.select("block", "plane", "count", "best", "dense", "docs").repartition("block").sortWithinPartitions(
        "block").mapInArrow(_scores, SCORES)
    own = found.where("at is not null").select("block", "at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    none = F.lit(0).cast("long")
    return own.join(scores, ["block", "at"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
