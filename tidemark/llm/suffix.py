"""Repeated strings across a corpus, found at sampled suffixes and removed byte by byte.

The order of suffixes is sampled: in every window of ``min_bytes`` bytes the
smallest hash of ``ANCHOR`` bytes, leftmost, is the anchor, so equal windows
have equal anchors at equal offsets, and about one byte in 170 is an anchor.
The windows of one anchor form a run. Where an anchor occurs again, longer and
longer common strings are looked at: whole runs, then blocks of windows by the
bytes that all windows of a block share, then the windows of blocks that share
those but differ around them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.joins import measured
from tidemark.llm.common import batch_of, chunks, saved, texts
from tidemark.llm.rolling import BYTE_CODES, Prefix, U, mix, sliding_min

ANCHOR = 64
# Window starts handled together; runs end there.
SLICE = 1 << 18
# Windows in a block.
BLOCK = 32
_PLACE = U(SLICE * 4 - 1)
# Bits of a run's number that count rows of a task; the bits above count tasks.
ROW_BITS = 30

RUNS = "anchor long, content long, starts int, lead int, known boolean, key binary, at long"
_RUNS = pa.schema([
    ("anchor", pa.int64()), ("content", pa.int64()), ("starts", pa.int32()), ("lead", pa.int32()),
    ("known", pa.bool_()), ("key", pa.binary()), ("at", pa.int64()),
])
BLOCKS = "one long, two long, left binary, right binary, run long, place int, starts int"
_BLOCKS = pa.schema([
    ("one", pa.int64()), ("two", pa.int64()), ("left", pa.binary()), ("right", pa.binary()),
    ("run", pa.int64()), ("place", pa.int32()), ("starts", pa.int32()),
])
_WINDOWS = pa.schema([("one", pa.int64()), ("two", pa.int64()), ("ref", pa.int64())])
_KEPT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("kept", pa.binary()), ("kept_sha256", pa.string()),
])


def runs_of(data: bytes, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(anchor, content, starts, lead, at)`` of the runs, slice by slice; ``lead`` is the anchor's place from ``at``."""
    anchor = min(ANCHOR, width)
    for begin in range(0, len(data) - width + 1, SLICE):
        piece = np.frombuffer(data, dtype=np.uint8)[begin : begin + SLICE + width - 1]
        hashes = Prefix(BYTE_CODES[piece])
        grams = hashes.windows(anchor)
        least = sliding_min(grams & ~_PLACE | np.arange(len(grams), dtype=U), width - anchor + 1)
        cut = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]))
        starts, head, tail = np.diff(cut), cut[:-1], cut[1:] - 1
        place = (least[head] & _PLACE).astype(np.int64)
        content = mix(hashes.spans(head, tail + width) + starts.astype(U))
        yield grams[place], content, starts, place - head, head + begin


def _runs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            for text, key in zip(batch.column(0), batch.column(1)):
                key = key.as_py()
                # Two copies of a text show that all of it repeats; more add nothing.
                seen[key] = seen.get(key, 0) + 1
                if seen[key] > 2:
                    continue
                found = list(runs_of(text.as_py().encode(), width))
                anchor, content, starts, lead, at = map(np.concatenate, zip(*found))
                # The third and further equal runs of a text are known to repeat. They need not meet the
                # others, so they go anywhere: a text of one period would else send all its runs to one place.
                order = np.lexsort((at, content, anchor))
                same = (anchor[order][2:] == anchor[order][:-2]) & (content[order][2:] == content[order][:-2])
                known = np.zeros(len(at), dtype=bool)
                known[order[2:][same]] = True
                anchor = np.where(known, mix(anchor + at.astype(U)), anchor)
                yield batch_of(
                    _RUNS, anchor=anchor.view(np.int64), content=content.view(np.int64), starts=starts.astype(np.int32),
                    lead=lead.astype(np.int32), known=known, key=[key] * len(at), at=at,
                )
    return run


def blocks_of(data: np.ndarray, run: dict, width: int) -> Iterator[tuple]:
    """A run's windows by offset of the anchor, ``BLOCK`` offsets together.

    All windows of a block share its core; what they have beyond it on either
    side is kept as bytes, so that equal blocks, and windows, can be told from
    the row alone.
    """
    place = run["at"] + run["lead"]
    high, low = run["lead"], run["lead"] - run["starts"] + 1
    for block in range(low // BLOCK, high // BLOCK + 1):
        first, last = max(low, block * BLOCK), min(high, block * BLOCK + BLOCK - 1)
        core, end = place - block * BLOCK, place - block * BLOCK - BLOCK + 1 + width
        yield core, end, place - last, place - first + width, run["run"], run["lead"] - last, last - first + 1


def _blocks(width: int):
    """The blocks of the runs listed with a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                if row["key"] in seen:
                    continue
                seen.add(row["key"])
                data = row["text"].encode()
                for listed in row["listed"]:
                    for core, end, start, stop, number, place, starts in blocks_of(data, listed, width):
                        digest = xxhash.xxh3_128_digest(data[core:end])
                        rows.append((
                            int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True),
                            data[start:core], data[end:stop], number, place, starts))
            if rows:
                yield batch_of(_BLOCKS, **dict(zip(_BLOCKS.names, map(list, zip(*rows)))))
    return run


def _windows(place_bits: int):
    """The windows of the blocks, by a hash of core, offset and what lies around the core."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two, ref = [], [], []
            for row in batch.to_pylist():
                left, right = row["left"], row["right"]
                core = row["one"].to_bytes(8, "little", signed=True) + row["two"].to_bytes(8, "little", signed=True)
                for k in range(row["starts"]):
                    before = len(left) - k
                    around = left[k:] + right[: BLOCK - 1 - before]
                    digest = xxhash.xxh3_128_digest(core + bytes((before,)) + around)
                    one.append(int.from_bytes(digest[:8], "little", signed=True))
                    two.append(int.from_bytes(digest[8:], "little", signed=True))
                    ref.append((row["run"] << place_bits) + row["place"] + k)
            if ref:
                yield batch_of(_WINDOWS, one=one, two=two, ref=ref)
    return run


def covered(n: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs that the spans cover."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], min(end, n))
        else:
            out.append([start, min(end, n)])
    return [(a, b) for a, b in out]


def _remove(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, None
        for batch in batches:
            for part in chunks([batch]):
                rows = []
                for doc_id, text, key, spans in zip(*(part.column(k) for k in range(4))):
                    key = key.as_py()
                    if key != last_key or last is None:
                        data = text.as_py().encode()
                        gone = covered(len(data), [
                            (s["at"], s["at"] + s["starts"] + width - 1) for s in spans.as_py() or ()
                        ])
                        kept = b"".join(data[a:b] for a, b in zip(
                            [0, *(b for _, b in gone)], [*(a for a, _ in gone), len(data)]))
                        last_key, last = key, (
                            len(data), sum(b - a for a, b in gone), len(gone), kept, hashlib.sha256(kept).hexdigest())
                    rows.append((doc_id.as_py(), *last))
                if rows:
                    yield batch_of(_KEPT, **dict(zip(_KEPT.names, map(list, zip(*rows)))))
    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Window numbers of a run as ``(at, starts)`` stretches."""
    schema = pa.schema([("key", pa.binary()), ("at", pa.int64()), ("starts", pa.int32())])
    for batch in batches:
        keys, at, starts = [], [], []
        for row in batch.to_pylist():
            places = np.unique(np.array(row["places"], dtype=np.int64))
            cut = np.flatnonzero(np.diff(places) != 1) + 1
            for part in np.split(places, cut):
                keys.append(row["key"])
                at.append(row["at"] + int(part[0]))
                starts.append(len(part))
        yield batch_of(schema, key=keys, at=at, starts=starts)


def _groups(rows: DataFrame, group: list[str], same: list[str], first: list[str], known: Column | None = None) -> DataFrame:
    """Rows whose group has others: ``whole`` if one is the same, ``odd`` if not all are, ``leads`` one of each kind."""
    in_group, in_kind = W.partitionBy(*group), W.partitionBy(*group, *same)
    kind = F.struct(*same)
    known = F.lit(False) if known is None else known
    return (
        rows.withColumn("n_kind", F.count("*").over(in_kind)).withColumn("first", F.min(F.struct(*first)).over(in_kind))
        .withColumn("n_group", F.count("*").over(in_group))
        .withColumn("low", F.min(kind).over(in_group)).withColumn("high", F.max(kind).over(in_group))
        .where((F.col("n_group") > 1) | known)
        .withColumn("whole", (F.col("n_kind") > 1) | known).withColumn("odd", F.col("low") != F.col("high"))
        .withColumn("leads", F.struct(*first) == F.col("first"))
        .drop("n_kind", "n_group", "first", "low", "high")
    )


def repeated_spans(docs: DataFrame, width: int) -> DataFrame:
    """``(key, at, starts)``: windows ``at .. at + starts - 1`` of the text hashed to ``key`` start elsewhere too."""
    plain = docs.where(F.octet_length("text") >= width).select("text", "key")
    runs = plain.mapInArrow(_runs(width), RUNS).repartition("anchor")
    runs = saved(_groups(runs, ["anchor"], ["content", "starts"], ["key", "at"], F.col("known")).drop("anchor", "content"), "suffix-runs")
    whole = runs.where("whole").select("key", "at", "starts")
    # One run of each kind shows its windows to the others of its anchor.
    listed = runs.where("odd and leads").select("key", "at", "starts", "lead").distinct()
    listed = saved(_numbered(listed, "run"), "suffix-listed")
    by_text = listed.groupBy("key").agg(F.collect_list(F.struct("run", "at", "starts", "lead")).alias("listed"))
    blocks = (
        plain.join(measured(listed.select("key").distinct()), "key", "left_semi")
        .join(by_text, "key").select("key", "text", "listed").mapInArrow(_blocks(width), BLOCKS)
        # A text that two tasks read gives its blocks twice.
        .repartition("one").dropDuplicates(["one", "two", "left", "right", "run", "place"])
    )
    blocks = saved(_groups(blocks, ["one", "two"], ["left", "right"], ["run", "place"]), "suffix-blocks")
    # A run has fewer windows than a window has bytes.
    bits = width.bit_length()
    windows = blocks.where("odd and leads").mapInArrow(_windows(bits), "one long, two long, ref long").repartition("one")
    same = W.partitionBy("one", "two")
    repeats = windows.withColumn("low", F.min("ref").over(same)).withColumn("high", F.max("ref").over(same)).where(
        "low != high").select(F.shiftright("ref", bits).alias("run"),
                              F.col("ref").bitwiseAND((1 << bits) - 1).cast("int").alias("place"), F.lit(1).alias("n"))
    found = blocks.where("whole").select("run", "place", F.col("starts").alias("n")).unionByName(repeats)
    places = found.groupBy("run").agg(
        F.flatten(F.collect_list(F.sequence("place", F.col("place") + F.col("n") - 1))).alias("places"))
    parts = listed.join(places, "run").select("key", "at", "places").mapInArrow(
        _spread, "key binary, at long, starts int")
    return saved(whole.unionByName(parts), "suffix-spans")


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """A number for each row: of its task, then of the row."""
    number = F.monotonically_increasing_id()
    return df.withColumn(name, F.shiftleft(F.shiftright(number, 33), ROW_BITS) + number.bitwiseAND((1 << 33) - 1))


def remove_repeats(docs: DataFrame, min_bytes: int = 400) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256)``, one row per document.

    Removes each byte covered by a string of ``min_bytes`` bytes that also
    starts anywhere else in the table, in the same document or another;
    documents end strings. Rows that repeat a text repeat all of it.

    A null text is empty; empty and short texts stay whole. A null or repeated
    ``doc_id`` does not matter: texts are told apart by their hash.
    """
    plain = texts(docs).withColumn("key", F.unhex(F.md5("text")))
    spans = repeated_spans(plain, min_bytes).groupBy("key").agg(F.collect_set(F.struct("at", "starts")).alias("spans"))
    return plain.select("doc_id", "text", "key").join(spans, "key", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "key", "spans"
    ).mapInArrow(_remove(min_bytes), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
