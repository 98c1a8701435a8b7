"""Benchmark passages in documents: q-gram lemma in diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, chunks, texts
from tidemark.llm.rolling import BASES, Prefix, U, mix

Q = 10
# A passage of this many characters, or the whole item if shorter, in at most this share of edits.
PASSAGE = 100
ERRORS = 0.08
# Items shorter than this are too short to tell a leak from chance: they must occur unchanged.
LEAST = 40
# Characters of benchmark text that are looked for in one pass; further text takes further passes.
PASS_CHARS = 2_000_000
FILTER_BITS = 22
# More than there are bands in a document and item.
_BANDS = 1 << 40

_HITS = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("doc_start", pa.int64()), ("doc_end", pa.int64()),
    ("item_start", pa.int64()), ("item_end", pa.int64()), ("edits", pa.int64()),
])
HITS = "doc_id long, item_id long, doc_start long, doc_end long, item_start long, item_end long, edits long"


def plain(text: str) -> str:
    """Lower case, each run of white space one blank."""
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def budget(length: int) -> tuple[int, int]:
    """Length of the passage looked for in an item, and its edits."""
    passage = min(length, PASSAGE)
    return passage, int(passage * ERRORS) if length >= LEAST else 0


class Index:
    """Sorted q-grams of the items, with a bitmap before them."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.codes = [codes(plain(t)) for _, t in items]
        self.bounds = np.array([budget(len(c)) for c in self.codes])
        hashes, owner, place = [], [], []
        for k, item in enumerate(self.codes):
            q = min(Q, len(item))
            if q == Q:
                found = grams(item)
                hashes.append(found)
                owner.append(np.full(len(found), k))
                place.append(np.arange(len(found)))
        none = [np.zeros(0, dtype=U)], [np.zeros(0, dtype=np.int64)]
        every = np.concatenate(hashes or none[0])
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.owner = np.concatenate(owner or none[1])[order]
        self.place = np.concatenate(place or none[1])[order]
        self.near = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.near[(every >> U(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the document, item, place in the item of all common q-grams."""
        maybe = np.flatnonzero(self.near[(found >> U(64 - FILTER_BITS)).astype(np.int64)])
        low = np.searchsorted(self.hashes, found[maybe], side="left")
        size = np.searchsorted(self.hashes, found[maybe], side="right") - low
        at = np.repeat(maybe, size)
        total = np.cumsum(size)
        held = np.repeat(low - (total - size), size) + np.arange(total[-1] if len(total) else 0)
        return at, self.owner[held], self.place[held]


def grams(text: np.ndarray) -> np.ndarray:
    return Prefix(mix((text.astype(U) + U(1)) * U(BASES[1]))).windows(Q)


def align(item: np.ndarray, doc: np.ndarray, first: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Edits and document places along the best alignment of the whole item, on ``width`` diagonals from ``first``.

    What the band passes before and behind is free; places outside the document
    match nothing. Row ``i``: item characters consumed; column ``k``: document
    place ``first + i + k``.
    """
    n = len(item)
    around = np.full(n + width, -1, dtype=np.int64)
    low, high = max(first, 0), min(first + n + width, len(doc))
    if low < high:
        around[low - first : high - first] = doc[low:high]
    cost = np.zeros((n + 1, width), dtype=np.int32)
    ramp = np.arange(width)
    for i in range(1, n + 1):
        row = cost[i - 1] + (around[i - 1 : i - 1 + width] != item[i - 1])
        row[:-1] = np.minimum(row[:-1], cost[i - 1][1:] + 1)
        cost[i] = np.minimum.accumulate(row - ramp) + ramp
    edits, places = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    i, k = n, int(cost[n].argmin())
    edits[n], places[n] = cost[n, k], first + n + k
    while i:
        if cost[i, k] == cost[i - 1, k] + (around[i - 1 + k] != item[i - 1]):
            i -= 1
        elif k + 1 < width and cost[i, k] == cost[i - 1, k + 1] + 1:
            i, k = i - 1, k + 1
        else:
            k -= 1
            continue
        edits[i], places[i] = cost[i, k], first + i + k
    return edits, np.clip(places, 0, len(doc))


def unchanged(index: Index, doc: np.ndarray, at: np.ndarray, item: np.ndarray, place: np.ndarray) -> dict[int, tuple[int, ...]]:
    """For each item a passage that the document holds without an edit, the first in the item: q-grams in a row on one diagonal."""
    order = np.lexsort((place, at - place, item))
    at, item, place = at[order], item[order], place[order]
    goes_on = (item[1:] == item[:-1]) & (at[1:] == at[:-1] + 1) & (place[1:] == place[:-1] + 1)
    head = np.concatenate(([0], np.flatnonzero(~goes_on) + 1))
    long_enough = np.diff(np.append(head, len(at))) >= index.bounds[item[head], 0] - Q + 1
    found: dict[int, tuple[int, ...]] = {}
    for h in head[long_enough].tolist():
        k, d, i = int(item[h]), int(at[h]), int(place[h])
        width = int(index.bounds[k, 0])
        if (k not in found or i < found[k][3]) and np.array_equal(doc[d : d + width], index.codes[k][i : i + width]):
            found[k] = k, d, d + width, i, i + width, 0
    return found


def leaks(text: str, index: Index) -> Iterator[tuple[int, int, int, int, int, int]]:
    """``(item, document start, end, item start, end, edits)`` of the best passage per item."""
    doc = codes(plain(text))
    if len(doc) < Q:
        return
    at, item, place = index.hits(grams(doc))
    if not len(at):
        return
    passage, errors = index.bounds[:, 0], index.bounds[:, 1]
    best = unchanged(index, doc, at, item, place)
    # An item found unchanged needs no alignment, nor does one that allows no edits.
    open_items = (errors > 0) & ~np.isin(np.arange(len(errors)), list(best))
    rest = open_items[item]
    at, item, place = at[rest], item[rest], place[rest]
    step = np.maximum(errors, 4)[item]
    diagonal = at - place
    # Bands overlap by the edits, so some band holds all q-grams of a passage.
    band = diagonal // step
    again = diagonal - band * step < errors[item]
    who = np.concatenate((item, item[again]))
    which = np.concatenate((band, band[again] - 1))
    keys = who * _BANDS + which + _BANDS // 2
    places = np.concatenate((place, place[again]))
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    # A q-gram of the item counts once a band, and only with those within a passage of it.
    distinct = np.append(True, (keys[1:] != keys[:-1]) | (places[1:] != places[:-1]))[: len(keys)]
    keys, places = keys[distinct], places[distinct]
    owner = keys // _BANDS
    last = np.arange(len(keys)) + np.maximum(passage - Q + 1 - Q * errors, 1)[owner] - 1
    first = np.flatnonzero(last < len(keys))
    last = last[first]
    held = (keys[last] == keys[first]) & (places[last] - places[first] <= passage[owner[first]] - Q)
    enough, counts = np.unique(keys[first[held]], return_counts=True)
    enough = enough[np.argsort(-counts, kind="stable")]
    for k, b in zip((enough // _BANDS).tolist(), (enough % _BANDS - _BANDS // 2).tolist()):
        e, width = int(errors[k]), int(passage[k])
        diagonal = b * max(e, 4) - e
        edits, places = align(index.codes[k], doc, diagonal, max(e, 4) + 3 * e + 1)
        cost = edits[width:] - edits[:-width]
        j = int(cost.argmin())
        if cost[j] <= e and (k not in best or cost[j] < best[k][-1]):
            best[k] = k, int(places[j]), int(places[j + width]), j, j + width, int(cost[j])
    for found in best.values():
        yield index.ids[found[0]], *found[1:]


def _search(items: list[tuple[int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items)
        for batch in chunks(batches):
            rows = [(doc_id, *hit) for doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(2)))
                    for hit in leaks(text, index)]
            if rows:
                yield batch_of(_HITS, **dict(zip(_HITS.names, map(list, zip(*rows)))))
    return run


def passes(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in groups of at most ``PASS_CHARS`` characters (one item at least), streamed to the driver."""
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null").distinct()
    for item_id, text in rows.toLocalIterator():
        if held and size + len(text) > PASS_CHARS:
            yield held
            held, size = [], 0
        held.append((item_id, text))
        size += len(text)
    if held:
        yield held


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``HITS``: one row per document and item of which a passage occurs in the document.

    A passage is ``PASSAGE`` characters of an item, or the whole of a shorter
    one, with at most ``ERRORS`` of its characters edited; case and white space
    do not count, and places are those of the text without them. The filter
    loses no such passage: one of ``w`` characters with ``e`` edits shares at
    least ``w - q + 1 - q * e`` q-grams with its place, in one band and within
    ``w`` characters of the item. The alignment runs over the whole item, and the passage with fewest edits is
    reported. Passages without an edit are q-grams in a row and found as such.

    Null, empty and shorter-than-q texts and items match nothing. Rows that
    repeat give repeated rows. The benchmark is searched in passes of bounded
    size, each against all rows of the documents.
    """
    found = None
    plain_docs = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for items in passes(benchmark):
        part = plain_docs.mapInArrow(_search(items), HITS)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], HITS)
