"""Packing token sequences into windows of fixed length by minimum bin slack."""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, chunks, saved, texts, worker_state
from tidemark.llm.rolling import WORD_CODES, Prefix, U, mix

# Pieces a window may leave unfilled before its pieces are cut up instead, as a share.
MAX_SLACK = 0.005
# Words whose ids a Python worker remembers at once.
CACHE_WORDS = 2_000_000

_BLANK, _MARK, _LETTER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_BLANK[[10, 32]] = _MARK[[44, 46]] = _LETTER[65:91] = _LETTER[97:123] = True

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()), ("binary_crc32", pa.list_(pa.int64())),
])
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long, binary_crc32 array<bigint>"
_PLACED = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Words:
    """Ids of texts by a tokenizer whose words end at blanks: each distinct word is encoded once.

    Words are runs without blank or line feed, with A-Z lowered; a full stop or
    comma that ends a word after a letter is a word of its own. They are told
    apart by 64-bit hashes. Words of letters only are encoded many at a time;
    each of them ends with the one id in it that marks an end.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_end[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        # Sorted hashes of the words known; where their ids are.
        self.known, self.starts, self.sizes = np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0

    def _store(self, ids: np.ndarray) -> int:
        start = self.used
        self.used += len(ids)
        while self.used > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[start : self.used] = ids
        return start

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of the words are stored, and how many they are."""
        starts, sizes = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        plain = np.fromiter(map(str.isalpha, words), dtype=bool, count=len(words))
        letters = np.flatnonzero(plain)
        if len(letters):
            joined = " ".join([words[k] for k in letters.tolist()])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=np.uint32)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(letters) and ends[-1] == len(ids):
                sizes[letters] = np.diff(ends, prepend=0)
                starts[letters] = self._store(ids) + ends - sizes[letters]
            else:
                plain[:] = False
        rest = np.flatnonzero(~plain).tolist()
        for k, found in zip(rest, self.tokenizer.encode_batch_fast([words[k] for k in rest], add_special_tokens=False)):
            starts[k], sizes[k] = self._store(np.array(found.ids, dtype=np.uint32)), len(found.ids)
        return starts, sizes

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if any("<|" in t for t in texts):  # may hold a special token, whose case matters
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype=np.uint32) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.clear()
        encoded = [t.encode() for t in texts]
        data = b"\n".join(encoded) + b"\n"
        chars = np.frombuffer(data, dtype=np.uint8)
        inside = ~_BLANK[chars]
        mark = np.zeros(len(chars), dtype=bool)
        mark[1:-1] = _MARK[chars[1:-1]] & _LETTER[chars[:-2]] & ~inside[2:]
        first = np.flatnonzero(inside & (mark | np.concatenate(([True], ~inside[:-1]))))
        last = np.flatnonzero(inside[:-1] & (mark[1:] | ~inside[1:])) + 1
        hashes = mix(Prefix(WORD_CODES[chars]).spans(first, last) + (last - first).astype(U))
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != distinct
        if new.any():
            begin, end = first[where[new]].tolist(), last[where[new]].tolist()
            low = data.lower()
            starts, sizes = self._encode([low[a:b].decode() for a, b in zip(begin, end)])
            self.known = np.insert(self.known, at[new], distinct[new])
            self.starts, self.sizes = np.insert(self.starts, at[new], starts), np.insert(self.sizes, at[new], sizes)
            at = np.searchsorted(self.known, distinct)
        starts, sizes = self.starts[at][inverse], self.sizes[at][inverse]
        total = np.cumsum(sizes)
        flat = self.flat[np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)]
        upto = np.searchsorted(first, np.cumsum([len(e) + 1 for e in encoded]))
        return np.split(flat, np.concatenate(([0], total))[upto[:-1]])


def halves(length: int) -> list[int]:
    """The powers of two that sum up to the length, largest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids)


def _pieces(path: str, end_id: int, window: int):
    """Full windows of each document, then the rest; each numbered within its task and length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = worker_state("words"), defaultdict(int)
        if path not in state:
            state[path] = Words(path)
        words = state[path]
        part = TaskContext.get().partitionId()
        for batch in chunks(batches):
            rows = []
            doc_ids, values = (batch.column(k).to_pylist() for k in range(2))
            for doc_id, ids in zip(doc_ids, words.ids(values)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    n, cuts = len(piece), []
                    if n < window:
                        at = 0
                        for size in halves(n):
                            cuts.append(_crc(piece[at : at + size]))
                            at += size
                    rows.append((doc_id, start, n, _crc(piece), len(ids), part, seen[n], cuts))
                    seen[n] += 1
            yield batch_of(_PIECES, **dict(zip(_PIECES.names, map(list, zip(*rows)))))
    return run


def best_fill(seed: int, counts: dict[int, int], lengths: list[int], window: int) -> dict[int, int]:
    """The multiset with the seed, of the lengths at hand, whose sum comes closest to the window.

    Reachable sums are the bits of one integer. Lengths join longest first,
    each as often as it is at hand, by doubling; the run ends once the window
    is full, and the counts are traced back through the sums reached before.
    """
    room = window - seed
    full, mask = 1 << room, (2 << room) - 1
    reach, trail = 1, []
    for length in lengths:
        have = counts[length] - (length == seed)
        if length > room or have <= 0:
            continue
        have = min(have, room // length)
        trail.append((length, have, reach))
        step = 1
        while have:
            take = min(step, have)
            reach |= reach << (take * length) & mask
            have -= take
            step *= 2
        if reach & full:
            break
    left = reach.bit_length() - 1
    out = {seed: 1}
    for length, have, before in reversed(trail):
        used = 0
        while used <= have and not (left - used * length >= 0 and before >> (left - used * length) & 1):
            used += 1
        if used:
            out[length] = out.get(length, 0) + used
            left -= used * length
    return out


class Plan:
    """Where the nth piece of each length goes. Its size depends on the window, not on the corpus."""

    def __init__(self, counts: dict[int, int], window: int, max_slack: float = MAX_SLACK):
        self.window = window
        left = {k: v for k, v in counts.items() if v}
        taken: dict[int, int] = defaultdict(int)
        slots: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
        loose: dict[int, int] = {}
        lengths = sorted(left, reverse=True)
        bins = 0
        while lengths:
            seed = lengths[0]
            fill = best_fill(seed, left, lengths, window)
            if window - sum(k * v for k, v in fill.items()) > max_slack * window:
                loose[seed] = left.pop(seed)  # nothing fills a window with it: all of these are cut up
                lengths.pop(0)
                continue
            times = min(left[k] // v for k, v in fill.items())
            offset = 0
            for length, each in sorted(fill.items(), reverse=True):
                # first rank, how many a window, first window, offset there
                slots[length].append((taken[length], each, bins, offset, taken[length] + each * times))
                taken[length] += each * times
                left[length] -= each * times
                offset += each * length
            bins += times
            lengths = [k for k in lengths if left.get(k)]
        self.slots = {k: np.array(v, dtype=np.int64).T for k, v in slots.items()}
        # Loose pieces become powers of two, laid end to end from the longest: none crosses a window's edge.
        self.loose = {k: (taken[k], taken[k] + n) for k, n in loose.items()}
        self.base, at = {}, 0
        for power in (1 << k for k in range(window.bit_length(), -1, -1)):
            for length in sorted(loose, reverse=True):
                if power in halves(length):
                    self.base[length, power] = at
                    at += loose[length] * power
        self.bins, self.tail = bins, at

    def place(self, length: int, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, each, start, offset, _ = self.slots[length]
        k = np.searchsorted(first, nth, side="right") - 1
        within = nth - first[k]
        return start[k] + within // each[k], offset[k] + within % each[k] * length

    def place_loose(self, length: int, power: int, nth: int) -> tuple[int, int]:
        at = self.base[length, power] + (nth - self.loose[length][0]) * power
        block, rest = divmod(at, self.window)
        if block < self.tail // self.window:
            return self.bins + block, rest
        # The last stretch ends as sequences of powers of two, which need no padding.
        number, begin = self.bins + block, 0
        for size in halves(self.tail % self.window):
            if rest < begin + size:
                return number, rest - begin
            begin, number = begin + size, number + 1
        raise AssertionError("outside the stream")


def _placed(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: batch.column(k).to_numpy(zero_copy_only=False) for k, n in enumerate(batch.schema.names)
                    if n not in ("doc_id", "binary_crc32")}
            length, nth = cols["length"], cols["nth"]
            sequence, offset = np.zeros(len(nth), dtype=np.int64), np.zeros(len(nth), dtype=np.int64)
            loose = np.zeros(len(nth), dtype=bool)
            for n in np.unique(length).tolist():
                rows = np.flatnonzero(length == n)
                cut = n in plan.loose
                mine = rows[nth[rows] < plan.loose[n][0]] if cut else rows
                loose[rows] = cut
                loose[mine] = False
                if len(mine):
                    sequence[mine], offset[mine] = plan.place(n, nth[mine])
            whole = ~loose
            doc_ids, crcs = batch.column(0), batch.column(batch.schema.get_field_index("binary_crc32"))
            yield batch_of(
                _PLACED, doc_id=doc_ids.filter(pa.array(whole)), start=cols["start"][whole], length=length[whole],
                ids_crc32=cols["ids_crc32"][whole], doc_tokens=cols["doc_tokens"][whole],
                sequence_id=sequence[whole], offset=offset[whole],
            )
            rows = []
            for k in np.flatnonzero(loose).tolist():
                at, total = int(cols["start"][k]), int(cols["doc_tokens"][k])
                for size, crc in zip(halves(int(length[k])), crcs[k].as_py()):
                    rows.append((doc_ids[k].as_py(), at, size, crc, total, *plan.place_loose(int(length[k]), size, int(nth[k]))))
                    at += size
            if rows:
                yield batch_of(_PLACED, **dict(zip(_PLACED.names, map(list, zip(*rows)))))
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = 4096, max_slack: float = MAX_SLACK) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row per piece.

    A document's ids and ``end_id`` are cut into full windows and a rest. The
    rests are packed by their counts per length, at most ``window`` numbers:
    the longest left is the seed, and a bitset dynamic programme finds the
    multiset that fills its window closest; the pattern repeats as long as the
    counts allow. Where no multiset comes within ``max_slack`` of the window,
    the seed's rests are cut into powers of two, which fill windows exactly.
    The padding is thus at most ``max_slack`` of the sequences.

    A null or empty text is the end id alone. Rows that repeat an id are
    documents of their own. An empty table gives no rows.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    pieces = saved(
        texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _pieces(tokenizer, end_id, window), PIECES), "packing-pieces")
    counted = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(counts, window, max_slack)
    before = counted.select("length", "part", (F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.join(before, ["length", "part"]).select(
        *[c for c in _PIECES.names if c not in ("nth", "part")], (F.col("nth") + F.col("before")).alias("nth"))
    return ranked.mapInArrow(_placed(plan), PLACED)
