"""Vectorised hashes of windows and words: numpy on 64-bit words that wrap around."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
# Bytes whose words are hashed together: bounds the arrays.
PIECE = 1 << 20
_BREAK = re.compile(rb"[ \t-\r]")
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word (splitmix64's finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=U) * U(BASES[0]))


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse for ``i < n``."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, dtype=U)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        held = out[0], out[1]
        if size <= 1 << 22:
            _POWERS[base] = held
    return held


class Prefix:
    """Hashes of any window of a sequence of 64-bit codes; equal windows have equal hashes, wherever they stand."""

    def __init__(self, codes: np.ndarray, base: int = BASES[0]):
        up, self.down = powers(len(codes) + 1, base)
        self.sums = np.zeros(len(codes) + 1, dtype=U)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def windows(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` elements."""
    n = len(x)
    blocks = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    blocks[:n] = x
    blocks = blocks.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


# A-Z as a-z, all other bytes as they are.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
WORD_CODES = mix((_LOWER.astype(U) + U(1)) * U(BASES[1]))


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[bytes], bool]]:
    """Texts together up to ``PIECE`` bytes; a longer one in parts that end at white space, all but its last marked."""
    held, size = [], 0
    for text in texts:
        if size + len(text) > PIECE and held:
            yield held, False
            held, size = [], 0
        begin = 0
        while len(text) - begin > PIECE:
            cut = _BREAK.search(text, begin + PIECE // 2)
            if cut is None:
                break
            yield [text[begin : cut.start()]], True
            begin = cut.start()
        held.append(text[begin:])
        size += len(text) - begin
    if held:
        yield held, False


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and the number of words per text.

    Words are what ASCII white space separates, with A-Z lowered; a word's hash
    depends on its bytes alone.
    """
    hashes, counts, carried = [], [], 0
    for part, unfinished in _pieces(texts):
        found, sizes = _word_hashes(part)
        hashes.append(found)
        sizes[0] += carried
        carried = int(sizes[0]) if unfinished else 0
        if not unfinished:
            counts.append(sizes)
    if not hashes:
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = _SPACE[joined]
    inside = ~space
    first = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
    last = np.flatnonzero(inside[:-1] & space[1:]) + 1
    if not len(first):
        return np.zeros(0, dtype=U), np.zeros(len(texts), dtype=np.int64)
    up, down = powers(len(joined) + 1, BASES[1])
    sums = np.zeros(len(joined) + 1, dtype=U)
    np.cumsum(WORD_CODES[joined] * up[: len(joined)], out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(U))
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
    upto = np.searchsorted(first, ends)
    return hashes, np.diff(upto, prepend=0)


def joined_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; runs cross texts, callers mask those."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    out = np.zeros(n, dtype=U)
    for k in range(size):
        out = mix(out * U(BASES[0]) + words[k : k + n] + U(k + 1))
    return out
