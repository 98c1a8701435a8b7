"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

One inserted or deleted letter changes one count by one; a replaced one changes
two, in opposite directions. So near words are at most two apart in L1 distance.
Words of a length are dealt to the leaves of a tree that is fitted on a sample;
every word visits the leaves that its box of near count vectors meets, for its
own length and the next one. Inside a leaf a tree of its own narrows the search
to a few words, whose order of letters is compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, saved, texts
from tidemark.llm.trees import KdTree

MIN_LETTERS = 6
MIN_COUNT = 5
# A form occurs at least so many times as often as the word.
FACTOR = 5
# One occurrence in so many, by hash, loses a letter.
SLIP = 199

# Words the dealing trees are fitted on; every word is dealt.
SAMPLE = 200_000
# Words of a block: what a task holds, and has a tree for, at once.
BLOCK_WORDS = 8192
BLOCK_BYTES = 1 << 24
# Points of a leaf inside a block.
LEAF = 24
# Query words, and pairs of words, handled together.
QUERIES = 1 << 14
PAIR_BYTES = 1 << 24

DIMS = 32
_DIM = np.array([c - 97 if 97 <= c < 123 else 26 + c % 6 for c in range(256)], dtype=np.int64)
_ROWS = pa.schema([("block", pa.int64()), ("role", pa.int8()), ("letters", pa.int32()), ("word", pa.string()), ("n", pa.int64())])
ROWS = "block long, role byte, letters int, word string, n long"
_NEAR = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])
NEAR = "word string, n long, near string, near_n long"
# Roles, in the order in which a block's rows are read.
MEMBER, SAME, SHORTER = 0, 1, 2


def words_of(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """``(word, n)`` of the words with enough letters and occurrences.

    Shorter runs of letters cannot become words, so only the others leave the
    text. Counts combine before the shuffle.
    """
    lower = F.translate("text", ascii_uppercase, ascii_lowercase)
    runs = F.regexp_extract_all(lower, F.lit(rf"[A-Za-zÀ-ÿ]{{{min_letters},}}"), F.lit(0))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    found = texts(docs).select(name.alias("name"), F.explode(runs).alias("run"))
    hashed = found.select("run", F.crc32(F.concat("name", "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    lost = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word: Column = F.when(F.pmod("h", F.lit(slip)) == 0, lost).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= min_count) & (F.length("word") >= min_letters))


def letter_matrix(words: list[str], length: int) -> np.ndarray:
    """The code points of words of one length; all are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), length)


def count_vectors(letters: np.ndarray) -> np.ndarray:
    """How often each letter occurs; letters outside a-z share six counts. Larger counts are the largest number."""
    n = len(letters)
    out = np.zeros((n, DIMS), dtype=np.uint8)
    step = max(1, PAIR_BYTES // max(1, letters.shape[1] * 8))
    for k in range(0, n, step):
        part = letters[k : k + step]
        flat = (_DIM[part] + np.arange(len(part))[:, None] * DIMS).ravel()
        out[k : k + step] = np.minimum(np.bincount(flat, minlength=len(part) * DIMS).reshape(-1, DIMS), 255)
    return out


def signatures(vectors: np.ndarray) -> np.ndarray:
    """Counts up to four as so many bits: vectors differ by at least the bits that differ."""
    bits = np.minimum(vectors, 4)[:, :, None] > np.arange(4, dtype=np.uint8)
    return np.packbits(bits.reshape(len(vectors), DIMS * 4), axis=1).view(np.uint64)


class Dealer:
    """Where words live: a tree per frequent length, fitted on a sample, and as many blocks per leaf as its words need."""

    def __init__(self, sample: list[str], total: int, block_words: int):
        by_length: dict[int, list[str]] = {}
        for word in sample:
            by_length.setdefault(len(word), []).append(word)
        share = max(1, total) / max(1, len(sample))
        self.trees: dict[int, KdTree] = {}
        for length, words in by_length.items():
            if len(words) * share > block_words:
                size = max(16, int(block_words / share))
                self.trees[length] = KdTree(count_vectors(letter_matrix(words, length)), size, open=True)
        # (length, leaf) → blocks, where there is more than one.
        self.blocks: dict[tuple[int, int], int] = {}

    def leaves(self, length: int, vectors: np.ndarray) -> np.ndarray:
        tree = self.trees.get(length)
        return np.zeros(len(vectors), dtype=np.int64) if tree is None else tree.place(vectors)

    def reach(self, length: int, vectors: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        tree = self.trees.get(length)
        return iter([(0, np.arange(len(vectors)))]) if tree is None else tree.reach(vectors, more, less)

    def count(self, length: int, leaf: int) -> int:
        return self.blocks.get((length, leaf), 1)


def _block(length: int, leaf, part):
    """One number for a length (up to 2**31), a leaf (2**14) and a part of it."""
    return (length << 32) + (leaf << 18) + part


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[str], np.ndarray]]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        counts = batch.column(1).to_numpy()
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for length in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == length)
            step = max(1, min(QUERIES, BLOCK_BYTES // length))
            for k in range(0, len(at), step):
                some = at[k : k + step]
                yield length, [words[i] for i in some.tolist()], counts[some]


def _leaf_sizes(dealer: Dealer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, words, _ in _by_length(batches):
            leaf, many = np.unique(dealer.leaves(length, count_vectors(letter_matrix(words, length))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([length] * len(leaf), pa.int32()), pa.array(leaf, pa.int32()), pa.array(many, pa.int64())],
                                             names=["letters", "leaf", "many"])
    return run


def _deal(dealer: Dealer):
    """Each word as a member of its block and as a query for all blocks that may hold near words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, words, counts in _by_length(batches):
            vectors = count_vectors(letter_matrix(words, length))
            column = pa.array(words)

            def rows(block: np.ndarray, role: int, letters: int, at: np.ndarray) -> pa.RecordBatch:
                return batch_of(_ROWS, block=block, role=np.full(len(at), role, np.int8), letters=np.full(len(at), letters, np.int32),
                                word=column.take(pa.array(at)), n=counts[at])

            every = np.arange(len(words))
            leaf = dealer.leaves(length, vectors)
            part = np.zeros(len(words), dtype=np.int64)
            for one in np.unique(leaf).tolist():
                blocks = dealer.count(length, one)
                if blocks > 1:
                    here = np.flatnonzero(leaf == one)
                    part[here] = [_spread(words[i]) % blocks for i in here.tolist()]
            yield rows(_block(length, leaf, part), MEMBER, length, every)
            for role, other, more, less in ((SAME, length, 1, 1), (SHORTER, length + 1, 1, 0)):
                for one, at in dealer.reach(other, vectors, more, less):
                    for k in range(dealer.count(other, one)):
                        yield rows(np.full(len(at), _block(other, one, k), np.int64), role, other, at)
    return run


def _spread(word: str) -> int:
    out = 0
    for c in word.encode("latin-1"):
        out = (out * 1_000_003 + c) % 2_147_483_647
    return out


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Equal up to some place, and equal behind the letter that ``long`` has there."""
    length = short.shape[1]
    differs = short != long[:, :length]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), length)
    behind = (short != long[:, 1:])[:, ::-1]
    last = np.where(behind.any(axis=1), length - 1 - behind.argmax(axis=1), -1)
    return last < first


class Block:
    """The words of one block, in a tree."""

    def __init__(self, words: list[str], counts: np.ndarray, length: int):
        self.length, self.counts = length, counts
        self.words = np.array(words, dtype=object)
        self.letters = letter_matrix(words, length)
        vectors = count_vectors(self.letters)
        self.signs = signatures(vectors)
        self.tree = KdTree(vectors, LEAF)

    def near(self, words: list[str], shorter: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs ``(query, member)`` exactly one edit apart."""
        letters = letter_matrix(words, self.length - shorter)
        vectors = count_vectors(letters)
        signs = signatures(vectors)
        step = max(1, PAIR_BYTES // (self.length * 4))
        for leaf, at in self.tree.reach(vectors, 1, 0 if shorter else 1):
            members = self.tree.leaves[leaf]
            gap = np.bitwise_count(signs[at][:, None, :] ^ self.signs[members][None, :, :]).sum(axis=2, dtype=np.uint8)
            i, j = np.nonzero(gap <= (1 if shorter else 2))
            for k in range(0, len(i), step):
                q, m = at[i[k : k + step]], members[j[k : k + step]]
                fits = (one_inserted if shorter else one_replaced)(letters[q], self.letters[m])
                if fits.any():
                    yield q[fits], m[fits]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each block, from rows sorted by block and role."""
    now, block, members, counts = None, None, [], []
    for batch in batches:
        numbers, roles, sizes = (batch.column(k).to_numpy() for k in range(3))
        words, many = batch.column(3).to_pylist(), batch.column(4).to_numpy()
        cut = np.flatnonzero((numbers[1:] != numbers[:-1]) | (roles[1:] != roles[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(words)]):
            if a == b:
                continue
            if numbers[a] != now:
                now, block, members, counts = numbers[a], None, [], []
            if roles[a] == MEMBER:
                members += words[a:b]
                counts.append(many[a:b])
                continue
            if not members:
                continue
            if block is None:
                block = Block(members, np.concatenate(counts), int(sizes[a]))
            shorter = roles[a] == SHORTER
            step = max(1, min(QUERIES, BLOCK_BYTES // int(sizes[a])))
            for k in range(a, b, step):
                asked = np.array(words[k : min(k + step, b)], dtype=object)
                asked_n = many[k : min(k + step, b)]
                pairs = list(block.near(asked.tolist(), shorter))
                if not pairs:
                    continue
                q, m = (np.concatenate(x) for x in zip(*pairs))
                out = [(asked[q], asked_n[q], block.words[m], block.counts[m])]
                if shorter:
                    out.append((out[0][2], out[0][3], out[0][0], out[0][1]))
                for word, n, near, near_n in out:
                    yield batch_of(_NEAR, word=pa.array(word, pa.string()), n=n, near=pa.array(near, pa.string()), near_n=near_n)


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS, sample: int = SAMPLE) -> DataFrame:
    """``(word, n, near, near_n)``, both ways, of distinct words ``(word, n)`` exactly one edit apart.

    The dealing trees are fitted on about ``sample`` words, a share by hash and
    never more than twice as many; this decides where words are compared, not which. A leaf with more words
    than a block holds, such as one of anagrams, is cut by hash and asked in
    each part.
    """
    total = words.count()
    # Tasks send only what is taken: an ordered limit would send as many words from each of them.
    share = int(min(1.0, sample / max(1, total)) * (1 << 30))
    taken = (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < share) & (F.length("word") <= BLOCK_BYTES // block_words)
    fitted = words.where(taken).limit(2 * sample).select("word")
    dealer = Dealer([r.word for r in fitted.collect()], total, block_words)
    sizes = words.select("word", "n").mapInArrow(_leaf_sizes(dealer), "letters int, leaf int, many long")
    sizes = sizes.groupBy("letters", "leaf").agg(F.sum("many").alias("many"))
    room = F.least(F.lit(block_words), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / F.col("letters"))))
    full = sizes.withColumn("blocks", F.ceil(F.col("many") / room)).where("blocks > 1")
    dealer.blocks = {(r.letters, r.leaf): int(r.blocks) for r in full.collect()}
    dealt = words.select("word", "n").mapInArrow(_deal(dealer), ROWS)
    return dealt.repartition("block").sortWithinPartitions("block", "role").mapInArrow(_search, NEAR)


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the last word of the chain that starts with ``(word, form)``.

    Each round doubles the steps taken. A form occurs several times as often as
    its word, so chains have no cycles and few words.
    """
    now = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if now.join(on, "root", "left_semi").isEmpty():
            return now
        now = saved(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def spelling_variants(docs: DataFrame, factor: int = FACTOR, block_words: int = BLOCK_WORDS, sample: int = SAMPLE, **words) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per word of the documents.

    Words are runs of Latin letters with A-Z lowered, of six code points and
    five occurrences at least (``words``: other limits of ``words_of``). Two are
    near if one replaced, inserted or deleted code point turns one into the
    other. A word's form is its most frequent near word, the first in code-point
    order of equals, if that has at least ``factor`` times its occurrences;
    ``root`` is where following forms ends.

    A null text has no words, a null ``doc_id`` is written as nothing before the
    colon of the hash. Rows that repeat an id count each time. Other columns,
    whatever their names, are not looked at. Tables without such words give no
    rows.
    """
    found = saved(words_of(docs, **words), "spelling-words")
    near = near_words(found, block_words, sample).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    own = -F.col("best.less") >= factor * F.col("n")
    near = saved(near.select(
        "word", "n_near", F.when(own, F.col("best.near")).alias("form"), F.when(own, -F.col("best.less")).alias("form_n")), "spelling-near")
    last = roots(near.where("form is not null"))
    return found.join(near, "word", "left").join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
