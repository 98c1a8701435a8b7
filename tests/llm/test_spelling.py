"""Spelling variants against a comparison of all words."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import spelling
from tidemark.llm.trees import KdTree

SCHEMA = "doc_id long, text string, word string, n string, block int, letters string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(word, letters):
    for k in range(len(word) + 1):
        yield word[:k] + word[k + 1 :]
        for c in letters:
            yield word[:k] + c + word[k:]
            yield word[:k] + c + word[k + 1 :]


def plain(rows, slip=199, least=6, often=5, factor=5):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= often}
    letters = sorted(set("".join(words)))
    near = {w: {e for e in edits(w, letters) if e in words and e != w} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda e: (-words[e], e), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words.get(form[w], 0)) for w, n in words.items())


def got(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def mutated(draw, word, letters):
    return draw.choice(sorted(set(edits(word, letters))))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    letters = "abcdeé×ß"
    base = ["".join(draw.choice(letters) for _ in range(draw.randint(5, 12))) for _ in range(60)]
    words = []
    for word in base:
        words += [word] * draw.choice([1, 5, 30, 200])
        for _ in range(6):
            other = mutated(draw, word, letters)
            words += [other] * draw.randint(1, 12)
            words += [mutated(draw, other, letters)] * draw.randint(1, 8)
    words += ["listen"] * 9 + ["silent"] * 9 + ["tinsel"] * 9 + ["ÀÉÎÕÜý"] * 7 + ["àéîõüý"] * 7 + ["straße"] * 5
    words += ["z" * 2000] * 6 + ["z" * 1999] * 40 + ["chained"] * 900 + ["chaind"] * 90 + ["chind"] * 9 + ["chaindo"] * 8 + ["short"] * 50
    draw.shuffle(words)
    docs, at = [], 0
    while at < len(words):
        n = draw.randint(1, 90)
        docs.append((len(docs) % 40 if len(docs) % 7 else None, draw.choice([" ", "\n", ", 3"]).join(
            w.upper() if w.isascii() and draw.random() < 0.2 else w for w in words[at : at + n])))
        at += n
    return docs + [(900, None), (901, ""), docs[5], docs[5], docs[5], docs[5], docs[5], (902, "Nothing-here 12 45")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "w", "n", 1, "l") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("block_words,sample", [(8192, 200_000), (8, 200_000), (5, 40)])
def test_equal_to_all_edits(spark, rows, block_words, sample):
    found = got(spelling.spelling_variants(frame(spark, rows), block_words=block_words, sample=sample, slip=7))
    want = plain(rows, slip=7)
    assert found == want and len(found) > 100 and any(r[1] and r[2] != r[1] for r in found)


def test_default_slip(spark, rows):
    assert got(spelling.spelling_variants(frame(spark, rows))) == plain(rows)


def test_anagrams_fill_several_blocks(spark):
    draw = random.Random(1)
    words = sorted({"".join(draw.sample("abcdefg", 7)) for _ in range(300)})
    rows = [(k, " ".join(words + [w[:3] + w[4:] for w in words[:40]] + ["q" + w[1:] for w in words[:40]])) for k in range(6)]
    assert got(spelling.spelling_variants(frame(spark, rows), block_words=16, slip=10**9)) == plain(rows, slip=10**9)


def test_tables_without_words(spark):
    none = frame(spark, [(1, None), (2, "a bc def"), (3, "once only here")])
    assert spelling.spelling_variants(none).isEmpty() and spelling.spelling_variants(none.limit(0)).isEmpty()


def test_tree_reaches_all_points_in_range():
    draw = np.random.default_rng(2)
    points = draw.integers(0, 4, (500, 6)).astype(np.uint8)
    asked = draw.integers(0, 4, (60, 6)).astype(np.uint8)
    gap = points[None].astype(int) - asked[:, None].astype(int)
    for more, less in ((1, 1), (1, 0), (0, 0)):
        near = (np.maximum(gap, 0).sum(2) <= more) & (np.maximum(-gap, 0).sum(2) <= less)
        for tree in (KdTree(points, 8), KdTree(points, 8, open=True)):
            met = np.zeros_like(near)
            for leaf, at in tree.reach(asked, more, less):
                met[np.ix_(at, tree.leaves[leaf])] = True
            assert not (near & ~met).any() and met.mean() < 0.5
    tree = KdTree(points[:100], 8, open=True)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(100)) and len(tree.place(points)) == 500
