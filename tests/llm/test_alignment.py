"""Alignment of tokenizers against a plain version with sets and dictionaries."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, a int, b int, block string, docs string, at int, count int"


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(A, B)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    words = "the of and thing ether ought sand river Stone's mother lamp cold, under never green 1234 77% naïve".split()
    made = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 60))) for _ in range(40)]
    odd = [None, "", " ", "  two  spaces ", "\n\n\t x\r\n", "<|endoftext|> <s> </s> <0x41>", "é😀 中文字符 ありがとう", "▁ own mark", "\u0000\u0001",
           "=" * 700 + "-" * 300, " " * 1500 + "." * 900, "a" * 1_100_000, "ab c" * 400]
    found = [(k, t) for k, t in enumerate(odd + made)]
    return found + [found[20], found[20], (20, "other text"), (None, made[3]), (None, None)]


def plain(rows, pair):
    each = []
    for doc_id, text in rows:
        text = text or ""
        ids_a = pair.a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = pair.b.encode(text) if text else []
        data = (" " + text).encode()
        if b"".join(pair.bytes_a[i] for i in ids_a) != data or b"".join(pair.bytes_b[i] for i in ids_b) != data:
            ids_a, ids_b = [], []
        groups, i, j = [], 0, 0
        while i < len(ids_a):
            group, end_a, end_b = ([], []), 0, 0
            while not end_a or end_a != end_b:
                if end_a <= end_b:
                    group[0].append(ids_a[i])
                    end_a += len(pair.bytes_a[ids_a[i]])
                    i += 1
                else:
                    group[1].append(ids_b[j])
                    end_b += len(pair.bytes_b[ids_b[j]])
                    j += 1
            groups.append(group)
        links = collections.Counter()
        for x, y in groups:
            times_x, times_y = collections.Counter(x), collections.Counter(y)
            for p, n in times_x.items():
                for q, m in times_y.items():
                    links[p, q] += n * m
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        each.append((doc_id, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(line.encode()).hexdigest() if groups else ""))
    count = collections.Counter(p for row in each for p in row[4])
    most = collections.defaultdict(int)
    for (p, _), n in count.items():
        most[p] = max(most[p], n)
    return sorted(((d, na, nb, g, sum(k.values()), sum(m for p, m in k.items() if count[p] == most[p[0]]),
                    sum(m * count[p] for p, m in k.items()), h) for d, na, nb, g, k, h in each), key=repr), count


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "b", "d", 3, 4) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("postings", [alignment.BLOCK_POSTINGS, 50])
def test_equal_to_plain_version(spark, rows, pair, postings):
    found = sorted(map(tuple, alignment.token_alignment(frame(spark, rows), A, B, postings).collect()), key=repr)
    assert found == plain(rows, pair)[0]


def test_faster_library_has_the_same_ids(pair):
    draw = random.Random(9)
    letters = "abcXYZ' '  \t\n\r.,-=019éßÀɏ£½²ª'stllve<|>"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 80))) for _ in range(3000)] + [" ", "a  ", "\n ", "'ll 's", "<|endoftext|>"]
    assert pair.fast is not None
    for text in texts:
        assert pair.ids_a(text).tolist() == pair.a.encode(text, add_special_tokens=False).ids
    # A vocabulary with other rules keeps its own library.
    assert alignment.Pair(public_tokenizers.path("word_bpe_49k.json"), B).fast is None


def test_counts_of_pairs(spark, rows, pair):
    counts = alignment.pair_counts(alignment.aligned(frame(spark, rows), A, B)).collect()
    assert {(r.a, r.b): r.n_docs for r in counts} == dict(plain(rows, pair)[1])
    assert sum(r.n_links for r in counts) == sum(r[4] for r in plain(rows, pair)[0])


def test_blocks_of_short_texts_are_dense(spark, pair):
    rows = [(k, "one" if k % 3 else "one one one") for k in range(400)]
    found = alignment.aligned(frame(spark, rows).coalesce(1), A, B)
    assert found.where("dense").count() == 2
    got = sorted(map(tuple, alignment.token_alignment(frame(spark, rows), A, B).collect()), key=repr)
    assert got == plain(rows, pair)[0]


def test_containers_give_back_their_documents():
    draw = np.random.default_rng(1)
    runs = [np.sort(draw.choice(1000, n, replace=False)) for n in (1, 2, 62, 63, 64, 500, 1000)]
    packed, dense = alignment.containers(np.concatenate(runs), np.array([len(r) for r in runs]), 1000)
    assert dense.tolist() == [False, False, False, True, True, True, True]
    for run, container, d in zip(runs, packed.to_pylist(), dense.tolist()):
        assert alignment.members(container, d).tolist() == run.tolist()


def test_empty_tables(spark, rows):
    assert alignment.token_alignment(frame(spark, rows).limit(0), A, B).isEmpty()
    none = alignment.token_alignment(frame(spark, [(1, None), (2, "")]), A, B).collect()
    assert sorted(map(tuple, none)) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)]
