"""Jaccard join of word n-gram sets by vertical partitioning.

The n-grams stand in one global order, which is cut into fragments. First a
coarse order by hash: two similar sets differ in few n-grams, so of enough
fragments one holds the same n-grams in both; sets that share no whole fragment
with another set leave here. Among the others the order is by frequency, rarest
first; two similar sets share an n-gram of their prefixes. The pairs found are
settled by counting their overlaps per fragment and adding up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.joins import measured
from tidemark.llm.common import batch_of, chunks, saved, texts
from tidemark.llm.components import components
from tidemark.llm.rolling import BASES, U, joined_hashes, mix, word_hashes

# N-grams of a pair that are counted together.
FRAGMENT = 2048

_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set", pa.binary()), ("short", pa.int64())])
_KEYS = pa.schema([("key", pa.int64()), ("short", pa.int64()), ("rule", pa.int64())])
# A rule is a number of keys and, in its last digits, the size class they belong to.
CLASSES = 64
_GRAMS = pa.schema([("set", pa.binary()), ("n", pa.int64()), ("grams", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])
# Words of 64 bits in a set's bitmap.
BITMAP = 4


def gram_sets(values: list[str], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's ``size``-word shingles.

    Fewer words make one shingle; a text without words has none.
    """
    encoded = [v.encode() for v in values]
    words, counts = word_hashes(encoded)
    grams = joined_hashes(words, size)
    at = 0
    for n in counts.tolist():
        if n >= size:
            yield np.unique(grams[at : at + n - size + 1])
        elif n:
            yield joined_hashes(words[at : at + n], n)
        else:
            yield grams[:0]
        at += n


def _key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def _short(key: bytes) -> int:
    """The part of a set's key that goes with each of its fragments."""
    return int.from_bytes(key[:8], "little", signed=True)


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets = list(gram_sets(batch.column(1).to_pylist(), size))
            keys = [_key(s) if len(s) else None for s in sets]
            yield batch_of(
                _SETS, doc_id=batch.column(0), n=[len(s) for s in sets], set=keys,
                short=[None if k is None else _short(k) for k in keys])
    return run


def fragments(n: int, percent: int) -> tuple[int, int]:
    """How many fragments sets of ``2**k <= n < 2**(k+1)`` n-grams are cut into, and ``k``."""
    k = n.bit_length() - 1
    differ = 2 * ((2 << k) - 1) * (100 - percent) // (100 + percent)
    return differ + differ // 8 + 2 if differ else 1, k


def _fragment_keys(grams: np.ndarray, cuts: int, salt: int) -> tuple[np.ndarray, int]:
    """A key for each fragment with n-grams: a hash of what it holds. And how many have none."""
    if cuts <= 1:
        place = np.zeros(1, dtype=np.int64)
        head = np.zeros(1, dtype=np.int64)
    else:
        width = U((1 << 64) // cuts + 1)
        where = (grams // width).astype(np.int64)
        head = np.concatenate(([0], np.flatnonzero(where[1:] != where[:-1]) + 1))
        place = where[head]
    held = np.add.reduceat(mix(grams), head)
    return mix(held * U(BASES[0]) + place.astype(U) * U(BASES[1]) + U(salt + 1)), cuts - len(head)


def _coarse(size: int, percent: int):
    """Keys that two linked sets share, one for each fragment of a set.

    Linked sets of up to ``most`` n-grams differ in fewer n-grams than there are
    fragments, and an n-gram spoils one fragment: the rest, but for empty ones,
    are keys of both. The rule says how many at least. A set that may be larger
    after linking also has the keys of the next larger sets. Where so many
    fragments are empty that the rest might all differ, the n-grams of the
    prefix in hash order are keys too, and one is enough.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            keys, names, rules = [], [], []
            for grams in gram_sets(batch.column(0).to_pylist(), size):
                n = len(grams)
                if not n:
                    continue
                largest = n * 100 // percent
                name = _short(_key(grams))
                differ = (n + largest) * (100 - percent) // (100 + percent)
                for k in sorted({n.bit_length() - 1, largest.bit_length() - 1}):
                    cuts, k = fragments(1 << k, percent)
                    found, empty = _fragment_keys(grams, cuts, k)
                    common = cuts - empty - differ
                    if common <= 0:
                        prefix = n - -(-n * percent // 100) + 1
                        found = np.concatenate([found, mix(grams[:prefix] + U(1 << 32 | k))])
                    keys.append(found)
                    names.append(np.full(len(found), name, dtype=np.int64))
                    rules.append(np.full(len(found), max(1, common) * CLASSES + k, dtype=np.int64))
            if keys:
                yield batch_of(
                    _KEYS, key=np.concatenate(keys).view(np.int64), short=np.concatenate(names), rule=np.concatenate(rules))
    return run


def bitmap(grams: np.ndarray) -> np.ndarray:
    """Parities of the n-grams by hash: two sets differ in at least as many n-grams as their bitmaps in bits."""
    odd = np.bincount((grams % U(64 * BITMAP)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _grams(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets = [s for s in gram_sets(batch.column(0).to_pylist(), size) if len(s)]
            if sets:
                yield batch_of(_GRAMS, set=[_key(s) for s in sets], n=[len(s) for s in sets],
                               grams=[s.view(np.int64) for s in sets], bits=[bitmap(s) for s in sets])
    return run


def _need(a, b, percent: int):
    """Least overlap of linked sets of ``a`` and ``b`` n-grams."""
    return F.ceil((a + b) * percent / (100.0 + percent) - 1e-9)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose partial overlaps add up to enough."""
    parts = F.greatest(F.lit(1), (F.least("na", "nb") / FRAGMENT).cast("int"))
    cut = pairs.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    inside = F.filter("grams", lambda g: F.pmod(g, F.col("parts")) == F.col("part"))

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.join(sets.select(F.col("id").alias(name), "grams"), name).withColumn(
            f"{name}_grams", F.when(F.col("parts") == 1, F.col("grams")).otherwise(inside)).drop("grams")

    # Only sets of a pair travel; where they are many, this join has the partitioning of the next ones.
    asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = sets.join(measured(asked), "id", "left_semi")
    both = side(side(cut, "a"), "b").withColumn("shared", F.size(F.array_intersect("a_grams", "b_grams")))
    return both.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared")).where(
        (100 + percent) * F.col("shared") >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def jaccard_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per document.

    Two documents link when ``100 * intersection >= percent * union`` of their
    sets of distinct ``size``-word shingles (A-Z lowered; words are what ASCII
    white space separates; fewer words make one shingle). ``component_id`` is
    the smallest ``doc_id`` reachable by links.

    A null text is empty; documents without words link with nothing. A null
    ``doc_id`` is larger than any number. Equal sets count once, so copies cost
    nothing; rows that repeat an id are documents of that id.
    """
    plain = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = saved(plain.mapInArrow(_sets(size), "doc_id long, n long, set binary, short long"), "jaccard-sets")

    # Sets that share enough whole fragments with other sets. Copies have the same keys, each of them.
    keys = plain.select("text").mapInArrow(_coarse(size, percent), "key long, short long, rule long")
    same_key = W.partitionBy("key")
    shared = (
        keys.repartition("key").withColumn("low", F.min("short").over(same_key)).withColumn("high", F.max("short").over(same_key))
        .where("low != high").groupBy("short", "rule").agg(F.count("*").alias("hits")))
    each = found.where("set is not null").groupBy("set", "short").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    firsts = saved(
        each.join(shared, "short").where(F.col("hits") >= F.floor(F.col("rule") / CLASSES) * F.col("copies"))
        .select("set", "doc_id").distinct(), "jaccard-near")
    near = firsts.select("set")
    # A set may have no owner with an id: null counts as one.
    wanted = firsts.select(F.col("doc_id").alias("wanted_id")).distinct()
    grams = plain.join(measured(wanted), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text").mapInArrow(
        _grams(size), "set binary, n long, grams array<bigint>, bits array<bigint>")
    sets = saved(
        grams.join(near, "set", "left_semi").dropDuplicates(["set"])
        .withColumn("id", F.monotonically_increasing_id()), "jaccard-grams")

    # Prefixes in order of frequency.
    exploded = sets.select("id", F.explode("grams").alias("gram"))
    often = exploded.repartition("gram").withColumn("often", F.count("*").over(W.partitionBy("gram"))).where("often > 1")
    ordered = often.groupBy("id").agg(
        F.count("*").alias("common"), F.sort_array(F.collect_list(F.struct("often", "gram"))).alias("grams"))
    # N-grams of one set only come first in the order; they fill the prefix and link nothing.
    room = F.col("n") - F.ceil(F.col("n") * percent / 100.0 - 1e-9) + 1 - (F.col("n") - F.col("common"))
    prefixes = saved(
        ordered.join(sets.select("id", "n", "bits"), "id").where(room > 0)
        .select("id", "n", "bits", (F.col("n") - F.col("common")).alias("lone"), F.posexplode(F.slice("grams", 1, room.cast("int"))).alias("at", "g"))
        .select("id", "n", "bits", (F.col("lone") + F.col("at")).alias("at"), F.col("g.gram").alias("gram")), "jaccard-prefixes")
    links = _links(prefixes, sets.select("id", "grams"), percent)
    roots = components(links).join(sets.select(F.col("id").alias("node"), "set"), "node").select("set", "root")
    # Copies first: one row per set, then one per component. Both are written, so that no plan repeats what leads to them.
    own = saved(
        found.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("own_id")).join(roots, "set", "left"), "jaccard-own")
    least = own.where("root is not null").groupBy("root").agg(F.min("own_id").alias("component_id"))
    placed = saved(
        own.join(least, "root", "left").select("set", F.coalesce("component_id", "own_id").alias("component_id")), "jaccard-placed")
    return found.join(placed, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _links(prefixes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links enough to connect all linked sets.

    Each group of sets with a common prefix n-gram is first joined to its
    smallest set and then, once more, to the smallest of the sets that found no
    link there. What is then still in different components is compared pair
    by pair, so no link between components is missed.
    """
    done = links = None
    group = W.partitionBy("gram")
    rows = prefixes
    # At the first n-gram that two sets share, all before it are theirs alone: so many may differ, so many are left to share.
    fits = (100 - percent) * F.least(F.col("na") - F.col("at_a"), F.col("nb") - F.col("at_b")) >= percent * (
        F.col("at_a") + F.col("at_b") + F.abs((F.col("na") - F.col("at_a")) - (F.col("nb") - F.col("at_b"))))
    # Both bitmaps differ in no more bits than the sets may in n-grams.
    apart = sum((F.bit_count(F.col("bits_a")[k].bitwiseXOR(F.col("bits_b")[k])) for k in range(BITMAP)), F.lit(0))
    fits = fits & ((100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb")))
    for _ in range(2):
        stars = rows.withColumn("hub", F.min(F.struct("id", "n", "at", "bits")).over(group)).where("id != hub.id").select(
            F.col("hub.id").alias("a"), F.col("id").alias("b"), F.col("hub.n").alias("na"), F.col("n").alias("nb"),
            F.col("hub.at").alias("at_a"), F.col("at").alias("at_b"),
            F.col("hub.bits").alias("bits_a"), F.col("bits").alias("bits_b"))
        pairs = stars.where(fits).select("a", "b", "na", "nb").distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = saved(pairs, "jaccard-pairs")
        new = saved(_linked(pairs, sets, percent), "jaccard-links")
        links = new if links is None else links.unionByName(new)
        done = pairs.select("a", "b") if done is None else done.unionByName(pairs.select("a", "b"))
        roots = saved(components(links), "jaccard-roots")
        placed = prefixes.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn(
            "root", F.coalesce("root", "id"))
        parted = saved(
            placed.withColumn("low", F.min("root").over(group)).withColumn("high", F.max("root").over(group))
            .where("low != high").select("gram", "id", "n", "at", "bits", "root"), "jaccard-parted")
        # Next round: the sets outside the component that the first hub is in.
        hubs = parted.withColumn("hub", F.min(F.struct("id", "root")).over(group))
        rows = hubs.where("root != hub.root").select("gram", "id", "n", "at", "bits")
    left, right = (
        parted.select("gram", F.col("id").alias(one), F.col("n").alias(f"n{one}"), F.col("at").alias(f"at_{one}"), F.col("bits").alias(f"bits_{one}"),
                      F.col("root").alias(f"root_{one}")) for one in "ab")
    rest = left.join(right, "gram").where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & fits).select(
        "a", "b", "na", "nb").distinct()
    rest = saved(rest.join(done, ["a", "b"], "left_anti"), "jaccard-rest")
    return saved(links.unionByName(_linked(rest, sets, percent)), "jaccard-all-links")
