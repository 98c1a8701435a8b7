"""Repeated lines: an edit-distance join by segments, as DataFrame operations only.

Lines within ``EDITS`` edits of each other have, among ``EDITS + 1`` segments of
one, a segment that the other holds unchanged, near its place. Segments are
index keys together with the line's length; each line probes the lengths up to
``EDITS`` below its own at the few places where the segment can be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.joins import measured
from tidemark.llm.common import numbered, saved, texts
from tidemark.llm.components import components

EDITS = 2
# Shorter lines link only if they are equal: two edits would join different ones.
MIN_CHARS = 24
# Letters that are counted to tell lines apart before the edit distance, eight a number.
LETTERS = ("etanirso", "hldcumgw")
LAST = (1 << 63) - 1


def lines_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, line)`` of all lines."""
    return texts(docs).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def _probes(edits: int) -> list[tuple[int, int, int, bool]]:
    """``(shorter, segment, shift, index)``: lengths to probe, where their segments may be, which are index keys."""
    return [
        (shorter, i, shift, shorter == 0 and shift == 0)
        for shorter in range(edits + 1) for i in range(edits + 1)
        for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1)
    ]


def _keyed(lines: DataFrame, edits: int) -> DataFrame:
    """``(key, index, ref)``: index and probe keys of each line. The probes are rows, so that the code per row stays small."""
    parts = edits + 1
    probes = F.array(*[F.struct(*(F.lit(v).alias(n) for v, n in zip(p, ("shorter", "i", "shift", "index")))) for p in _probes(edits)])
    rows = lines.withColumn("n", F.length("line")).withColumn("p", F.explode(probes)).select(
        "ref", "line", (F.col("n") - F.col("p.shorter")).alias("whole"), F.col("p.i").alias("i"), F.col("p.shift").alias("shift"),
        F.col("p.index").alias("index"))
    base, extra = F.floor(F.col("whole") / parts).cast("int"), F.pmod(F.col("whole"), F.lit(parts))
    rows = rows.select("ref", "line", "whole", "i", "shift", "index", base.alias("base"), extra.alias("extra"))
    start = F.col("base") * F.col("i") + F.greatest(F.lit(0), F.col("extra") - parts + F.col("i")) + F.col("shift")
    size = F.col("base") + F.when(F.col("extra") >= parts - F.col("i"), 1).otherwise(0)
    return rows.select("ref", "line", "whole", "i", "index", start.alias("start"), size.alias("size")).where("start >= 0").select(
        F.xxhash64("whole", "i", F.col("line").substr(F.col("start") + 1, F.col("size"))).alias("key"), "index", "ref")


def _letters(line: Column) -> Column:
    """Counts of sixteen letters, a byte each."""
    def packed(letters: str) -> Column:
        out = F.lit(0).cast("long")
        for k, letter in enumerate(letters):
            count = F.length(line) - F.length(F.replace(line, F.lit(letter), F.lit("")))
            out = out.bitwiseOR(F.shiftleft(F.pmod(count, F.lit(128)).cast("long"), 8 * k))
        return out

    return F.array(*map(packed, LETTERS))


def _letters_differ(a: Column, b: Column) -> Column:
    """Least sum of differences of the counts."""
    def at(x: Column, word: int, k: int) -> Column:
        return F.shiftright(x[word], 8 * k).bitwiseAND(127)

    total = F.lit(0)
    for word, letters in enumerate(LETTERS):
        for k in range(len(letters)):
            gap = F.abs(at(a, word, k) - at(b, word, k))
            total = total + F.least(gap, 128 - gap)
    return total


def _near(pairs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """The pairs within the edit distance: a banded computation that gives up beyond it."""
    def side(name: str) -> DataFrame:
        return lines.select(F.col("hash").alias(name), F.col("line").alias(f"line_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(F.levenshtein("line_a", "line_b", edits) >= 0).select("a", "b")


def near_lines(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """``(hash, root)`` of the lines linked with a different line, by the smallest hash of their component.

    ``lines`` has ``hash`` (128 bits) and ``line``, repeats allowed. Each key's
    lines are first compared with one of them, then those that are still in
    different components with each other, so groups of alike lines cost a star
    and not all pairs.
    """
    # A reference only has to tell the lines of one key apart; the lowest bit marks index keys.
    ref = F.shiftleft(F.xxhash64("line"), 1)
    keys = _keyed(lines.select(ref.alias("ref"), "line"), edits).select(
        "key", F.when(F.col("index"), F.col("ref").bitwiseOR(1)).otherwise(F.col("ref")).alias("ref"))
    by_key = W.partitionBy("key")
    plain = F.shiftright("ref", 1)
    shared = saved(
        keys.repartition("key").withColumn("low", F.min(plain).over(by_key)).withColumn("high", F.max(plain).over(by_key))
        .withColumn("any", F.max(F.col("ref").bitwiseAND(1)).over(by_key))
        .where("low != high and any = 1").select("key", plain.alias("ref"), (F.col("ref").bitwiseAND(1) == 1).alias("index"))
        .distinct(), "lines-keys")
    wanted = shared.select("ref").distinct()
    found = saved(
        lines.withColumn("ref", F.shiftright(ref, 1)).join(measured(wanted), "ref", "left_semi")
        .dropDuplicates(["hash"]).withColumn("letters", _letters(F.col("line"))), "lines-texts")
    rows = saved(shared.join(found.select("ref", "hash", "letters", F.length("line").alias("n")), "ref").drop("ref"), "lines-rows")

    alike = (F.abs(F.col("na") - F.col("nb")) <= edits) & (
        _letters_differ(F.col("letters_a"), F.col("letters_b")) <= 2 * edits)

    # Each key's smallest index line against all lines of the key.
    hub = F.min(F.when(F.col("index"), F.struct("hash", "letters", "n"))).over(by_key)
    stars = rows.withColumn("hub", hub).where("hash != hub.hash").select(
        F.least("hash", "hub.hash").alias("a"), F.greatest("hash", "hub.hash").alias("b"),
        F.col("letters").alias("letters_a"), F.col("hub.letters").alias("letters_b"),
        F.col("n").alias("na"), F.col("hub.n").alias("nb"),
    ).where(alike).select("a", "b").distinct()
    stars = saved(stars, "lines-stars")
    links = saved(_near(stars, found, edits), "lines-links")
    roots = saved(components(links), "lines-roots")

    # What is left: index and probe lines of a key in different components.
    placed = rows.join(roots.withColumnRenamed("node", "hash"), "hash", "left").withColumn("root", F.coalesce("root", "hash"))
    parted = saved(
        placed.withColumn("low", F.min("root").over(by_key)).withColumn("high", F.max("root").over(by_key))
        .where("low != high").select("key", "hash", "letters", "n", "root", "index"), "lines-parted")

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("key", F.col("hash").alias(name), F.col("letters").alias(f"letters_{name}"),
                         F.col("n").alias(f"n{name}"), F.col("root").alias(f"root_{name}"))

    rest = side(parted.where("index"), "a").join(
        side(parted, "b"), "key"
    ).where((F.col("root_a") != F.col("root_b")) & alike).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(stars, ["a", "b"], "left_anti")
    more = _near(rest, found, edits)
    return components(saved(links.unionByName(more), "lines-all-links")).withColumnRenamed("node", "hash")


def line_classes(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, line_no, class_doc, class_line, kept)`` of each line of ``min_chars`` characters or more, and of shorter repeats.

    Lines within ``edits`` edits link; a class is a component of links, named
    after its first line by ``doc_id``, then number, which alone is kept. Equal
    lines are one line with several places. Lines under ``min_chars`` link only
    with equal ones: those that others equal have a row, the first one too;
    single and blank ones have none.

    A null text is empty. A null ``doc_id`` stands last. Rows that repeat an id
    are one document: its lines of equal number and class are kept together.
    Tables without such lines give no rows.
    """
    long = F.length("line") >= min_chars
    every = lines_of(docs).where(long | F.col("line").rlike(r"\S")).withColumn("hash", F.unhex(F.md5("line")))
    near = saved(near_lines(every.where(long).select("hash", "line"), edits), "lines-near")
    place = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.col("line_no").alias("line"))
    firsts = every.groupBy("hash").agg(F.min(place).alias("first"), F.count("*").alias("places"), F.max(long).alias("long"))
    firsts = saved(firsts.where("long or places > 1").select("hash", "first"), "lines-firsts")
    linked = firsts.join(near, "hash")
    first_of = linked.groupBy("root").agg(F.min("first").alias("first"))
    apart = firsts.join(near, "hash", "left_anti")
    classes = saved(linked.drop("first").join(first_of, "root").select("hash", "first").unionByName(apart), "lines-classes")
    return every.select("doc_id", "line_no", "hash").join(classes, "hash").select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"),
        F.nullif(F.col("first.doc"), F.lit(LAST)).alias("class_doc"), F.col("first.line").cast("long").alias("class_line"),
        (place == F.col("first")).alias("kept"),
    )


def drop_repeated_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents, all columns, without the lines that are not kept.

    Documents of which no line is left go; empty and null texts stay as they are.
    Rows with a null or repeated id are documents of their own, after all others. Extra columns, whatever
    their names, come out as they are.
    """
    rows = numbered(docs)
    gone = saved(
        line_classes(rows.select(F.col("number").alias("doc_id"), "row.text"), edits, min_chars).where("not kept").groupBy(
            F.col("doc_id").alias("gone_id")).agg(F.collect_set(F.col("line_no").cast("int")).alias("gone_lines")), "lines-gone")
    lines = F.split("row.text", "\n", -1)
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone_lines")
    left = F.array_join(F.transform(keep, lambda k: lines[k]), "\n")
    joined = rows.join(gone, F.col("number") == F.col("gone_id"), "left")
    return joined.where("gone_lines is null or size(split(row.text, '\n', -1)) > size(gone_lines)").select(*[
        F.when(F.col("gone_lines").isNull(), F.col("row")[c]).otherwise(left).alias(c, metadata=docs.schema[c].metadata)
        if c == "text" else F.col("row")[c].alias(c, metadata=docs.schema[c].metadata) for c in docs.columns
    ])
