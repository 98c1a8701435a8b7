"""What the operators share: input columns, scratch tables, batches of texts."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.joins import measured
from tidemark.session import scratch_path

# Texts handled together inside a task, in characters: bounds the arrays of one step.
CHUNK_CHARS = 1 << 20


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the columns named; whatever else a table has stays out."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def saved(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# What marks a column, in its metadata, as one that tells the rows of a written table apart.
ROW_MARK = "tidemark.row"


def with_row_key(docs: DataFrame) -> DataFrame:
    """The rows with a number each in a column of a name that no other has, marked; to be written before it is read twice."""
    taken = {c.lower() for c in docs.columns}
    name = "row_key"
    while name in taken:
        name += "_"
    return docs.withColumn(name, F.monotonically_increasing_id().alias(name, metadata={ROW_MARK: True}))


def numbered(docs: DataFrame) -> DataFrame:
    """``(number, row)``: each row as a struct, so that no name of its columns matters, with a number that none has twice.

    The number is ``doc_id``, or a larger one where that is null or an earlier row's. Numbers derive from the marked column of a
    written table (``with_row_key``); a table without one is written first. Unmarked columns of any name are plain data.
    """
    plain = docs.columns
    marked = [f.name for f in docs.schema.fields if f.metadata.get(ROW_MARK)]
    if not marked:
        docs = saved(with_row_key(docs), "rows")
        marked = [docs.columns[-1]]
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in plain]).alias("row"), docs[f"`{marked[0]}`"].alias("key"),
        docs["doc_id"].cast("long").alias("own"))
    top, last = rows.agg(F.max("own"), F.max("key")).first()
    base = max(0, (top if top is not None else -1) + 1)
    if base + (last or 0) >= (1 << 63) - 1:
        raise ValueError(f"doc_id {top} leaves no numbers for rows without an id of their own")
    again = rows.where("own is not null").groupBy(F.col("own").alias("again")).agg(
        F.min("key").alias("first_key"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(measured(again), F.col("own") == F.col("again"), "left")
    keeps = F.col("own").isNotNull() & (F.col("first_key").isNull() | (F.col("first_key") == F.col("key")))
    return joined.select(F.when(keeps, F.col("own")).otherwise(F.lit(base) + F.col("key")).alias("number"), "row")


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``CHUNK_CHARS`` characters, one row at least."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pa.compute.binary_length(column).to_pylist()
        begin = held = 0
        for k, size in enumerate(sizes):
            held += size or 0
            if held >= CHUNK_CHARS:
                yield batch.slice(begin, k + 1 - begin)
                begin, held = k + 1, 0
        if begin < len(sizes):
            yield batch.slice(begin)


def worker_state(name: str) -> dict:
    """A dictionary that the tasks of one Python worker share, one after the other."""
    module = sys.modules.setdefault("tidemark_worker_state", types.ModuleType("tidemark_worker_state"))
    return module.__dict__.setdefault(name, {})


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type)
         for n, c in ((f.name, columns[f.name]) for f in schema)],
        schema=schema,
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value computed once: an expression inside a lambda is computed for every element."""
    return F.transform(F.array(value), body)[0]


def running_starts(lengths: Column, block: int = 256) -> Column:
    """Sum of all earlier elements for each element of an array of longs.

    Summed in blocks, so that the work grows with the length and not its square.
    """
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")

    def within(part: Column, start: Column) -> Column:
        return F.aggregate(
            part, F.struct(start.alias("at"), none.alias("out")),
            lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
            lambda s: s["out"],
        )

    def blocks(x: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.ceil(F.size(x) / block).cast("int") - 1),
            lambda b: F.slice(x, b * block + 1, F.lit(block)),
        )

    def summed(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, zero, lambda s, x: s + x))
        return F.flatten(F.zip_with(parts, within(totals, zero), within))

    return let(lengths, lambda x: F.when(F.size(x) == 0, none).when(
        F.size(x) <= block, within(x, zero)).otherwise(let(blocks(x), summed)))
