from __future__ import annotations

import random
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import merge
from tidemark.sources.master import MasterTable, load_table, write_once

MASTER = [("ID001", 10), ("ID002", 20), ("ID003", 30)]
BATCH = [("ID003", 35), ("ID004", 40), ("ID005", 50)]


def frame(spark, data, extra=""):
    return spark.createDataFrame(data, "data_id string, value bigint" + extra)


def test_keep_last_upsert(spark):
    merged = merge.upsert(frame(spark, MASTER), frame(spark, BATCH), ["data_id"], "last", ["value"])
    assert rows(merged) == [("ID001", 10), ("ID002", 20), ("ID003", 35), ("ID004", 40), ("ID005", 50)]


def test_union_needs_the_same_columns(spark):
    with pytest.raises(ValueError, match="columns differ"):
        merge.union_all(frame(spark, MASTER), frame(spark, BATCH).withColumn("more", F.lit(1)))


@pytest.mark.parametrize("keep", ["first", "last", "none"])
@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_drop_duplicates_matches_pandas(spark, keep, partitions):
    rng = random.Random(7)
    data = [(rng.choice(["a", "b", "c", None, "d", "e"]) if i % 3 else "hot", i, i) for i in range(200)]
    df = frame(spark, data, ", pos bigint").repartition(partitions)
    got = merge.drop_duplicates(df, ["data_id"], keep, [F.col("pos")])
    import pandas as pd

    pdf = pd.DataFrame(data, columns=["data_id", "value", "pos"])
    want = pdf.drop_duplicates("data_id", keep=False if keep == "none" else keep)
    assert sorted(r["pos"] for r in got.collect()) == sorted(want["pos"])
    again = merge.drop_duplicates(got, ["data_id"], keep, [F.col("pos")])
    assert rows(again) == rows(got)


def test_all_columns_as_subset(spark):
    df = frame(spark, [("a", 1), ("a", 1), ("a", None), ("a", None), ("b", 1)])
    assert rows(merge.drop_duplicates(df, None, "none", [])) == [("b", 1)]
    assert merge.drop_duplicates(df, None, "last", [F.col("value")]).count() == 3


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    master=st.sets(st.integers(0, 8)),
    batch=st.lists(st.integers(0, 8), max_size=12),
    keep=st.sampled_from(["first", "last", "none"]),
)
def test_upsert_equals_dedup_of_the_union(spark, master, batch, keep):
    m = [(str(k), 0, -1) for k in master]
    b = [(str(k), 1, i) for i, k in enumerate(batch)]
    schema = ", pos bigint"
    got = merge.upsert(frame(spark, m, schema), frame(spark, b, schema), ["data_id"], keep, ["pos"])
    union = frame(spark, m + b, schema)
    assert rows(got) == rows(merge.drop_duplicates(union, ["data_id"], keep, [F.col("pos")]))


def test_upsert_metrics(spark):
    row = merge.upsert_metrics(frame(spark, MASTER), frame(spark, BATCH), ["data_id"]).first()
    assert tuple(row) == (3, 3, 2, 5)


def test_master_versions(spark, folder):
    table = MasterTable(spark, folder, ["data_id"], "last", n_buckets=4)
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.upsert(frame(spark, MASTER + [("ID001", 11)]), "b1", ["value"])
    assert (first.version, first.rows_added, first.rows_total) == (1, 3, 3)
    second = table.upsert(frame(spark, BATCH), "b2", ["value"])
    assert (second.rows_batch, second.rows_added, second.rows_total) == (3, 2, 5)
    assert rows(table.read()) == [("ID001", 11), ("ID002", 20), ("ID003", 35), ("ID004", 40), ("ID005", 50)]
    # A retried batch changes nothing.
    assert table.upsert(frame(spark, BATCH), "b2", ["value"]).version == 2
    assert table.read().count() == 5
    # Only touched buckets moved to the new version.
    touched = {b for b, (v, _) in second.buckets.items() if v == 2}
    assert touched and {b for b, (v, _) in second.buckets.items() if v == 1}.isdisjoint(touched)


def test_master_of_many_batches_equals_one_dedup(spark, folder):
    rng = random.Random(3)
    table = MasterTable(spark, folder, ["data_id"], "last", n_buckets=3)
    everything = []
    for n in range(4):
        batch = [(f"k{rng.randrange(30)}", n * 100 + i) for i in range(40)]
        everything += batch
        table.upsert(frame(spark, batch), f"b{n}", ["value"])
    want = {k: v for k, v in everything}
    assert rows(table.read()) == sorted(want.items(), key=repr)


def test_master_keep_none_can_empty_a_bucket(spark, folder):
    table = MasterTable(spark, folder, ["data_id"], "none", n_buckets=1)
    table.upsert(frame(spark, [("a", 1)]), "b1", [])
    assert table.upsert(frame(spark, [("a", 2)]), "b2", []).rows_total == 0
    with pytest.raises(ValueError, match="empty"):
        table.read()
    assert table.upsert(frame(spark, [("a", 3)]), "b3", []).rows_total == 1


def test_write_once(spark, folder):
    path = folder + "/frozen"
    with pytest.raises(ValueError, match="empty"):
        write_once(frame(spark, []), path)
    stored, created = write_once(frame(spark, MASTER), path)
    assert created and stored.count() == 3
    stored, created = write_once(frame(spark, BATCH), path)
    assert not created and rows(stored) == rows(frame(spark, MASTER))
    with pytest.raises(FileNotFoundError):
        load_table(spark, folder + "/nothing")
    assert load_table(spark, path).count() == 3
    # A write that died half way: files, but no marker.
    half = Path(folder, "half")
    frame(spark, MASTER).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    stored, created = write_once(frame(spark, BATCH), str(half))
    assert created and rows(stored) == rows(frame(spark, BATCH))


def test_nan_keys_equal_null_keys(spark):
    nan = float("nan")
    kind = "k double, v int"
    master = spark.createDataFrame([(nan, 1), (1.0, 1)], kind)
    batch = spark.createDataFrame([(nan, 2), (None, 3), (2.0, 2)], kind)
    got = merge.upsert(master, batch, ["k"], "last", ["v"])
    assert sorted(r["v"] for r in got.collect()) == [1, 2, 3]
    assert sorted(r["v"] for r in merge.upsert(master, batch, ["k"], "none").collect()) == [1, 2]


def test_null_and_nan_keys_are_one_key_everywhere(spark, folder):
    kind = "k double, v int"
    master = spark.createDataFrame([(float("nan"), 1), (1.0, 1)], kind)
    batch = spark.createDataFrame([(None, 2), (2.0, 2)], kind)
    want = [("null", 2), (1.0, 1), (2.0, 2)]

    def content(df):
        return sorted([("null" if k is None or k != k else k, v) for k, v in df.collect()], key=repr)

    assert content(merge.upsert(master, batch, ["k"], "last", ["v"])) == sorted(want, key=repr)
    assert tuple(merge.upsert_metrics(master, batch, ["k"]).first()) == (2, 2, 1, 3)
    stored = MasterTable(spark, folder + "/master", ["k"], "last", n_buckets=32)
    stored.upsert(master, "first", ["v"])
    commit = stored.upsert(batch, "second", ["v"])
    assert content(stored.read()) == sorted(want, key=repr) and (commit.rows_added, commit.rows_total) == (1, 3)
