from __future__ import annotations

from dataclasses import replace

import pytest

from conftest import rows
from tidemark.config import SplitSpec
from tidemark.operators import split

SPEC = SplitSpec("locality", "year", ("north", "south"), 2019, 2020, (1, 2))
DATA = [
    (1, "north", 2018), (2, "north", 2019), (3, "south", 2020), (4, "south", 2021), (5, "north", None),
    (6, "east", 2022), (7, None, 2020), (8, "east", None), (9, "north", 2022),
]


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(DATA, "id int, locality string, year int")


def ids(frame):
    return sorted(r["id"] for r in frame.collect())


@pytest.mark.parametrize("inline", [1000, 0])
def test_splits(df, monkeypatch, inline):
    monkeypatch.setattr(split, "MAX_INLINE_LOCALITIES", inline)
    assert ids(split.train_split(df, SPEC)) == [6, 7, 8]  # a null locality stays in train
    assert ids(split.reference_split(df, SPEC)) == [2, 3]
    assert ids(split.recent_split(df, SPEC, 1)) == [9]  # newest period of the whole table is 2022
    assert ids(split.recent_split(df, SPEC, 2)) == [4, 9]
    exploded = split.explode_splits(split.tag_splits(df, SPEC))
    got = {}
    for r in exploded.collect():
        got.setdefault(r["split_name"], []).append(r["id"])
    assert {k: sorted(v) for k, v in got.items()} == {
        "train": [6, 7, 8], "reference": [2, 3], "recent_1_year": [9], "recent_2_year": [4, 9],
    }
    assert rows(split.split_counts(split.tag_splits(df, SPEC))) == [
        ("master", 9), ("recent_1_year", 1), ("recent_2_year", 2), ("reference", 2), ("train", 3),
    ]


def test_train_and_tests_are_disjoint(df):
    tagged = split.tag_splits(df, SPEC).collect()
    assert all(r["splits"] == ["train"] or "train" not in r["splits"] for r in tagged)


def test_overlap_of_moved_split(df):
    frozen = split.reference_split(df, SPEC)
    moved = replace(SPEC, test_localities=("north",))
    assert ids(split.split_overlap(split.train_split(df, moved), frozen, ["id"])) == [3]


def test_bad_specs(df):
    with pytest.raises(ValueError, match="positive integer"):
        replace(SPEC, durations=(0,))
    with pytest.raises(ValueError, match="not found"):
        split.train_split(df.drop("year"), SPEC)
    with pytest.raises(ValueError, match="lacks"):
        SplitSpec.from_dict({"geographic_column": "a"})


def test_period_batches(spark, df, folder):
    named = split.period_batches(df, "year", first=2)
    assert {r["id"]: r["batch_name"] for r in named.collect()} == {
        1: "batch_2018_2019", 2: "batch_2018_2019", 3: "batch_2020", 4: "batch_2021",
        6: "batch_2022", 7: "batch_2020", 9: "batch_2022",
    }
    split.write_period_batches(named, folder + "/batches")
    back = spark.read.option("header", True).csv(folder + "/batches/batch_name=batch_2020")
    assert ids(back) == ["3", "7"]
    few = split.period_batches(df, "year", first=9)
    assert {r["batch_name"] for r in few.collect()} == {"batch_2018_2022"}
