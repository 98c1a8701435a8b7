from __future__ import annotations

import hashlib
import struct
from pathlib import Path

import pytest

from conftest import rows
from tidemark.config import ColumnRule, Contract, ExternalFile
from tidemark.operators import linked
from tidemark.sources.images import read_images

CONTRACT = Contract(
    columns={
        "id": ColumnRule("int"),
        "sat": ColumnRule("string", external_file=ExternalFile("sat", bands=12, height=8, width=8)),
        "night": ColumnRule("string", external_file=ExternalFile("night", bands=1)),
    }
)


def tiff(width, height, bands, order="<", big=False, long_values=False, gap=0):
    """Header bytes of a TIFF whose directory sits after ``gap`` filler bytes."""
    mark = b"II" if order == "<" else b"MM"
    tags = [(256, width), (257, height)] + ([(277, bands)] if bands is not None else [])
    if big:
        head = mark + struct.pack(order + "HHHQ", 43, 8, 0, 16 + gap)
        body = struct.pack(order + "Q", len(tags))
        for tag, value in tags:
            body += struct.pack(order + "HHQQ", tag, 16, 1, value)
    else:
        head = mark + struct.pack(order + "HI", 42, 8 + gap)
        body = struct.pack(order + "H", len(tags))
        for tag, value in tags:
            if long_values:
                body += struct.pack(order + "HHII", tag, 4, 1, value)
            else:
                body += struct.pack(order + "HHIHH", tag, 3, 1, value, 0)
    return head + b"\0" * gap + body + b"\0" * 8


CASES = {
    "little.tif": (tiff(8, 9, 12), (12, 9, 8)),
    "bigendian.tif": (tiff(8, 9, 1, ">"), (1, 9, 8)),
    "long.tif": (tiff(70000, 9, 3, ">", long_values=True), (3, 9, 70000)),
    "bigtiff.tif": (tiff(8, 9, 4, "<", big=True), (4, 9, 8)),
    "bigtiff_be.tif": (tiff(1 << 20, 9, 4, ">", big=True), (4, 9, 1 << 20)),
    "late.tif": (tiff(8, 9, 2, "<", gap=5000), (2, 9, 8)),
    "default_band.tif": (tiff(8, 9, None), (1, 9, 8)),
    "not_tiff.tif": (b"hello world, no image here", (None, None, None)),
}


def test_header_parser(spark, folder):
    for name, (content, _) in CASES.items():
        Path(folder, name).write_bytes(content)
    Path(folder, "empty.tif").write_bytes(b"")  # not listed: a reference to it is a missing file
    found = {r["file"]: r for r in read_images(spark, folder).collect()}
    assert {n: (r["bands"], r["height"], r["width"]) for n, r in found.items()} == {
        n: want for n, (_, want) in CASES.items()
    }
    assert found["late.tif"]["sha256"] == hashlib.sha256(CASES["late.tif"][0]).hexdigest()


def batch(spark, data):
    return spark.createDataFrame(data, "id int, sat string, night string")


def files(spark, names):
    return spark.createDataFrame([(n,) for n in names], "file string")


def test_missing_unreferenced_resolved(spark):
    df = batch(spark, [(1, "a.tif", None), (2, "b.tif", "n.tif"), (3, "b.tif", "gone.tif")])
    refs = linked.references(df, CONTRACT)
    assert rows(refs) == [("night", "gone.tif"), ("night", "n.tif"), ("sat", "a.tif"), ("sat", "b.tif")]
    there = files(spark, ["a.tif", "b.tif", "n.tif", "extra.tif"])
    assert rows(linked.missing_references(refs, there)) == [("night", "gone.tif")]
    assert rows(linked.unreferenced_files(refs, there)) == [("extra.tif",)]
    assert rows(linked.resolved_references(refs, there)) == [("a.tif",), ("b.tif",), ("n.tif",)]
    nulled = linked.null_dangling(df, there, ["sat", "night"])
    assert rows(nulled) == [(1, "a.tif", None), (2, "b.tif", "n.tif"), (3, "b.tif", None)]


def images(spark, data):
    return spark.createDataFrame(data, "file string, sha256 string, bands bigint, height bigint, width bigint")


def test_link_images(spark):
    df = batch(spark, [(1, "a.tif", "n.tif"), (2, None, "n.tif"), (3, "a.tif", None)])
    imgs = images(spark, [("a.tif", "aa", 12, 8, 8), ("n.tif", "bb", 1, 5, 5)])
    out, mapping = linked.link_images(df, imgs, CONTRACT)
    assert mapping.count() == 2
    assert rows(out.select("id", "sat_relative_path", "night_relative_path")) == [
        (1, "images/sat/aa.tif", "images/night/bb.tif"), (2, None, "images/night/bb.tif"),
        (3, "images/sat/aa.tif", None),
    ]


@pytest.mark.parametrize(
    "data, imgs, text",
    [
        ([(1, "a.tif", "x.tif")], [("a.tif", "aa", 12, 8, 8)], "not in the batch"),
        ([(1, "a.tif", None)], [("a.tif", "aa", 12, 8, 8), ("z.tif", "zz", 1, 1, 1)], "unreferenced"),
        ([(1, "a.tif", None)], [("a.tif", "aa", 11, 8, 8)], "bands"),
        ([(1, "a.tif", None)], [("a.tif", "aa", 12, 9, 8)], "height"),
        ([(1, "a.tif", None)], [("a.tif", "aa", 12, 8, None)], "width"),
    ],
)
def test_link_images_rejects(spark, data, imgs, text):
    with pytest.raises(linked.LinkedFileError, match=text):
        linked.link_images(batch(spark, data), images(spark, imgs), CONTRACT)


def test_path_columns_are_always_added(spark):
    mapping = spark.createDataFrame([], "name string, file string, relative_path string")
    out = linked.attach_canonical_paths(batch(spark, [(1, None, None)]), mapping, CONTRACT)
    assert rows(out.select("sat_relative_path", "night_relative_path")) == [(None, None)]
