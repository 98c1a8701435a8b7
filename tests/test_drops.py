"""Marked drops and the ledger: every file lands once, with each time and length it has."""

import datetime as dt
import os
import time
from pathlib import Path

import pytest

from conftest import rows
from test_ingestion import CONTRACT, HEADER, put
from test_linked_and_images import tiff
from tidemark.jobs.drops import Ledger, ingest_drops, open_drops, overdue_drops
from tidemark.plans import landing
from tidemark.sources.folders import publish_parts, put_marker, ready_markers
from tidemark.sources.listing import IngestionError
from tidemark.sources.master import MasterTable
from tidemark.sources.tabular import files_with_rows, write_csv


@pytest.fixture()
def drops(spark, folder):
    class Drops:
        master = MasterTable(spark, folder + "/master", ["id"], "last", n_buckets=4)
        ledger = Ledger(spark, folder + "/ledger")
        incoming = folder + "/incoming"

        def put(self, name, text, age_days=0):
            path = put(self.incoming, name, text)
            if age_days:
                then = time.time() - age_days * 86400
                os.utime(path, (then, then))

        def close(self, drop=""):
            time.sleep(0.02)
            put_marker(spark, f"{self.incoming}/{drop}".rstrip("/"))

        def ingest(self, ledger="/ledger", **more):
            return ingest_drops(spark, self.incoming, folder + "/raw", folder + ledger, CONTRACT, self.master, **more)

        def content(self):
            return {r["id"]: r["x"] for r in self.master.read().collect()}

    Path(folder, "incoming").mkdir()
    return Drops()


def test_a_drop_waits_for_its_marker(drops):
    drops.put("one.csv", HEADER + "a,1,1.5,s1.tif\n")
    assert drops.ingest() == []
    drops.put("img/s1.tif", tiff(4, 4, 2))  # later than its table, before the marker
    drops.close()
    (first,) = drops.ingest()
    assert (first.rows_added, first.images_processed) == (1, 1)
    assert drops.ingest() == []
    # Without a new marker nothing is taken, with one only what is new.
    drops.put("two.csv", HEADER + "b,1,2.5,\n")
    assert drops.ingest() == []
    drops.close()
    (second,) = drops.ingest()
    assert (second.rows_batch, second.images_processed) == (1, 0) and drops.content() == {"a": 1.5, "b": 2.5}
    drops.close()
    assert drops.ingest() == []


def test_a_corrected_file_lands_again(spark, drops):
    drops.put("d/one.csv", HEADER + "a,1,1.5,\n")
    drops.put("d/two.csv", HEADER + "b,1,2.5,\n")
    drops.close("d")
    drops.ingest()
    drops.put("d/one.csv", HEADER + "a,1,9.5,\n")  # as long as before, only its time tells
    drops.close("d")
    (again,) = drops.ingest()
    assert again.rows_batch == 1 and drops.content() == {"a": 9.5, "b": 2.5}
    facts = drops.ledger.read().collect()
    assert sorted(Path(r["path"]).name for r in facts) == ["_READY", "_READY", "one.csv", "one.csv", "two.csv"]
    assert len({r["batch_id"] for r in facts}) == 2


def test_an_old_file_lands_once(drops):
    drops.put("one.csv", HEADER + "a,1,1.5,\n")
    drops.close()
    drops.ingest()
    drops.put("old.csv", HEADER + "b,1,2.5,\n", age_days=400)
    drops.close()
    assert [r.rows_batch for r in drops.ingest()] == [1]
    assert drops.ingest() == [] and drops.content() == {"a": 1.5, "b": 2.5}


def test_a_bad_drop_stays_open_and_holds_up_no_other(spark, drops):
    drops.put("bad/one.csv", HEADER + "a,1,1.5,s1.tif\n")
    drops.close("bad")
    drops.put("good/two.csv", HEADER + "b,1,2.5,\n")
    drops.close("good")
    with pytest.raises(IngestionError, match="bad"):
        drops.ingest()
    assert drops.content() == {"b": 2.5}
    assert [Path(m.folder).name for m in open_drops(spark, drops.incoming, drops.ledger)] == ["bad"]
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=21)
    assert [Path(m.folder).name for m in overdue_drops(spark, drops.incoming, drops.ledger, later)] == ["bad"]
    assert overdue_drops(spark, drops.incoming, drops.ledger) == []
    # The image comes late: table and image land together, once.
    drops.put("bad/s1.tif", tiff(4, 4, 2))
    drops.close("bad")
    assert [(r.rows_added, r.images_processed) for r in drops.ingest()] == [(1, 1)]
    assert drops.ingest() == []


def test_a_lost_ledger_commit_changes_nothing(drops):
    drops.put("one.csv", HEADER + "a,1,1.5,\n")
    drops.close()
    drops.ingest()
    version = drops.master.head().version
    # As after a crash between the master's commit and the ledger's.
    drops.ingest(ledger="/other")
    assert drops.master.head().version == version and drops.ingest(ledger="/other") == []


def test_rejects_and_unknown_files(spark, drops, folder):
    drops.put("one.csv", HEADER + "a,1,1.5,\nb,-2,2.5,\n")
    drops.close()
    (result,) = drops.ingest(rejects_path=folder + "/rejects")
    assert (result.rows_added, result.rows_rejected) == (1, 1)
    assert rows(spark.read.parquet(folder + "/rejects").select("id")) == [("b",)]
    drops.put("notes.txt", "x")
    drops.close()
    with pytest.raises(IngestionError, match="unknown files"):
        drops.ingest()


def test_folders_without_markers(spark, drops):
    assert ready_markers(spark, drops.incoming + "/nothing") == [] and drops.ingest() == []


def test_parts_without_rows_are_not_delivered(spark, folder, drops):
    # Spark's first task writes a header even when its rows are all filtered away.
    late = spark.range(0, 8, 1, 4).where("id >= 4").selectExpr("cast(id AS string) AS id", "1 AS n", "id + 0.5D AS x", "'' AS image")
    late = late.toDF(*HEADER.strip().split(","))
    write_csv(late, folder + "/written")
    names = files_with_rows(spark, folder + "/written")
    assert publish_parts(spark, folder + "/written", drops.incoming, ".csv") == len(names) + 1 == 3
    with pytest.raises(IngestionError, match="without rows"):
        drops.close()
        drops.ingest()

    assert publish_parts(spark, folder + "/written", f"{drops.incoming}/whole", ".csv", names) == 2
    Path(drops.incoming, "_READY").unlink()
    drops.close("whole")
    (result,) = drops.ingest(ledger="/whole-ledger")
    assert result.rows_batch == 4 and drops.content() == {str(k): k + 0.5 for k in range(4, 8)}


def test_deliveries_land_where_the_first_part_has_no_rows(spark, folder):
    Path(folder, "orders.parquet").mkdir()
    orders = spark.createDataFrame(
        [(k, "P" if k > 2 else "F", 500000.0 if k == 4 else 100.0 * k) for k in range(1, 6)], "o_orderkey long, o_orderstatus string, o_totalprice double")
    for status in "FP":  # the larger file is read by the first task
        orders.where(f"o_orderstatus = '{status}'").selectExpr("*", f"repeat(uuid(), {2000 if status == 'F' else 1}) AS wide").coalesce(
            1).write.mode("append").parquet(f"{folder}/orders.parquet")
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, 4096)
    try:
        master, rejects = landing._deliveries(spark, folder)
    finally:
        spark.conf.set(key, before)
    assert rows(master.read()) == [(1, "F", 100.0), (2, "F", 200.0), (3, "P", 300.0), (5, "P", 500.0)]
    assert rows(spark.read.parquet(rejects).groupBy("o_orderkey").count()) == [("4", 2)]
