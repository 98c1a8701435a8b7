from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF, rows
from test_linked_and_images import tiff
from tidemark.config import ColumnRule, Contract, ExternalFile
from tidemark.jobs.ingestion import preprocess_batch
from tidemark.operators import contract as check
from tidemark.operators import monitor, scoring
from tidemark.operators.linked import LinkedFileError
from tidemark.sources.listing import IngestionError, check_listing, list_files
from tidemark.sources.master import MasterTable
from tidemark.sources.tabular import cast_to_contract, concat_batch, read_text_table, write_csv
from tidemark.streaming import events as stream
from tidemark.streaming.landing import ingest_stream

CONTRACT = Contract(
    columns={
        "id": ColumnRule("string", non_nullable=True),
        "n": ColumnRule("int", min=0),
        "x": ColumnRule("float", non_nullable=True),
        "img": ColumnRule("string", external_file=ExternalFile("sat", bands=2)),
    },
    primary_key=("id",),
    target="x",
    dedup_subset=("id",),
    dedup_keep="last",
)
HEADER = "id,n,x,img\n"


def put(folder, name, text):
    path = Path(folder, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_csv_cells(spark, folder):
    path = put(folder, "a.csv", HEADER + 'a,2.0,1e3,\nb,NA,.5,null\n"c ""q""",9007199254740993,-1,"x, y"\nn/a,,inf,""\n')
    df = read_text_table(spark, path)
    typed = cast_to_contract(df, CONTRACT).orderBy("row_in_block").select("id", "n", "x", "img").collect()
    assert [tuple(r) for r in typed] == [
        ("a", 2, 1000.0, None), ("b", None, 0.5, None), ('c "q"', 9007199254740993, -1.0, "x, y"),
        (None, None, float("inf"), None),
    ]
    assert {r["file_name"] for r in df.select("file_name").collect()} == {"a.csv"}


def test_csv_layouts(spark, folder):
    a = put(folder, "a.csv", HEADER + "a,1,1,\n")
    b = put(folder, "b.csv", "x,id,img,n\n2,b,,2\n")
    with pytest.raises(Exception, match="header"):
        read_text_table(spark, [a, b]).collect()
    both = concat_batch({"a.csv": read_text_table(spark, a), "b.csv": read_text_table(spark, b)}, CONTRACT)
    assert rows(both.select("id", "n", "x")) == [("a", "1", "1"), ("b", "2", "2")]
    with pytest.raises(ValueError, match="unsupported tabular"):
        read_text_table(spark, put(folder, "a.xlsx", "x"))
    with pytest.raises(ValueError, match="missing columns"):
        concat_batch({"a.csv": read_text_table(spark, a).drop("n")}, CONTRACT)


def test_csv_sink(spark, folder):
    write_csv(spark.createDataFrame([(1, None)], "a int, b string"), folder + "/out")
    assert rows(spark.read.option("header", True).csv(folder + "/out")) == [("1", None)]


def test_listing(spark, folder):
    root = folder + "/in"
    put(root, "sub/a.csv", HEADER)
    put(root, "i.tif", b"x")
    put(root, "Thumbs.db", b"x")
    put(root, ".hidden", b"x")
    put(root, "_READY", b"x")
    assert check_listing(list_files(spark, root, CONTRACT)) == {"tabular": 1, "image": 1, "unknown": 0}
    put(root, "b/a.csv", HEADER)
    with pytest.raises(IngestionError, match="duplicate"):
        check_listing(list_files(spark, root, CONTRACT))
    put(root, "notes.txt", b"x")
    with pytest.raises(IngestionError, match="unknown files"):
        check_listing(list_files(spark, root, CONTRACT))
    put(folder + "/only", "i.tif", b"x")
    with pytest.raises(IngestionError, match="without any tabular"):
        check_listing(list_files(spark, folder + "/only", CONTRACT))
    put(folder + "/none", "_READY", b"x")
    assert check_listing(list_files(spark, folder + "/none", CONTRACT)) is None


def ingest(spark, folder, **kwargs):
    results = []
    master = MasterTable(spark, folder + "/master", ["id"], "last", n_buckets=4)
    query = ingest_stream(spark, folder + "/incoming", folder + "/raw", folder + "/checkpoint", CONTRACT,
                          master, on_result=results.append, **kwargs)
    query.awaitTermination()
    return master, results


def test_ingest_stream(spark, folder):
    put(folder, "incoming/one.csv", HEADER + "a,1,1.5,s1.tif\nb,2,2.5,\n")
    put(folder, "incoming/two.csv", HEADER + "c,3,3.5,s1.tif\nb,2,9.5,\n")
    put(folder, "incoming/img/s1.tif", tiff(4, 4, 2))
    master, results = ingest(spark, folder)
    assert len(results) == 1
    first = results[0]
    # A key in two files of one batch: the later file wins.
    assert (first.rows_batch, first.rows_added, first.images_processed) == (4, 3, 1)
    got = {r["id"]: (r["n"], r["x"], r["sat_relative_path"]) for r in master.read().collect()}
    assert got["b"] == (2, 9.5, None) and got["a"][2].startswith("images/sat/")
    # Nothing new: nothing happens.
    assert ingest(spark, folder)[1] == []
    put(folder, "incoming/three.csv", HEADER + "a,7,7.5,\nd,4,4.5,\n")
    master, results = ingest(spark, folder)
    assert (results[0].rows_batch, results[0].rows_added) == (2, 1)
    assert {r["id"]: r["x"] for r in master.read().collect()} == {"a": 7.5, "b": 9.5, "c": 3.5, "d": 4.5}
    # A lost checkpoint replays all files as one batch; the master stays whole.
    assert master.read().count() == 4


def test_ingest_stream_stops_on_bad_rows_or_sets_them_aside(spark, folder):
    put(folder, "incoming/one.csv", HEADER + "a,1,1.5,\nb,-2,2.5,\nc,1,,\n")
    with pytest.raises(Exception, match="min"):
        ingest(spark, folder)
    master, results = ingest(spark, folder, rejects_path=folder + "/rejects")
    assert (results[0].rows_added, results[0].rows_rejected) == (1, 2)
    assert rows(spark.read.parquet(folder + "/rejects").select("id", F.concat_ws(" ", "violations"))) == [
        ("b", "min:n"), ("c", "not_null:x"),
    ]


def test_rejects_hold_repeated_keys(spark, folder):
    put(folder, "incoming/one.csv", HEADER + "a,1,1.5,\na,2,2.5,\nb,1,1,\n")
    master, results = ingest(spark, folder, rejects_path=folder + "/rejects")
    assert (results[0].rows_added, results[0].rows_rejected) == (1, 2)
    assert {tuple(r[0]) for r in spark.read.parquet(folder + "/rejects").select("violations").collect()} == {("pk_unique:id",)}


def test_landing_loses_no_cells(spark, folder):
    put(folder, "incoming/one.csv", HEADER + 'a,1,1.5,\n"b\n2",2,2.5,\nc,3,3.5\n')
    put(folder, "incoming/two.csv", "x,img,id,n\n4.5,,d,4\n")
    master, _ = ingest(spark, folder)
    assert {(r["id"], r["n"], r["x"]) for r in master.read().collect()} == {("a", 1, 1.5), ("b\n2", 2, 2.5), ("c", 3, 3.5), ("d", 4, 4.5)}


@pytest.mark.parametrize("text, error", [
    (HEADER + "a,1,1.5,,lost\n", "more cells"), (HEADER + 'a,1,1.5,"x, y",,\n', "more cells"), (HEADER, "without rows")])
def test_landing_refuses(spark, folder, text, error):
    put(folder, "incoming/one.csv", text)
    put(folder, "incoming/two.csv", HEADER + "b,1,1,\n")
    with pytest.raises(Exception, match=error):
        ingest(spark, folder)


def raw(spark, folder, name, text):
    return read_text_table(spark, put(folder, name, text))


def test_preprocess_guards(spark, folder):
    master = MasterTable(spark, folder + "/master", ["id"])
    with pytest.raises(check.ContractViolation, match="empty"):
        preprocess_batch(raw(spark, folder, "a.csv", HEADER), "b", CONTRACT, master)
    with pytest.raises(check.ContractViolation, match="missing_column"):
        preprocess_batch(raw(spark, folder, "b.csv", "id,n\na,1\n"), "b", CONTRACT, master)
    with pytest.raises(check.ContractViolation, match="duplicate primary keys"):
        preprocess_batch(raw(spark, folder, "c.csv", HEADER + "a,1,1,\na,1,2,\n"), "b", CONTRACT, master)
    with pytest.raises(TypeError, match="c2.csv"):
        preprocess_batch(raw(spark, folder, "c2.csv", HEADER + "a,1.5,1,\n"), "b", CONTRACT, master)
    with pytest.raises(LinkedFileError, match="names image files"):
        preprocess_batch(raw(spark, folder, "d.csv", HEADER + "a,1,1,s.tif\n"), "b", CONTRACT, master)
    assert not master.exists()


# --- streams equal batches ---


def event_stream(spark, folder):
    """The event table cut into time-ordered files, read one per trigger."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    for i, (a, b) in enumerate((("2024-01-01", "2024-01-12"), ("2024-01-12", "2024-01-20"), ("2024-01-20", "2024-02-01"))):
        part = events.where((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(f"{folder}/parts/{i}")
        found = next(Path(f"{folder}/parts/{i}").glob("*.parquet"))
        Path(f"{folder}/in").mkdir(exist_ok=True)
        shutil.copy(found, f"{folder}/in/{i}.parquet")
    # One row far in the future closes every window of the real data.
    closing = events.limit(1).withColumn("ts", F.lit("2024-03-01").cast("timestamp_ntz"))
    closing.coalesce(1).write.parquet(f"{folder}/parts/end")
    shutil.copy(next(Path(f"{folder}/parts/end").glob("*.parquet")), f"{folder}/in/9.parquet")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    return events, stream.with_event_time(source, "ts", "1 hour")


def drain(spark, df, folder, mode="append"):
    name = "out_" + Path(folder).name.replace("-", "_")
    query = (df.writeStream.outputMode(mode).format("memory").queryName(name)
             .option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.table(name)


def test_alert_stream_equals_batch(spark, folder):
    events, source = event_stream(spark, folder)
    hot = F.avg("value") > 20
    evaluations = stream.evaluate_windows(source, ["event_type"], "ts", "6 hours", hot)
    got = drain(spark, stream.sustained_alert_stream(evaluations, ["event_type"], 12 * 3600, 6 * 3600), folder)
    batch = stream.evaluate_windows(
        events.withColumn("ts", F.col("ts").cast("timestamp")), ["event_type"], "ts", "6 hours", hot)
    want = monitor.sustained_alerts(batch, ["event_type"], "evaluated_at", F.col("is_on"), 12 * 3600, step_seconds=6 * 3600)
    assert rows(got) == rows(want.select("event_type", "active_since", "firing_at")) and not got.isEmpty()


def test_rate_stream_equals_batch(spark, folder):
    events, source = event_stream(spark, folder)
    got = drain(spark, monitor.request_rate(source, "ts", ["event_type"], 30), folder)
    want = monitor.request_rate(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], 30)
    assert rows(got.where("window_start < '2024-02-15'")) == rows(want)


def test_category_counts_stream(spark, folder):
    events, source = event_stream(spark, folder)
    category = scoring.prediction_category(F.col("value"), thresholds=[10.0, 50.0])
    counted = scoring.predictions_by_category(source.withColumn("category", category))
    got = drain(spark, counted, folder, mode="complete")
    want = scoring.predictions_by_category(events.withColumn("category", category))
    assert sum(r["n_predictions"] for r in got.collect()) == sum(r["n_predictions"] for r in want.collect()) + 1
