"""The stages of the pipeline on a table with null and repeated ids: no row goes with another."""

import random

import corpus_pipeline as pipeline
from tidemark.llm.common import ROW_MARK, numbered, with_row_key
from tidemark.llm.jaccard import jaccard_components

SCHEMA = "doc_id long, text string, lang string"


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n))


def test_rows_of_a_null_or_repeated_id_go_alone(spark, folder):
    a, b, c, d, item, line = words(1, 60), words(2, 60), words(3, 60), words(4, 60), words(5, 40), words(6, 8)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [
        (1, a, "en"), (None, a + " more", "en"), (None, b, "en"), (2, c, "en"), (2, a + " again", "en"), (3, line + "\nfirst", "en"),
        (None, "second\n" + line, "en"), (None, "third\nfourth", "en"), (None, item, "en"), (4, d, "en"), (4, item + " end", "en"), (5, None, "en"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)

    def texts(stage):
        return sorted((r.doc_id or 0, r.text or "") for r in stage(spark, docs, folder).collect())

    every = [(r[0] or 0, r[1] or "") for r in rows]
    copies = [(0, a + " more"), (2, a + " again")]
    # The item's document and the one with a word more are near copies, the numbered one stays.
    near = set(texts(pipeline.distinct_documents))
    assert set(every) - near - {(0, item), (4, item + " end")} == set(copies) and len(near & {(0, item), (4, item + " end")}) == 1
    assert texts(pipeline.clean_documents) == sorted(set(every) - {(0, item), (4, item + " end")})
    left = texts(pipeline.new_lines)
    assert (0, "second") in left and (0, "third\nfourth") in left and (3, line + "\nfirst") in left


def test_a_bad_row_takes_no_good_one_of_its_id_along(spark, folder):
    bad, good = "bad junk %%% !!!", "good clean words here"
    rows = [(k, bad if k % 3 == 0 else good, "en") for k in range(120)]
    rows += [(None, bad, "en"), (None, good, "en"), (200, good, "en"), (200, bad, "en")]
    spark.createDataFrame([(k, int(k % 3 != 0), 0) for k in range(100)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    found = pipeline.good_documents(spark, spark.createDataFrame(rows, SCHEMA), folder).collect()
    assert len({r.row_key for r in found}) == len(found)
    assert sorted((r.doc_id or 0, r.text) for r in found) == sorted((r[0] or 0, r[1]) for r in rows if r[1] == good)


def test_columns_of_any_name_come_out_as_they_are(spark, folder):
    shared, again, item = words(1, 60), words(1, 60) + " more", words(5, 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    names = ["row_key", "row", "number", "again", "first_key", "first_row", "row_number", "gone_lines", "gone_id", "key", "own", "n"]
    rows = [(1, shared), (2, again), (None, "only here\n" + words(6, 8)), (None, words(6, 8) + "\nnor here"), (3, item), (3, words(7, 50))]
    docs = spark.createDataFrame([(*r, *[7] * len(names)) for r in rows], f"doc_id long, text string, {' int, '.join(names)} int")
    want = {
        pipeline.new_lines: {shared, again, "only here\n" + words(6, 8), "nor here", item, words(7, 50)},
        pipeline.distinct_documents: {shared} | {t for _, t in rows[2:]},
        pipeline.clean_documents: {t for _, t in rows if t != item},
    }
    # Numbers of rows whose ids are null follow no stated order: either of the two documents keeps the shared line.
    other = want[pipeline.new_lines] - {"only here\n" + words(6, 8), "nor here"} | {"only here", words(6, 8) + "\nnor here"}
    for stage, texts in want.items():
        left = stage(spark, docs.repartition(3), folder)
        assert left.columns == docs.columns
        found = left.collect()
        assert {r.text for r in found} in ((texts, other) if stage is pipeline.new_lines else (texts,))
        assert all(r[name] == 7 for r in found for name in names)


def test_a_row_key_of_an_earlier_stage_is_used_and_a_column_of_its_name_stays(spark, folder):
    docs = with_row_key(spark.createDataFrame([(1, "a", 5), (1, "b", 5), (None, "c", 5)], "doc_id long, text string, row_key int"))
    assert docs.columns == ["doc_id", "text", "row_key", "row_key_"]
    docs.write.parquet(f"{folder}/stage")
    again = spark.read.parquet(f"{folder}/stage")
    left = pipeline.new_lines(spark, again, folder)
    assert left.columns == again.columns and left.schema["row_key_"].metadata == {ROW_MARK: True}
    assert sorted((r.text, r.row_key) for r in left.collect()) == [("a", 5), ("b", 5), ("c", 5)]
    assert numbered(again).select("number").distinct().count() == 3


def test_what_a_stage_writes_last_is_a_small_plan(spark, folder):
    spark.createDataFrame([(1, words(5, 40))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.createDataFrame([(k, words(k % 40, 60) + f"\n{words(k, 6)}", "en") for k in range(60)], SCHEMA)

    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    # Few rows go: their numbers travel, no text does.
    for stage in (pipeline.distinct_documents, pipeline.clean_documents):
        assert shuffles(stage(spark, docs, folder)) == 0
    assert shuffles(pipeline.new_lines(spark, docs, folder)) <= 2
    assert shuffles(jaccard_components(docs, size=5, percent=80)) <= 2
