import json

import pytest
from pyspark.sql import functions as F

from lamina.sources import documents as D
from lamina.plans import jobs
from lamina.streaming import decisions as stream


def test_maps_stay_maps(spark, tmp_path):
    path = tmp_path / "words.json"
    path.write_text(json.dumps({"words": {"من": {"translit": "min", "varies": True, "decided": True}, "في": {"translit": "fī", "varies": False, "decided": True}}}, ensure_ascii=False))
    rows = D.entries(D.document(spark, f"file://{path}", D.WORDS), "words", "word").orderBy("word").collect()
    assert [(r["word"], r["translit"], r["varies"]) for r in rows] == [("في", "fī", False), ("من", "min", True)]


def test_missing_documents(spark, tmp_path):
    assert D.document(spark, f"file://{tmp_path}/none.json", D.KEEPS, optional=True).count() == 0
    with pytest.raises(FileNotFoundError):
        D.document(spark, f"file://{tmp_path}/none.json", D.KEEPS)


def test_other_tasks_are_refused(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"task": "a", "decisions": [{"id": "1", "disposition": "resolved"}, {"id": "2"}]}))
    got = D.decisions(spark, f"file://{path}", "a").collect()
    assert [(r["ord"], r["id"]) for r in got] == [(0, "1"), (1, "2")]
    with pytest.raises(ValueError, match="is for a"):
        D.decisions(spark, f"file://{path}", "b")


def test_csv_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,title\n1,"x, y"\n')
    (tmp_path / "b.csv").write_text("library,id,title\nL,2,z\n")
    got = {r["id"]: (r["title"], r["library"]) for r in D.csv_worklists(spark, f"file://{tmp_path}/a.csv", f"file://{tmp_path}/b.csv").collect()}
    assert got == {"1": ("x, y", None), "2": ("z", "L")}


def test_cells_in_reading_order(spark):
    chars = [(1, 0.0, 1.0, 0.0, 1.0, "a"), (1, 2.0, 3.0, 0.2, 1.2, "b"), (1, 0.0, 1.0, 5.0, 6.0, "c"), (1, 50.0, 51.0, 0.0, 1.0, "x")]
    c = spark.createDataFrame(chars, "page int, x0 double, x1 double, top double, bottom double, c string")
    b = spark.createDataFrame([(1, "k", 0.0, 10.0, 0.0, 20.0)], "page int, cell string, x0 double, x1 double, top double, bottom double")
    assert [(r["cell"], r["text"]) for r in D.cells(c, b).collect()] == [("k", "ab c")]


def test_versions(spark, tmp_path):
    folder = f"file://{tmp_path}/store"
    first = D.write_version(spark.range(3), folder)
    D.write_version(D.read_version(spark, folder).where("id > 0"), folder)
    assert D.read_version(spark, folder).count() == 2 and D.read_version(spark, folder, first).count() == 3
    D.snapshot(spark.range(1), folder, "2024-01-01")
    D.snapshot(spark.range(5), folder, "2024-01-01")
    assert spark.read.parquet(f"{folder}/2024-01-01-pre-adjudication").count() == 1


def test_table_rows_skip_narrow_ones(spark):
    cells = [(1, 0, 0, c, f"t{c}") for c in range(16)] + [(1, 0, 1, c, "n") for c in range(5)]
    got = D.table_rows(spark.createDataFrame(cells, "page int, table int, row int, col int, text string")).collect()
    assert len(got) == 1 and got[0]["c1"] == "t3"


def test_stream_upserts_once(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([("a", "1"), ("b", "1"), ("a", "1")], "id string, note string").write.parquet(f"file://{source}")
    rows = spark.readStream.schema("id string, note string").parquet(f"file://{source}")
    store, schema = f"file://{tmp_path}/store", "id string, note string"
    stream.upsert_keeps(rows, store, f"file://{tmp_path}/check").awaitTermination(60)
    assert stream.read_keeps(spark, store, schema).count() == 2 and len(stream.versions(spark, store)) == 1
    # more rows, then a stream that starts anew: the store goes on
    spark.createDataFrame([("c", "2")], schema).write.mode("append").parquet(f"file://{source}")
    stream.upsert_keeps(rows, store, f"file://{tmp_path}/check").awaitTermination(60)
    assert {r["id"] for r in stream.read_keeps(spark, store, schema).collect()} == {"a", "b", "c"}
    other = tmp_path / "other"
    spark.createDataFrame([("a", "9"), ("d", "3")], schema).write.parquet(f"file://{other}")
    stream.upsert_keeps(spark.readStream.schema(schema).parquet(f"file://{other}"), store, f"file://{tmp_path}/check2").awaitTermination(60)
    assert {r["id"]: r["note"] for r in stream.read_keeps(spark, store, schema).collect()} == {"a": "9", "b": "1", "c": "2", "d": "3"}
    assert [v[0] for v in stream.versions(spark, store)] == [0, 1, 2]
    assert stream.read_keeps(spark, f"{store}/none", schema).count() == 0


def test_extraction_of_tables(spark):
    """Cells of ruled tables to raw rows: headers and blank rows go, places are carried down, ids are in order."""
    table = [["City", "Library", "Shelfmark", "Title", "Author", "Archive"], ["Cairo", "Dar", "1", "t1", "a1", ""], ["", "", "2", "t2", "", ""], ["", "", "", "", "", ""], ["Paris", "", "3", " t3  x", "a3", "A"]]
    cells = [(1, 0, r, 3 * c, text) for r, row in enumerate(table) for c, text in enumerate(row)]
    got = jobs.extract(spark.createDataFrame(cells, "page int, table int, row int, col int, text string"), ("City", "Library", "Title")).orderBy("id").collect()
    assert [(r["id"], r["city"], r["library"], r["shelfmark_raw"], r["title"], r["author"]) for r in got] == [("r0001", "Cairo", "Dar", "1", "t1", "a1"), ("r0002", "Cairo", "Dar", "2", "t2", ""), ("r0003", "Paris", "", "3", "t3 x", "a3")]
