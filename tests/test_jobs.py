import json

from pyspark.sql import functions as F

from lamina import cli
from lamina.functions import textnorm as X
from lamina.operators import adjudicate, lexicon, worklist
from lamina.plans import jobs
from lamina.sources import documents as D

RAW = [
    ("r0001", 1, "Caire", "BN", "Arabe 5, fol.1-3", "كتاب الزهد", "المحاسبي", "A 1"),
    ("r0002", 1, "Caire", "", "12", "رسالة", "الحارث المحاسبي", "A 1"),
    ("r0003", 2, "X", "L", "13", "الرعاية لحقوق", "ابو حفص النيسابوري", ""),
    ("r0004", 2, "X", "L", "14", "الرعاية لحقوق", "ابو علي النيسابوري", ""),
    ("r0005", 2, "X", "L", "15", "x", "NA", ""),
    ("r0006", 2, "X", "L", "16", "y", "Ritter, hellmut", ""),
]


def catalogue(spark):
    raw = spark.createDataFrame(RAW, D.RAW_ROWS)
    pins = spark.createDataFrame([("ritter", "n000")], "norm string, cluster_id string")
    pins = pins.selectExpr("'Hellmut Ritter' AS norm", "cluster_id")
    authority = spark.createDataFrame([("n000", "Hellmut Ritter", "", None, None, "modern", None, True, None)], "cluster_id string, canonical_ar string, canonical_translit string, full_name string, dates string, category string, variants array<string>, user_confirmed boolean, authorities array<struct<source:string,title:string,url:string>>")
    overrides = spark.createDataFrame([("r0003", {"catalog_note": "seen", "folios": ""})], "id string, values map<string,string>")
    curated = spark.createDataFrame([("المحاسبي", "al-Muḥāsibī")], "name string, translit string")
    return raw, jobs.build(raw, pins, authority, overrides, curated, {"Caire": "Cairo"}, {}, {"محقق": "ed."})


def test_build(spark):
    _, (rows, clusters, detached) = catalogue(spark)
    got = {r["id"]: r for r in rows.collect()}
    assert got["r0001"]["city"] == "Paris" and got["r0002"]["city"] == "Cairo" and got["r0001"]["folios"] == "fol.1-3"
    assert got["r0001"]["author_cluster_id"] == got["r0002"]["author_cluster_id"] == "n001"
    assert got["r0003"]["author_cluster_id"] != got["r0004"]["author_cluster_id"]  # different kunyas
    assert got["r0005"]["author_cluster_id"] == "" and got["r0006"]["author_cluster_id"] == "n000"
    by = {c["cluster_id"]: c for c in clusters.collect()}
    assert set(by) == {"n000", "n001", "n002", "n003"} and by["n001"]["count"] == 2
    assert by["n001"]["canonical_translit"] == "al-Muḥāsibī" and by["n001"]["confidence"] < 1 and by["n000"]["user_confirmed"]
    assert got["r0003"]["catalog_note"] == "seen" and detached.count() == 0


def test_harvest_is_idempotent(spark):
    raw, (rows, clusters, _) = catalogue(spark)
    baseline = jobs.fields.normalize_rows(raw, {"Caire": "Cairo"}, {})
    merges = spark.createDataFrame([("المحاسبي", "c9")], "variant string, cluster_id string")
    pins, authority, overrides, conflicts = jobs.harvest(rows, clusters, baseline, merges)
    assert {r["norm"]: r["cluster_id"] for r in pins.collect()}["المحاسبي"] == "c9"
    assert {r["id"]: r["values"] for r in overrides.collect()} == {"r0003": {"catalog_note": "seen"}}
    assert conflicts.count() == 0 and authority.count() == 4


def test_cli(spark, tmp_path):
    _, (rows, clusters, _) = catalogue(spark)
    doc = {"rows": [r.asDict(True) for r in rows.collect()], "clusters": [c.asDict(True) for c in clusters.collect()]}
    corpus = tmp_path / "data.json"
    corpus.write_text(json.dumps(doc, ensure_ascii=False))
    export = tmp_path / "e.json"
    decision = {"id": "d1", "stratum": "ortho", "disposition": "resolved", "word": "رسالة", "target": "رسالةٌ", "translit": "risālah", "translit_source": "typed", "rows": ["r0002", "r0099"]}
    export.write_text(json.dumps({"task": "t", "decisions": [decision, {"id": "d2", "stratum": "witness", "disposition": "deferred"}]}, ensure_ascii=False))
    assert cli.main(["audit", f"file://{corpus}", "--write", f"file://{tmp_path}/audit"]) == 0
    assert {r["norm_title"] for r in D.read_version(spark, f"file://{tmp_path}/audit/attribution").collect()} == {"الرعايه لحقوق"}
    assert cli.main(["ingest", f"file://{corpus}", "--decisions", f"file://{export}", "--task", "t", "--write", f"file://{tmp_path}/in"]) == 1
    ledger = {(r["id"], r["status"]) for r in D.read_version(spark, f"file://{tmp_path}/in/ledger").collect()}
    assert ledger == {("d1", "applied"), ("d1", "quarantine"), ("d2", "deferred")}
    assert cli.main(["words", f"file://{corpus}", "--write", f"file://{tmp_path}/w"]) == 0
    assert cli.main(["groups", f"file://{corpus}", "--write", f"file://{tmp_path}/g"]) == 0
    assert cli.main(["compose", f"file://{corpus}", "--write", f"file://{tmp_path}/c"]) == 0


def test_several_decisions_a_row(spark):
    rows = spark.createDataFrame([("r1", "w", "a b c"), ("r2", "w", "x")], "id string, title string, title_translit string")
    d = spark.createDataFrame([("1", "r1", "a", "A", None, 0), ("2", "r1", "b", "B", None, 1), ("3", "r1", "A", "Z", "keep", 2), ("4", "r2", "y", "x", None, 3), ("5", "r9", "a", "b", None, 4), ("6", "r2", None, "", None, 5)], "id string, row string, was string, target string, action string, ord int")
    fresh, ledger = adjudicate.apply_witness(rows, d)
    assert {r["id"]: r["title_translit"] for r in fresh.collect()} == {"r1": "A B c", "r2": "x"} and fresh.count() == 2
    assert {r["id"]: r["status"] for r in ledger.collect()} == {"1": "applied", "2": "applied", "3": "unchanged", "4": "unchanged", "5": "quarantine", "6": "quarantine"}
    again, ledger = adjudicate.apply_witness(fresh, d)
    assert {r["id"]: r["status"] for r in ledger.collect()} == {"1": "unchanged", "2": "unchanged", "3": "unchanged", "4": "unchanged", "5": "quarantine", "6": "quarantine"}


def test_attributions(spark):
    rows = spark.createDataFrame([("r1", "شرح القصيدة لابن زيد", "šarḥ al-qaṣīdah li-Ibn Zayd", "old", ""), ("r2", "شرح الديوان للجاحظ", "one two", "", ""), ("r3", "كتاب", "kitāb", "", ""), ("r4", "كتاب", "", "", "")], "id string, title string, title_translit string, catalog_note string, discrepancy_note string")
    cols = "id string, row string, action string, was string, target string, target_translit string, tail string, tail_translit string, aligned boolean, ord int"
    d = [
        ("a", "r1", "strip_tail", None, "شرح القصيده", "šarḥ al-qaṣīdah", "لابن زيد", "li-Ibn Zayd", True, 0), ("b", "r2", "strip_tail", None, "شرح الديوان", None, "للجاحظ", None, False, 1),
        ("c", "r3", "set_title", "كتاب", "كتاب الزهد", None, None, None, None, 2), ("d", "r4", "set_title", "كتاب", "book", None, None, None, None, 3), ("e", "r4", "set_title", "رسالة", "كتاب الزهد", None, None, None, None, 4),
        ("f", "r4", "set_title", "كتاب", "كتاب الزهد", None, None, None, None, 5), ("g", "r4", "keep", None, None, None, None, None, None, 6), ("h", "r4", "rename", None, "x", None, None, None, None, 7), ("i", "r3", "set_title", "كتاب", "", None, None, None, None, 8),
    ]
    fresh, ledger = adjudicate.apply_attribution(rows, spark.createDataFrame(d, cols))
    got = {r["id"]: r for r in fresh.collect()}
    assert (got["r1"]["title"], got["r1"]["title_translit"]) == ("شرح القصيدة", "šarḥ al-qaṣīdah") and got["r1"]["catalog_note"] == "old Title as catalogued ends «لابن زيد» (li-Ibn Zayd)."
    assert (got["r2"]["title"], got["r2"]["title_translit"]) == ("شرح الديوان", "one two") and "did not align" in got["r2"]["discrepancy_note"]
    assert got["r3"]["title"] == "كتاب" and got["r4"]["title"] == "كتاب الزهد" and len(got) == 4
    assert {r["id"]: r["status"] for r in ledger.collect()} == {"a": "applied", "b": "applied", "c": "quarantine", "d": "quarantine", "e": "quarantine", "f": "applied", "g": "unchanged", "h": "quarantine", "i": "quarantine"}


def test_homographs_are_composed_once(spark):
    rows = spark.createDataFrame([("r1", "كتاب من", ""), ("r2", "كتاب", "kitāb")], "id string, title string, title_translit string")
    d = spark.createDataFrame([("1", "r1", {"من": ""}, 0), ("2", "r1", {"من": "man"}, 1), ("3", "r1", {"من": "min"}, 2), ("4", "r2", {}, 3), ("5", "r7", {}, 4)], "id string, row string, readings map<string,string>, ord int")
    lex = spark.createDataFrame([("كتاب", "kitāb")], "key string, reading string")
    fresh, ledger = adjudicate.apply_homograph(rows, d, lex)
    assert {r["id"]: r["title_translit"] for r in fresh.collect()} == {"r1": "kitāb man", "r2": "kitāb"} and fresh.count() == 2
    assert {r["id"]: r["status"] for r in ledger.collect()} == {"1": "quarantine", "2": "applied", "3": "unchanged", "4": "unchanged", "5": "quarantine"}


def test_keeps_and_names(spark):
    d = spark.createDataFrame([("1", "ortho", "resolved", "ابو", "ابو", None, None, None, "n"), ("2", "witness", "resolved", None, "x", "keep", "y", "r1", None), ("3", "ortho", "resolved", "ابو", "أبو", None, None, None, None), ("4", "ortho", "deferred", "ا", "ا", None, None, None, None)], "id string, stratum string, disposition string, word string, target string, action string, was string, row string, note string")
    assert {(r["id"], r["word"], r["row"], r["kept"], r["note"]) for r in adjudicate.keeps(d).collect()} == {("1", "ابو", None, "ابو", "n"), ("2", None, "r1", "y", "")}
    clusters = spark.createDataFrame([("c1", "ابو علي", ["ابو علي", "أبو علي", "علي"]), ("c2", "حسن", ["حسن"])], "cluster_id string, canonical_ar string, variants array<string>")
    o = spark.createDataFrame([(0, "d", "ابو", "أبو", "", None, False, None, [], [], [], ["c1", "c2", "c9"])], adjudicate.ORTHO + ", clusters array<string>")
    fresh, ledger = adjudicate.apply_ortho_names(clusters, o)
    assert {r["cluster_id"]: (r["canonical_ar"], r["variants"]) for r in fresh.collect()} == {"c1": ("أبو علي", ["أبو علي", "علي"]), "c2": ("حسن", ["حسن"])}
    assert {(r["row"], r["status"]) for r in ledger.collect()} == {("c1", "applied"), ("c2", "unchanged"), ("c9", "quarantine")}


def test_homograph_cards(spark):
    rows = spark.createDataFrame([("r1", "من كتاب", "min kitāb"), ("r2", "من", "man"), ("r3", "كتاب من الزهد", ""), ("r4", "كتاب من", "")], "id string, title string, title_translit string")
    pairs = worklist.aligned_words(rows).withColumn("l", X.fold(F.col("l")))
    found = lexicon.readings(pairs)
    got = {r["id"]: r for r in worklist.homograph_items(rows, pairs, lexicon.lexicon(found), found.where("contested")).collect()}
    assert set(got) == {"r3", "r4"} and got["r4"]["compositions"] == {"man": "kitāb man", "min": "kitāb min"} and got["r3"]["compositions"] == {"man": None, "min": None}
    key = got["r4"]["keys"][0]
    assert (key["key"], key["raw"]) == ("من", "من") and [(o["value"], o["n_witnesses"], o["witnesses"]) for o in key["options"]] == [("man", 1, ["r2"]), ("min", 1, ["r1"])]


def test_witnesses_unblock_homographs(spark):
    rows = spark.createDataFrame([("r1", "min kitāb")], "id string, title_translit string")
    cards = spark.createDataFrame([("w1", "r1", "min", "من"), ("w2", "r1", "gone", "من")], "id string, row string, current string, word string")
    waiting = spark.createDataFrame([("r3", "من"), ("r4", "من")], "id string, key string")
    found = worklist.witness_items(cards, rows, spark.createDataFrame([], "id string"), waiting).collect()
    assert [(r["id"], r["unblocks"]) for r in found] == [("w1", 2)]


def test_commands_from_cells_to_cards(spark, tmp_path, capsys):
    cells = [(1, 0, r, 3 * c, text) for r, row in enumerate([["City", "Library", "x", "Title", "y", "z"], ["Caire", "Dar", "Laleli 3", "كتاب الاخبار", "المحاسبي", ""], ["", "", "4", "رسالة", "المحاسبي", ""]]) for c, text in enumerate(row)]
    with open(tmp_path / "cells.json", "w") as f:
        f.writelines(json.dumps(dict(zip(("page", "table", "row", "col", "text"), c)), ensure_ascii=False) + "\n" for c in cells)
    assert cli.main(["extract", f"file://{tmp_path}/cells.json", "--captions", "City|Library|Title", "--write", f"file://{tmp_path}/raw"]) == 0
    raw = D.read_version(spark, f"file://{tmp_path}/raw/rows")
    assert raw.count() == 2 and D.read_version(spark, f"file://{tmp_path}/raw/stats").first()["n_cities"] == 1
    raw.write.json(f"file://{tmp_path}/rows")
    assert cli.main(["cluster", f"file://{tmp_path}/rows", "--write", f"file://{tmp_path}/built"]) == 0
    rows, clusters = (D.read_version(spark, f"file://{tmp_path}/built/{n}") for n in ("rows", "clusters"))
    assert clusters.count() == 1 and {r["author_cluster_id"] for r in rows.collect()} == {"n000"}
    doc = {"rows": [r.asDict(True) | {"title_translit": "kitāb al-aḫbār" if r["id"] == "r0001" else ""} for r in rows.collect()], "clusters": [c.asDict(True) for c in clusters.collect()]}
    corpus = tmp_path / "data.json"
    corpus.write_text(json.dumps(doc, ensure_ascii=False))
    assert cli.main(["cards", f"file://{corpus}", "--write", f"file://{tmp_path}/cards"]) == 0
    cards = {r["id"]: r for r in D.read_version(spark, f"file://{tmp_path}/cards/ortho").collect()}
    assert cards["h-الاخبار"]["proposed"] == "الأخبار" and cards["h-الاخبار"]["n_titles"] == 1 and not cards["h-الاخبار"]["key_changes"]
    base = tmp_path / "base.json"
    base.write_text(json.dumps({"rows": [r.asDict(True) for r in rows.collect()], "clusters": []}, ensure_ascii=False))
    assert cli.main(["harvest", f"file://{corpus}", "--baseline", f"file://{base}", "--write", f"file://{tmp_path}/h"]) == 0
    assert [(r["id"], r["values"]) for r in D.read_version(spark, f"file://{tmp_path}/h/overrides").collect()] == [("r0001", {"title_translit": "kitāb al-aḫbār"})]
    (tmp_path / "p.json").write_text(json.dumps({"machine_suggestions": {"r0001": {"title_translit": "x"}}}))
    capsys.readouterr()
    assert cli.main(["provenance", f"file://{corpus}", "--proposals", f"file://{tmp_path}/p.json", "--list", "--json"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert {"table": "rows", "id": "r0001", "verdict": "overridden", "value": "kitāb al-aḫbār", "proposal": "x"} in lines and lines[0]["verdict"] == "overridden"
