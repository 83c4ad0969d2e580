"""Cards, exports, suggestions, audits without all pairs, the index, large documents and the stateful stream."""

import hashlib
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from lamina import cli
from lamina.functions import similarity as S
from lamina.functions import textnorm as X
from lamina.operators import audit, catalogue, export, lexicon, resolve, strata, textindex, worklist
from lamina.plans import jobs
from lamina.sources import documents as D
from lamina.sources import parts
from lamina.streaming import ingest

ROWS = "id string, title string, title_translit string, author string, author_cluster_id string, catalog_note string, discrepancy_note string"
CLUSTERS = "cluster_id string, canonical_ar string, canonical_translit string, category string, variants array<string>"


def corpus(spark):
    rows = [
        ("r1", "كتاب النور", "kitāb al-nūr", "احمد السالمي", "c1", "", ""), ("r2", "كتاب العين", "kitāb al-ʿayn", "احمد السالمي", "c1", "", ""),
        ("r3", "باب العين", "bāb al-ʿīn", "", "", "", ""), ("r4", "كتاب العين", "", "احمد السالمي", "c1", "", ""),
        ("r5", "شرح النور لابن سالم", "šarḥ al-nūr li-bn sālim", "", "", "", ""), ("r6", "المدرس", "al-mudarris", "", "", "", ""),
    ]
    return spark.createDataFrame(rows, ROWS), spark.createDataFrame([("c1", "احمد السالمي", "Aḥmad al-Sālimī", None, ["احمد السالمي"])], CLUSTERS)


def made(spark, **given):
    rows, clusters = corpus(spark)
    none = spark.createDataFrame([], "id string"), spark.createDataFrame([], "key string, reading string, varies boolean")
    return jobs.cards(rows, clusters, *none, **given)


def test_cards_of_four_strata(spark):
    hand = spark.createDataFrame([("o1", "النور", "النّور", "al-nūr", "because", None), ("o2", "كتاب", None, None, "here alone", ["r1"])], "id string, word string, proposed string, translit string, reason string, only_rows array<string>")
    witnesses = spark.createDataFrame([("r3", None, "العين", "al-ʿīn", "al-ʿayn"), ("w2", "r1", "النور", "gone", "x")], "id string, row string, word string, current string, proposed string")
    marks = spark.createDataFrame([("r5", "لإبن", "tail", "why"), ("r1", "لابن", "gone", "")], "row string, marker string, verdict string, note string")
    cards = made(spark, hand=hand, witnesses=witnesses, marks=marks)
    ortho = {r["id"]: r for r in cards["ortho"].collect()}
    assert ortho["o1"]["hand"] and ortho["o1"]["n_titles"] == 2 and not ortho["o1"]["row_scoped"] and ortho["o1"]["translit_was"] == "al-nūr"
    assert ortho["o2"]["n_titles"] == 1 and ortho["o2"]["row_scoped"] and ortho["o2"]["proposed"] is None
    assert "s-النور" not in ortho and ortho["s-المدرس"]["proposed"] == "المدرّس" and ortho["h-احمد"]["n_authors"] == 3
    assert [r["id"] for r in cards["witness"].collect()] == ["r3"] and cards["witness"].first()["unblocks"] == 1
    homograph = cards["homograph"].collect()
    assert [(r["id"], r["title"], int(r["n_compositions"])) for r in homograph] == [("r4", "كتاب العين", 2)]
    assert homograph[0]["compositions"] == {"al-ʿayn": "kitāb al-ʿayn", "al-ʿīn": "kitāb al-ʿīn"}
    tail = cards["attribution"].first()
    assert (tail["id"], tail["proposed_title"], tail["proposed_translit"], tail["note"]) == ("r5-attr", "شرح النور", "šarḥ al-nūr", "why")
    scope = {(r["card"], r["surface"], r["id"]): r["after"] for r in cards["scope"].collect()}
    assert scope["o1", "title", "r5"] == "شرح النّور لابن سالم" and ("o2", "title", "r1") in scope and ("o2", "title", "r2") not in scope
    assert scope["h-احمد", "cluster", "c1"] is None
    # a fingerprint is twelve digits of the hash of a JSON array
    want = json.dumps(["witness", "r3", "العين", "al-ʿīn", "al-ʿayn"], ensure_ascii=False)
    assert cards["witness"].first()["fp"] == hashlib.sha256(want.encode()).hexdigest()[:12]
    want = json.dumps(["ortho", "النور", "النّور", "al-nūr", [], None, False, False, True, False, False], ensure_ascii=False)
    assert ortho["o1"]["fp"] == hashlib.sha256(want.encode()).hexdigest()[:12]
    want = json.dumps(["homograph", "كتاب العين", [["العين", ["al-ʿayn", "al-ʿīn"]]]], ensure_ascii=False)
    assert homograph[0]["fp"] == hashlib.sha256(want.encode()).hexdigest()[:12]
    view = strata.view({k: v for k, v in cards.items() if k != "scope"})
    assert {r["stratum"] for r in view.collect()} == {"ortho", "homograph", "witness", "attribution"}


def test_prose_keeps_a_fingerprint_and_a_proposal_moves_it(spark):
    of = lambda proposed, reason: {r["id"]: r["fp"] for r in made(spark, hand=spark.createDataFrame([("o1", "النور", proposed, reason)], "id string, word string, proposed string, reason string"))["ortho"].collect()}
    one, prose, other = of("النّور", "a"), of("النّور", "b"), of("النور.", "a")
    assert one == prose and one["o1"] != other["o1"] and {k: v for k, v in one.items() if k != "o1"} == {k: v for k, v in other.items() if k != "o1"}


def test_export_and_ingest_of_what_was_answered(spark):
    hand = spark.createDataFrame([("o1", "النور", "النّور", "al-nūr")], "id string, word string, proposed string, translit string")
    cards = made(spark, hand=hand, known={"احمد": "أحمد"})
    rows, clusters = corpus(spark)
    answers = spark.createDataFrame([("o1", None, True, "accept", None), ("h-احمد", None, True, "accept", None), ("s-المدرس", "0" * 12, True, "accept", None), ("r4", None, True, None, {"العين": "al-ʿayn"}), ("gone", None, True, "accept", None)], "id string, fp string, confirmed boolean, form string, readings map<string,string>")
    out = jobs.export(cards, answers)
    got = {r["id"]: r for r in out["decisions"].collect()}
    assert got["o1"]["disposition"] == "resolved" and got["o1"]["target"] == "النّور" and got["o1"]["translit_source"] == "default"
    assert got["h-احمد"]["disposition"] == "resolved" and got["h-احمد"]["translit"] is None and got["s-المدرس"]["stale"] and got["s-المدرس"]["disposition"] == "open"
    assert got["r4"]["readings"] == {"العين": "al-ʿayn"} and "gone" not in got
    numbered = out["decisions"].withColumn("ord", F.lit(0))
    done = jobs.ingest(rows, numbered, spark.createDataFrame([], "key string, reading string, varies boolean"), clusters, out["scope"])
    fresh = {r["id"]: r for r in done["rows"].collect()}
    assert fresh["r1"]["title"] == "كتاب النّور" and fresh["r5"]["title"] == "شرح النّور لابن سالم" and fresh["r6"]["title"] == "المدرس"
    assert fresh["r1"]["author"] == "أحمد السالمي" and fresh["r4"]["title_translit"] == "kitāb al-ʿayn"
    assert done["clusters"].first()["canonical_ar"] == "أحمد السالمي" and done["ledger"].where("status = 'quarantine'").count() == 0
    assert [tuple(r) for r in done["suggestions"].collect()] == [("r4", "title_translit", "kitāb al-ʿayn")]


def test_readings_are_composed_when_asked(spark):
    options = [[(f"k{i}v{j}", (i * j) % 4) for j in range(6)] for i in range(12)]
    schema = "id string, o array<array<struct<value:string,weight:bigint>>>"
    df = spark.createDataFrame([("a", options), ("b", options[:3]), ("c", [])], schema)
    got = {r["id"]: r for r in df.select("id", lexicon.n_choices(F.col("o")).alias("n"), lexicon.best_choices(F.col("o"), 7).alias("best")).collect()}
    assert int(got["a"]["n"]) == 6**12 and int(got["b"]["n"]) == 216 and int(got["c"]["n"]) == 1
    want = sorted((-sum(w for _, w in c), [v for v, _ in c]) for c in itertools.product(*options[:3]))[:7]
    assert [(-b["weight"], b["values"]) for b in got["b"]["best"]] == want and len(got["a"]["best"]) == 7
    cards = made(spark)["homograph"]
    asked = spark.createDataFrame([("r4", ["al-ʿīn"]), ("r4", ["no such"]), ("r4", [])], "id string, values array<string>")
    assert [r["value"] for r in worklist.composed(cards, asked).orderBy("choice").collect()] == [None, "kitāb al-ʿīn", None] or {r["choice"]: r["value"] for r in worklist.composed(cards, asked).collect()} == {"al-ʿīn": "kitāb al-ʿīn", "no such": None, "": None}


def test_word_export(spark):
    words = spark.createDataFrame([(w,) for w in ("a", "b", "c", "d", "a")], "word string")
    answers = spark.createDataFrame([("a", " x ", False), ("b", "xك", True), ("c", "", True), ("z", "y", False)], "word string, translit string, varies boolean")
    got = export.word_decisions(words, answers)
    assert sorted(map(tuple, got.collect())) == [("a", "x", False, True), ("b", "", False, False), ("c", "", True, True), ("d", "", False, False)]
    assert tuple(export.counts(got).first()) == (4, 2, 1)
    assert sorted(map(tuple, export.lexicon_entries(got).collect())) == [("a", "x", False), ("c", None, True)]


def test_suggestions_accumulate(spark):
    schema = "id string, field string, proposal string"
    rows = spark.createDataFrame([("r1", "x", ""), ("r2", "y", "z")], "id string, title string, note string")
    prior = spark.createDataFrame([("r1", "title", "old"), ("r1", "note", "old"), ("r2", "note", "old"), ("gone", "title", "old"), ("r2", "other", "old")], schema)
    once = jobs.suggestions(rows, prior, spark.createDataFrame([("r1", "title", "new")], schema))
    assert sorted(map(tuple, once.collect())) == [("r1", "title", "new"), ("r2", "note", "old")]
    assert sorted(map(tuple, jobs.suggestions(rows, once, once).collect())) == sorted(map(tuple, once.collect()))
    assert {r["id"]: r["values"] for r in lexicon.suggestion_maps(once).collect()} == {"r1": {"title": "new"}, "r2": {"note": "old"}}


def test_least_similarity_equals_all_pairs(spark):
    own = random.Random(5)
    rows = [(k, "".join(own.choice("abcde") for _ in range(own.randint(0, 9)))) for k in range(6) for _ in range(25)]
    base = "".join(own.choice("abcdefghij") for _ in range(14))
    for _ in range(80):
        s = list(base)
        s[own.randrange(14)] = own.choice("xyz")
        rows.append((7, "".join(s)))
    rows.append((7, "k" * 14))  # far from the others, which needn't be compared with each other then
    rows += [(8, "one"), (8, "one"), (9, None), (9, "a"), (10, "same letters"), (10, "letters same")]
    got = {r["k"]: r for r in resolve.least_similarity(spark.createDataFrame(rows, "k int, f string"), "k", "f").collect()}
    for k in {k for k, _ in rows}:
        forms = sorted({f for key, f in rows if key == k and f is not None})
        pairs = [S._winkler(a, b) for a, b in itertools.combinations(forms, 2)]
        assert got[k]["least"] == (pytest.approx(min(pairs)) if pairs else None) and got[k]["n_compared"] <= len(pairs)
    n = got[7]["n_forms"]
    assert got[7]["n_compared"] < 2 * n < n * (n - 1) / 2


def test_over_merge_of_large_clusters(spark):
    own = random.Random(2)
    names = [f"{own.choice(['خالد', 'سعيد', 'داود'])} بن {own.choice(['سالم', 'طاهر', 'خالد', 'سعيد'])} {own.choice(['الكوفي', 'البغدادي'])} {c}" for c in "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"]
    forms = spark.createDataFrame([("c", n, names[0]) for n in set(names)], "cluster_id string, form string, canonical string")
    rare = spark.createDataFrame([], "token string, df long")
    every = {(r["form_a"], r["form_b"]): len(r["reasons"]) for r in audit.over_merge(forms, rare, pairs=1000).where("severity = 'refute'").collect()}
    some = {(r["form_a"], r["form_b"]): len(r["reasons"]) for r in audit.over_merge(forms, rare, pairs=2).where("severity = 'refute'").collect()}
    assert some and some.items() <= every.items() and len(some) < len(every) / 3
    kinds = {(r["kind"], r["n_pairs"]) for r in audit.disagreements(forms, rare).collect()}
    isms = [n.split()[0] for n in set(names)]
    assert ("ism", sum(a != b for a, b in itertools.combinations(isms, 2))) in kinds


def test_members_have_eleven_fields(spark):
    _, clusters = corpus(spark)
    rows, _ = corpus(spark)
    full = clusters.withColumns({"full_name": F.lit(None).cast("string"), "dates": F.lit(""), "count": F.lit(3), "user_confirmed": F.lit(None).cast("boolean"), "authorities": F.expr("array(named_struct('source', 's', 'title', 't', 'url', 'u'))")})
    groups = spark.createDataFrame([("g", ["c1"])], "group_id string, members array<string>")
    r = jobs.members(groups, full, rows).first()
    assert len(r) == 13 and r["sample_titles"] == ["كتاب النور", "كتاب العين", "كتاب العين"] and r["authorities"] == ["s"] and r["place"] == 1 and r["user_confirmed"] is False


def test_names_in_the_order_of_a_reader(spark):
    names = ["zebra", "Éclair", "eclair", "Echo", "", "Ärger", "arg", None, "ečo"]
    clusters = spark.createDataFrame([(str(i), "", n, None, "", None) for i, n in enumerate(names)], "cluster_id string, canonical_ar string, canonical_translit string, full_name string, dates string, category string")
    found = catalogue.author_index(clusters.select("cluster_id"), clusters, sort="name")
    assert [r["canonical_translit"] or "" for r in found.collect()] == ["arg", "Ärger", "Echo", "eclair", "Éclair", "ečo", "zebra", "", ""]


def test_the_index_finds_what_a_scan_finds(spark, tmp_path):
    own = random.Random(3)
    texts = [" ".join("".join(own.choice("abcé") for _ in range(own.randint(1, 5))) for _ in range(own.randint(0, 20))) for _ in range(300)] + [None, "", "x" * 20_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    textindex.build(rows, ["t"], f"file://{tmp_path}/index", buckets=8)
    for query in ("abc", "Ab a", "é", "", "cab b", "zzz", "xxxx", "bcab"):
        want = {r["id"] for r in catalogue.search(rows, query, ["t"]).collect()}
        assert {r["key"] for r in textindex.find(spark, f"file://{tmp_path}/index", query, 8).collect()} == want, query


@pytest.mark.parametrize("size", [200, 777, 1 << 30])
def test_large_documents_equal_small_ones(spark, tmp_path, size):
    own = random.Random(size)
    odd = ["plain", 'a "quote" and \\ {brace} [x]: "}', "}{", "\\", "عربي", "", "line\nbreak", '"']
    row = lambda i: {"id": f"r{i}", "title": own.choice(odd) * own.randint(0, 4), "tags": [own.choice(odd) for _ in range(own.randint(0, 3))], "sub": {"x": own.choice(odd)}}
    doc = {"note": {"rows": [{"id": "no"}]}, "empty": [], "rows": [row(i) for i in range(60)], "other": [{"id": "other"}], "last": "}"}
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(doc, ensure_ascii=False, indent=own.choice([None, 1])))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        schema = "id string, title string, tags array<string>, sub struct<x:string>"
        got = [r.asDict(True) for r in parts.items(spark, f"file://{path}", "rows", schema).orderBy("ord").collect()]
        assert got == [{"ord": i} | r for i, r in enumerate(doc["rows"])]
        assert [tuple(r) for r in parts.items(spark, f"file://{path}", "other", "id string").collect()] == [(0, "other")]
        assert parts.items(spark, f"file://{path}", "empty", "id string").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


DECISION = "ord int, id string, stratum string, disposition string, word string, target string, translit string, confidence string, row_scoped boolean, translit_source string, rows array<string>, scope struct<titles:array<string>,authors:array<string>,clusters:array<string>>, row string, action string, was string, tail string, tail_translit string, target_translit string, aligned boolean, readings map<string,string>, note string"


def decision(o, id, stratum, **more):
    base = dict.fromkeys([x.split()[0] for x in DECISION.split(", ")]) | {"disposition": "resolved", "row_scoped": False}
    return tuple((base | {"ord": o, "id": id, "stratum": stratum} | more).values())


def test_decisions_in_batches_give_what_one_run_gives(spark, tmp_path):
    rows, _ = corpus(spark)
    ds = [
        decision(0, "o1", "ortho", word="النور", target="النّور", translit="al-nūr2", rows=["r1", "r5", "nowhere"]), decision(1, "o2", "ortho", word="النور", target="النوّر", translit="al-nuwwar", rows=["r1"]),
        decision(2, "o3", "ortho", word="احمد", target="أحمد", scope=([], ["r1", "r2"], [])), decision(3, "w1", "witness", row="r2", was="al-ʿayn", target="al-ʿīn"),
        decision(4, "w2", "witness", row="r2", was="al-ʿīn", target="x"), decision(5, "a1", "attribution", row="r5", action="strip_tail", target="شرح النّور", tail="لابن سالم", tail_translit="li-bn sālim", target_translit="šarḥ al-nūr2", aligned=True),
        decision(6, "w3", "witness", row="r3", action="keep", target="al-ʿīn", was="al-ʿīn"), decision(7, "x", "witness", row="r3", disposition="deferred", target="y"),
    ]
    table = spark.createDataFrame(ds, DECISION)
    none = spark.createDataFrame([], "key string, reading string, varies boolean")
    want = jobs.ingest(rows, table, none)
    # the job looks once more at the end state, and finds that the second decision on one word has undone the first
    ledger_of = want["ledger"].where("status <> 'deferred' AND row IS NOT NULL AND coalesce(reason, '') <> 'a later pass has undone the edit'")
    plain = lambda df: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ingest.STATE)
    try:
        for k, order in enumerate(([[0, 1, 2, 3], [4, 5, 6, 7]], [[4, 1, 5], [3, 1, 0], [7, 6, 2, 5, 0]])):
            folder = tmp_path / f"in{k}"
            for n, batch in enumerate(order):
                spark.createDataFrame([ds[i] for i in batch], DECISION).coalesce(1).write.mode("append").json(f"file://{folder}/{n}")
            stream = spark.readStream.schema(DECISION).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(f"file://{folder}")
            out = ingest.versions(stream, rows).writeStream.outputMode("update").foreachBatch(lambda batch, i, k=k: batch.write.mode("overwrite").parquet(f"file://{tmp_path}/out{k}/{i}"))
            out.option("checkpointLocation", f"file://{tmp_path}/state{k}").trigger(availableNow=True).start().awaitTermination()
            versions = spark.read.option("recursiveFileLookup", True).schema(ingest.VERSIONS).parquet(f"file://{tmp_path}/out{k}")
            fresh, ledger = ingest.current(rows, versions)
            assert plain(fresh) == plain(want["rows"])
            assert plain(ledger) == plain(ledger_of)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_commands_for_cards_and_exports(spark, tmp_path):
    rows, clusters = corpus(spark)
    doc = {"rows": [r.asDict() for r in rows.collect()], "clusters": [r.asDict() for r in clusters.collect()], "machine_suggestions": {"r1": {"title_translit": "kitāb"}, "gone": {"title": "x"}}}
    path = tmp_path / "corpus.json"
    path.write_text(json.dumps(doc, ensure_ascii=False))
    (tmp_path / "hand.json").write_text(json.dumps({"id": "o1", "word": "النور", "proposed": "النّور", "translit": "al-nūr"}, ensure_ascii=False))
    (tmp_path / "answers.json").write_text(json.dumps({"id": "o1", "confirmed": True, "form": "accept"}))
    url = f"file://{tmp_path}"
    assert cli.main(["cards", f"{url}/corpus.json", "--hand", f"{url}/hand.json", "--write", f"{url}/cards"]) == 0
    assert cli.main(["export", f"{url}/cards", "--answers", f"{url}/answers.json", "--write", f"{url}/export"]) == 0
    got = {r["id"]: r["disposition"] for r in D.read_version(spark, f"{url}/export/decisions").collect()}
    assert got["o1"] == "resolved" and set(got.values()) == {"open", "resolved"}
    assert cli.main(["harvest", f"{url}/corpus.json", "--baseline", f"{url}/corpus.json", "--write", f"{url}/harvest"]) == 0
    assert [tuple(r) for r in D.read_version(spark, f"{url}/harvest/suggestions").collect()] == [("r1", "title_translit", "kitāb")]


def test_letters_of_the_script(spark):
    df = spark.createDataFrame([("ݐ",), ("،",), ("ب",), ("ﺏ",), ("b",)], "s string")
    s = F.col("s")
    assert [tuple(r) for r in df.select(X.has_arabic(s), X.is_arabic(s), X.typed_arabic(s), X.has_letter(s)).collect()] == [(False, True, True, False), (True, True, True, False), (True, True, True, True), (False, True, False, False), (False,) * 4]
