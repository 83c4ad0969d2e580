"""What showed on odd inputs and larger tables only."""

import time

from pyspark.sql import functions as F

from lamina.operators import adjudicate, audit, lexicon, worklist
from lamina.plans import jobs, registry
from lamina.streaming import ingest


def documents(spark, path, *texts):
    """A table of documents (id from 1, text, source, lang) and the nations, as queries read them."""
    rows = [(k, text, source, "en") for k, (text, source) in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey long, n_name string").write.parquet(f"{path}/nation.parquet")
    return str(path)


def test_places_that_disagree_as_often_count_each(spark):
    names = ["خالد بن سالم بن داود", "خالد بن منصور بن طاهر"]
    forms = spark.createDataFrame([("c", n, names[0]) for n in names], "cluster_id string, form string, canonical string")
    found = audit.disagreements(forms, spark.createDataFrame([], "token string, df long")).collect()
    assert sorted((r["kind"], r["at"], r["n_pairs"]) for r in found) == [("nasab", 0, 1), ("nasab", 1, 1)]


def test_long_titles_take_linear_time(spark, tmp_path):
    sf = documents(spark, tmp_path, ("alpha beta " * 15_000, "src2"), ("gamma gamma", "src1"))
    began = time.perf_counter()
    assert sorted(map(tuple, registry.QUERIES["unconserved"](spark, sf).collect())) == [("2", "d-2")]
    assert sorted(map(tuple, registry.QUERIES["ingest_reverted"](spark, sf).collect())) == [("1", "d-1", "applied"), ("2", "d-2", "applied"), ("2", "d-2", "quarantine")]
    assert time.perf_counter() - began < 60




def test_occurrences_hold_whole_titles(spark):
    rows = [(f"r{k:02}", f"كتاب جديد{'ا' * (k % 2)}", "", "a") for k in range(12)] + [("r99", "كتاب", "kitāb", "a")]
    none = spark.createDataFrame([], "key string, reading string, varies boolean")
    got = {r["word"]: r for r in jobs.word_worklist(spark.createDataFrame(rows, "id string, title string, title_translit string, author string"), none).collect()}
    assert {w: (r["titles"], r["unlocks"], r["more"], [o["id"] for o in r["occurrences"]]) for w, r in got.items()} == {"جديد": (6, 6, 0, ["r00", "r02", "r04", "r06", "r08", "r10"]), "جديدا": (6, 6, 0, ["r01", "r03", "r05", "r07", "r09", "r11"])}
    assert {o["title"] for o in got["جديد"]["occurrences"]} == {"كتاب جديد"}


def test_titles_pass_no_shuffle_with_each_word(spark):
    """What is exploded holds a title's key alone: the plan reads no array of words above the generator."""
    rows = spark.createDataFrame([("r1", "كتاب النور"), ("r2", "")], "id string, title string")
    lex = spark.createDataFrame([("كتاب", "kitāb"), ("النور", "al-nūr")], "key string, reading string")
    none = spark.createDataFrame([], "key string")
    found = lexicon.compose(rows, F.split("title", " "), lex, none, none)
    assert {r["id"]: (r["status"], r["value"]) for r in found.collect()} == {"r1": ("composed", "kitāb al-nūr"), "r2": ("unknown", None)}
    generate = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate posexplode" in line]
    assert generate and all("__w" not in line for line in generate)


def test_components_and_fingerprints_broadcast_nothing(spark):
    """The driver would hold what is broadcast."""
    from lamina.llm import simhash_dedup

    frame = type(spark.range(1))
    seen, save = [], frame.write.fget

    def write(df):
        seen.append(df._jdf.queryExecution().sparkPlan().toString())
        return save(df)

    docs = spark.createDataFrame([(k, f"one two three four five {k % 3}") for k in range(9)], "doc_id long, text string")
    frame.write, before = property(write), frame.write
    try:
        simhash_dedup.near_duplicates(docs).write.format("noop").mode("overwrite").save()
    finally:
        frame.write = before
    assert len(seen) > 5 and not any("Broadcast" in plan for plan in seen)


def test_texts_of_their_own_dont_meet(spark):
    from lamina.operators import worklist

    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", None)], "id string, norm string")
    assert sorted(r["id"] for r in worklist.sharing(rows, "norm").collect()) == ["a", "b"]


def test_decisions_are_folded_once(spark):
    from lamina.operators import adjudicate

    rows = spark.createDataFrame([("r1", "a b"), ("r2", "c")], "id string, title_translit string")
    d = spark.createDataFrame([("d1", "r1", "a", "x"), ("d2", "r9", "a", "x")], "id string, row string, was string, target string")
    fresh, ledger = adjudicate.apply_witness(rows, d)
    assert sorted(map(tuple, fresh.collect())) == [("r1", "x b"), ("r2", "c")] and sorted((r["id"], r["status"]) for r in ledger.collect()) == [("d1", "applied"), ("d2", "quarantine")]
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (fresh, ledger)]
    assert not any("EvalPython" in plan for plan in plans)


def test_word_that_is_gone_is_in_no_title(spark, tmp_path):
    sf = documents(spark, tmp_path, ("see 3eee7", "src2"), ("eee", "src2"))
    got = {r["id"]: (r["status"], r["partial"], r["reason"]) for r in registry.QUERIES["ingest_ledger"](spark, sf).collect()}
    assert got == {"d1": ("quarantine", False, "the row no longer contains ججج"), "d2": ("quarantine", True, "title and transliteration have 1 and 2 words")}


def test_streamed_decisions_of_one_place_hold_in_any_order(spark, tmp_path):
    """Decisions are a set by row, so neither their order nor Python's state of each row matters."""
    rows = spark.createDataFrame([("r1", "كتاب", "a b")], "id string, title string, title_translit string")
    own = "row string, ord int, id string, stratum string, disposition string, action string, was string, target string"
    wide = "target_translit string, tail string, tail_translit string, aligned boolean, word string, translit string, confidence string, row_scoped boolean, translit_source string, rows array<string>, scope struct<titles:array<string>,authors:array<string>,clusters:array<string>>"
    of = lambda target: spark.createDataFrame([("r1", 0, "w", "witness", "resolved", "fix", "a", target) + (None,) * 11], f"{own}, {wide}")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ingest.STATE)
    got = []
    try:
        for k, order in enumerate((("x", "y"), ("y", "x"))):
            url = f"file://{tmp_path}/{k}"
            for n, target in enumerate(order):
                of(target).coalesce(1).write.json(f"{url}/in/{n}")
                made = ingest.versions(spark.readStream.schema(of("").schema).option("recursiveFileLookup", True).json(f"{url}/in"), rows)
                assert "TransformWithState" not in made._jdf.queryExecution().analyzed().toString()
                made.writeStream.outputMode("update").foreachBatch(lambda batch, i, url=url: batch.write.mode("overwrite").parquet(f"{url}/out/{i}")).option("checkpointLocation", f"{url}/state").trigger(availableNow=True).start().awaitTermination()
            fresh, _ = ingest.current(rows, spark.read.option("recursiveFileLookup", True).schema(ingest.VERSIONS).parquet(f"{url}/out"))
            got.append(fresh.first()["title_translit"])
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert got == ["x b", "x b"]


def test_normal_forms_are_of_distinct_words(spark, tmp_path):
    sf = documents(spark, tmp_path, ("alpha beta " * 500, "src2"), ("beta gamma " * 500, "src2"))
    found = registry.QUERIES["latin_keys"](spark, sf)
    assert sorted(r["r"] for r in found.collect()) == ["alpha", "beta", "gamma"]
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_looked_up_outside_of_spark_maps(spark, tmp_path):
    """A map of Spark is searched from its begin, so a title took time with its words times its distinct words."""
    sf = documents(spark, tmp_path, ("alpha beta gamma", "src2"), ("beta delta", "src1"))
    found = registry.QUERIES["glossed_titles"](spark, sf)
    assert "element_at" not in plan(found) and found.count() == 2
    of = adjudicate.apply_homograph
    rows = spark.createDataFrame([("1", "الف با", ""), ("2", "", ""), ("3", "الف با", "")], "id string, title string, title_translit string")
    ds = spark.createDataFrame([("a", "1", {"الف": "alif"}), ("b", "2", {}), ("c", "3", {"با": "x"}), ("d", "none", {})], "id string, row string, readings map<string,string>")
    lex = spark.createDataFrame([("با", "bā")], "key string, reading string")
    fresh, ledger = of(rows, ds, lex)
    assert "element_at" not in plan(ledger)
    assert {r["id"]: (r["status"], r["reason"]) for r in ledger.collect()} == {"a": ("applied", None), "b": ("quarantine", "a word is not settled"), "c": ("quarantine", "a word is not settled"), "d": ("quarantine", "no such row")}
    assert {r["id"]: r["title_translit"] for r in fresh.collect()} == {"1": "alif bā", "2": "", "3": ""}


def test_words_are_made_distinct_before_they_are_gathered(spark, tmp_path):
    sf = documents(spark, tmp_path, ("abba beta abba", "src2"), ("abba delta", "src1"), ("abba", "src2"))
    shadda, hamza, known = (registry.QUERIES[q](spark, sf) for q in ("shadda_items", "hamza_items", "known_sample"))
    assert "Expand" not in plan(shadda) and "posexplode" not in plan(hamza) and "posexplode" not in plan(known)
    assert [(r["translit"], r["n_rows"]) for r in shadda.collect()] == [("abba", 2)] and hamza.count() == 1 and known.count() == 2


def test_no_document_holds_all_suggestions(spark, monkeypatch):
    seen, entries = [], lexicon.suggestion_entries
    monkeypatch.setattr(lexicon, "suggestion_entries", lambda doc: seen.append(doc) or entries(doc))
    registry.QUERIES["suggestion_store"](spark, "/root/testdata/sf0.01")
    assert seen[0].agg(F.max(F.size("machine_suggestions"))).first()[0] <= 1000


def test_best_ways_need_no_sort_of_nested_arrays(spark):
    """All that comes of nulls, ties and empty lists is what sorting every way gives."""
    from itertools import product

    rows = [(1, [[("b", 2), ("a", 2), ("c", 1)], [("x", 1), ("y", 3), ("x", 1)]]), (2, [[("a", 1)], []]), (3, None), (4, []), (5, [[("a", 5)], None]), (6, [[("a", None), ("b", 1)], [(None, 1), ("c", 1)]])]
    df = spark.createDataFrame(rows, "k int, o array<array<struct<value:string,weight:bigint>>>").select("k", lexicon.best_choices(F.col("o"), 4).alias("best"))
    assert "array_sort" not in plan(df)
    got = {r["k"]: r["best"] if r["best"] is None else [(b["weight"], b["values"]) for b in r["best"]] for r in df.collect()}
    every = sorted((-sum(w for _, w in ways), [v for v, _ in ways]) for ways in product(*rows[0][1]))
    assert got == {1: [(-c, v) for c, v in every[:4]], 2: [], 3: None, 4: [(0, [])], 5: None, 6: [(None, ["a", None]), (None, ["a", "c"]), (2, ["b", None]), (2, ["b", "c"])]}


def test_a_document_may_lie_in_several_files(spark, tmp_path, monkeypatch):
    from pathlib import Path

    import pytest

    from lamina.sources import parts

    def put(name, *texts):
        (tmp_path / name).mkdir()
        for k, text in enumerate(texts):
            (tmp_path / name / f"part-{k:05}.txt").write_text(text, encoding="utf-8")
        return f"file://{tmp_path}/{name}"

    cut = put("cut", '{"rows":[{"id":"}","of":{"a":1}', ',"t":"ä{"},{"id":"2"}', '],"other":[{"id":"3"}]}\n')
    assert [tuple(r) for r in parts.items(spark, cut, "rows", "id string, t string").orderBy("ord").collect()] == [(0, "}", "ä{"), (1, "2", None)]
    assert [tuple(r) for r in parts.items(spark, cut, "other", "id string").collect()] == [(0, "3")]
    with pytest.raises(ValueError, match="closing brace"):
        parts.items(spark, put("loose", '{"rows":[{"id":"1"},', '{"id":"2"}]}'), "rows", "id string")
    seen, read = [], parts.items
    monkeypatch.setattr(parts, "items", lambda spark, path, *rest: seen.append(path) or read(spark, path, *rest))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = registry.QUERIES["json_parts"](spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NOT NULL").count()
    assert len(list(Path(seen[0].removeprefix("file://")).glob("part-*"))) > 1


def test_titles_that_collide_are_told_by_digests(spark):
    from lamina.operators import worklist

    titles = ["كتاب العلم لابن", "كتابُ العلم لابنـ", "كتاب لابنه لابن لابن", "لابن", "𝔞 آلم، لإبن x", "اؐلابن لابن", "كتاب", "كتاب العلم  لابن أحمد", None]
    rows = spark.createDataFrame([(f"r{k}", t, "a b c") for k, t in enumerate(titles)], "id string, title string, title_translit string")
    marks = spark.createDataFrame([(f"r{k}", "لأبن" if k == 4 else "لابن", "tail") for k in range(9)], "row string, marker string, verdict string")
    found = worklist.attribution_items(marks, rows, spark.createDataFrame([], "id string"))
    got = {r["row"]: (r["proposed_title"], r["tail"], r["aligned"], r["collides_with"]) for r in found.collect()}
    assert got == {
        "r0": ("كتاب العلم", "لابن", True, ["r1", "r7"]), "r1": ("كتابُ العلم", "لابنـ", True, ["r0", "r7"]), "r2": ("كتاب لابنه", "لابن لابن", False, []), "r3": ("", "لابن", False, []),
        "r4": ("𝔞 آلم،", "لإبن x", False, []), "r5": ("اؐ", "لابن لابن", True, []), "r7": ("كتاب العلم", "لابن أحمد", False, ["r0", "r1"]),
    }
    assert "norm#" in plan(found) and "normalized" not in plan(found)
    cards = worklist.collisions(rows, F.col("title"))
    assert dict(cards.select("id", "collides_with").collect()) == {"r0": ["r1"], "r1": ["r0"]}
    for df in (found, cards):
        schemas = [line for line in plan(df).splitlines() if "Relation" in line and "norm" in line]
        assert schemas and not any("title" in line for line in schemas)


def _titles(spark):
    odd = [("1", "با تا با", "ba ta bi"), ("2", "تا، ثا x جّا", "ta  sa ja"), ("20", "", ""), ("3", None, "b"), ("4", "با", None), ("5", "با", "b c"), ("10", "با\nـتا 1٢", " bo to "), ("6", "ab", "")]
    return spark.createDataFrame([*odd, *((str(k), "با تا ثا " * 50, "ba ta sa " * 50) for k in range(100, 400))], "id string, title string, title_translit string").coalesce(1)


def test_tasks_pass_on_words_not_occurrences(spark):
    rows = _titles(spark)
    want = set(map(tuple, worklist.aligned_words(rows).select("l", "r").distinct().collect()))
    got = [tuple(r) for r in worklist.word_pairs(rows).collect()]
    assert set(got) == want and len(got) < 20


def test_first_pairs_keep_each_words_first(spark):
    rows = _titles(spark)
    want = set(map(tuple, lexicon.first_reading(worklist.aligned_words(rows), ["id", "pos"]).collect()))
    passed = worklist.first_pairs(rows).cache()
    assert set(map(tuple, lexicon.first_reading(passed, ["id", "pos"]).collect())) == want and passed.count() < 20


def test_lettered_texts(spark):
    from lamina.sources.letters import ARABIC, LATIN, lettered

    texts = spark.createDataFrame([(1, "a, bc é--d "), (2, None), (3, ""), (4, "  12 "), (5, "zz"), (6, "é\nq")], "k int, text string").coalesce(1)
    got = texts.mapInArrow(lettered, "k int, words string, title string").collect()
    assert [r["words"] for r in got] == ["a bc d", None, "", "", "zz", "q"]
    assert [r["title"] for r in got] == [None if r["words"] is None else r["words"].translate(str.maketrans(LATIN, ARABIC)) for r in got]


def test_witnesses_are_counted_before_they_meet(spark):
    rows = _titles(spark).unionByName(spark.createDataFrame([("900", "با تا", ""), ("901", "ثا", "")], "id string, title string, title_translit string"))
    pairs = worklist.aligned_words(rows)
    found = lexicon.readings(pairs)
    made = lambda p: sorted(map(repr, worklist.homograph_items(rows, p, lexicon.lexicon(found), found.where("contested")).select("id", "keys", "n_compositions").collect()))
    passed = worklist.witnessed(rows).cache()
    assert made(passed) == made(pairs) and len(made(pairs)) and passed.count() < 20


def test_vocabulary_is_that_of_all_words(spark):
    rows, names = _titles(spark).withColumn("author", F.lit("جّا ab")), spark.createDataFrame([("1", "كا با")], "cluster_id string, name string")
    assert sorted(worklist.vocabulary(rows, names).collect()) == sorted(worklist.occurrences(rows, names).select("word").distinct().collect())
    assert worklist.occurrences(rows, names).where("surface = 'title'").count() == worklist.occurrences(rows, names).where("surface = 'title'").distinct().count()


def test_over_merge_broadcasts_nothing(spark):
    names = ["خالد بن سالم", "سالم بن خالد", "خالد المكي", "داود بن سالم البصري"]
    forms = spark.createDataFrame([(str(k % 2), n, names[0]) for k, n in enumerate(names * 2)], "cluster_id string, form string, canonical string")
    forms = forms.unionByName(forms.where("cluster_id = '1'").crossJoin(spark.range(60)).selectExpr("'2' AS cluster_id", "concat(form, ' ', chr(97 + id % 26), chr(97 + id / 26)) AS form", "canonical"))
    found = audit.over_merge(forms, spark.createDataFrame([("داود", 1)], "token string, df long"))
    # what is put in order is read from a file, not judged anew for the sort's sample
    plan = found._jdf.queryExecution().toString()
    assert "Broadcast" not in plan and "Join" not in plan
    assert found.count() and all(r["form_a"] != r["form_b"] for r in found.collect())


def test_runs_of_texts(spark):
    from lamina.operators import textindex

    texts = ["abcabc", "", "ab", "a\nb😀c", "abc"]
    got = spark.createDataFrame(list(enumerate(texts)), "key int, text string").coalesce(1).mapInArrow(textindex._runs, "key int, run string").collect()
    assert sorted(map(tuple, got)) == sorted({(k, t[i : i + 3]) for k, t in enumerate(texts) for i in range(len(t) - 2)})


def test_readings_are_composed_in_time_with_a_titles_words(spark):
    """A lambda that refers to an array works it out anew for each element."""
    odd = [("1", "با تا"), ("2", "با جا"), ("3", "تا الجا"), ("4", "تا دا تا"), ("5", "")]
    rows = spark.createDataFrame([*((k, t, "") for k, t in odd), ("long", "با تا " * 5_000, "")], "id string, title string, title_translit string")
    pairs = spark.createDataFrame([(l, r, 1, [k]) for l, r, k in (("تا", "tah", "7"), ("تا", "toh", "8"), ("تا", "tā", "9"))], "l string, r string, n bigint, ids array<string>")
    lex = spark.createDataFrame([("با", "bah"), ("دا", "fī"), ("الجا", "al-ǧā")], "key string, reading string")
    began = time.perf_counter()
    found = worklist.homograph_items(rows, pairs, lex, spark.createDataFrame([("تا",)], "key string"), 2)
    got = {r["id"]: (r["n_compositions"], r["compositions"]) for r in found.collect()}
    assert time.perf_counter() - began < 60
    assert got.pop("long") == (3, {"tah": " ".join(["bat tat"] * 4_999 + ["bat tah"]), "toh": " ".join(["bat toh"] * 5_000)})
    assert got == {"1": (3, {"tah": "bat tah", "toh": "bat toh"}), "3": (3, {"tah": "tat al-ǧā", "toh": "toh al-ǧā"}), "4": (3, {"tah": "tah fī tah", "toh": "toh fī toh"})}
    words, readings = ["با", "الف", "ab", None, "با", "تا"], ["aah", "ʿah", "In", "li-xah", "bah", "tah"]
    from itertools import permutations

    each = [(list(w), list(r)) for w, r in zip(permutations(words, 4), permutations(readings, 4))] + [(words[:k], list(r)) for k in (0, 1, 2) for r in permutations(readings, k)]
    want = spark.createDataFrame(each, "w array<string>, p array<string>").select(lexicon.construct(F.col("p"), F.col("w")).alias("c")).collect()
    assert [lexicon.constructed(p, w) for w, p in each] == [r["c"] for r in want]


def test_lists_of_those_that_collide_stand_beside_them_last(spark, monkeypatch):
    """A list for each member of a group grows with the square of the group, so it is made above all joins."""
    rows = spark.createDataFrame([(f"r{k}", "لابن سالم" if k < 30 else f"كتاب{'ا' * (k % 4)} لابن", "") for k in range(40)] + [("r99", None, None)], "id string, title string, title_translit string")
    marks = rows.select(F.col("id").alias("row"), F.lit("لابن").alias("marker"), F.lit("tail").alias("verdict"))
    keeps = spark.createDataFrame([("r39-attr",)], "id string")
    beside = marks.join(rows.withColumnRenamed("id", "row"), "row")
    monkeypatch.setattr(worklist, "PART", 7)
    same = lambda k: [f"r{i}" for i in (range(30) if k < 30 else range(30 + (k - 30) % 4, 39, 4)) if i != k]
    for few in (worklist.FEW, 0):
        monkeypatch.setattr(worklist, "FEW", few)
        for found in (worklist.attribution_items(marks, rows, keeps), worklist.attribution_items(beside, None, keeps)):
            assert {r["row"]: r["collides_with"] for r in found.collect()} == {f"r{k}": sorted(same(k)) for k in range(39)}
            assert plan(found).index("array_remove") < plan(found).index("Join")


def test_stripped_tails_are_shuffled_once_and_saved_once(spark, tmp_path, monkeypatch):
    """A row's ledger comes with it, what is kept carries no text, and neither titles nor decisions are saved but folded."""
    from lamina.plans import catalogue_queries

    sf = documents(spark, tmp_path, ("see the end", "src2"), ("one two three four", "src1"), ("a", "src2"))
    saves, seen = [], []
    for module in (catalogue_queries, adjudicate, worklist):
        monkeypatch.setattr(module, "saved", lambda df, save=module.saved: saves.append(df.columns) or save(df))
    fold_rows = adjudicate._fold_rows
    monkeypatch.setattr(adjudicate, "_fold_rows", lambda rows, d, *rest, **more: seen.append(d) or fold_rows(rows, d, *rest, **more))
    found = registry.QUERIES["ingest_attribution"](spark, sf)
    assert len(saves) == 2 and "Join" not in plan(found)
    assert {r["id"]: r["statuses"] for r in found.collect()} == {"1": "applied|unchanged", "2": "applied|unchanged", "3": "quarantine|unchanged"}
    assert all(r["tail"] is None and r["target"] is None for r in seen[0].where("action = 'keep'").collect()) and seen[0].where("tail IS NOT NULL").count() == 3
    rows = spark.createDataFrame([("r1", "a b", ""), ("r2", "c", "")], "id string, title string, title_translit string")
    d = spark.createDataFrame([("d", "r1", "keep"), ("e", "r1", None)], "id string, row string, action string").withColumns({c: F.lit("x") for c in ("was", "target", "target_translit", "tail", "tail_translit")})
    fresh, _ = adjudicate.apply_attribution(rows, d, "own")
    assert {r["id"]: None if r["own"] is None else sorted((x["id"], x["status"]) for x in r["own"]) for r in fresh.collect()} == {"r1": [("d", "unchanged"), ("e", "quarantine")], "r2": None}


def test_streamed_rows_and_versions_are_dealt_once(spark, tmp_path):
    """What is grouped by a key or meets by it isn't shuffled after it has been dealt by that key, and no table is left in the catalog."""
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    sf = documents(spark, tmp_path, ("one two one", "src2"), ("three four", "src1"), ("five six", "src2"), ("", "src2"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = registry.QUERIES["ingest_batches"](spark, sf)
        assert shuffles(found) == 0
        assert {r["id"]: (r["title_translit"], r["statuses"]) for r in found.collect()} == {"1": ("z two z", "applied|applied"), "2": ("", "applied"), "3": ("z six", "applied|applied")}
        rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)], "id string, k int, title string")
        rows = ingest.dealt(rows, "id", f"file://{tmp_path}/rows")
        own = ("", "", "", "")
        made = spark.createDataFrame([("a", 1, True, "old", *own, []), ("a", 2, True, "new", *own, [("d", "witness", "applied", None, False)]), ("z", 1, False, "", *own, [("e", "witness", "quarantine", "no such row", False)])], ingest.VERSIONS)
        for part in (made.where("version = 1"), made.where("version = 2")):
            versions = ingest.dealt(part, "row", f"file://{tmp_path}/made", "lamina_made")
        fresh, ledger = ingest.current(rows, versions, "own")
        assert shuffles(fresh) == shuffles(ledger) == 0
        assert sorted((r["id"], r["k"], r["title"], None if r["own"] is None else [x["id"] for x in r["own"]]) for r in fresh.collect()) == [("a", 1, "new", ["d"]), ("b", 2, "y", None), ("c", 3, None, None)]
        assert sorted((r["row"], r["id"]) for r in ledger.collect()) == [("a", "d"), ("z", "e")]
        spark.sql("DROP TABLE lamina_made")
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("lamina_")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
