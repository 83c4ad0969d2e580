import itertools
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from lamina.functions import names as N
from lamina.functions import similarity as S
from lamina.functions import textnorm as X
from lamina.operators import fields, graph, lexicon, resolve, worklist


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "s string").select(f(F.col("s")).alias("r")).first()["r"]


@pytest.mark.parametrize(("a", "b", "want"), [("MARTHA", "MARHTA", 0.9611111111111111), ("DIXON", "DICKSONX", 0.8133333333333332), ("", "", 1.0), ("a", "", 0.0), ("abc", "xyz", 0.0), ("محمد", "محمود", 0.9533333333333334)])
def test_jaro_winkler(spark, a, b, want):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(S.jaro_winkler(F.col("a"), F.col("b")).alias("r")).first()["r"]
    assert got == pytest.approx(want, abs=1e-12)


def test_marks_are_what_unicode_combines(spark):
    block = [chr(c) for c in range(0x600, 0x700)]
    rows = spark.createDataFrame([(c,) for c in block], "s string").select("s", X.bare(F.col("s")).alias("r")).collect()
    for r in rows:
        assert r["r"] == ("" if unicodedata.combining(r["s"]) or r["s"] == X.TATWEEL else r["s"])


def test_fold_is_idempotent_and_blind_to_marks(spark):
    random.seed(5)
    letters = "ابةىآأإٱيه محـّ َ"
    rows = [("".join(random.choice(letters) for _ in range(12)),) for _ in range(200)]
    df = spark.createDataFrame(rows, "s string").select(X.normalize_ar(F.col("s")).alias("k"), X.normalize_ar(X.bare(F.col("s"))).alias("b"))
    assert df.where("k <> b").count() == 0
    assert df.where(F.col("k") != X.normalize_ar(F.col("k"))).count() == 0


@pytest.mark.parametrize(("text", "want"), [("كتاب، الزهد", ["كتاب", "الزهد"]), ("خصلة٥٠", ["خصلة"]), ("كـتاب", ["كـتاب"]), ("", []), ("abc", [])])
def test_words(spark, text, want):
    assert one(spark, text, X.words) == want


def test_translit_tokens_keep_their_quirk(spark):
    assert one(spark, "al-Ḫarrāz ʿAbd allāh", X.translit_tokens) == ["al", "kharraz", "abd", "lah"]


@pytest.mark.parametrize(("text", "want"), [("السلمي ّ", "السلمي"), ("مّ", "مّ"), ("(ّمحقق)", "(محقق)")])
def test_orphan_marks(spark, text, want):
    assert one(spark, text, X.strip_orphan_marks) == want


def test_painted_text_is_turned(spark):
    assert one(spark, "باتك abc", X.visual_to_logical) == " كتاب" + "abc"
    assert one(spark, "", X.visual_to_logical) == ""


def test_mechanical(spark):
    assert one(spark, "ال كتاب؟", X.mechanical) == "al-ktab"


def test_death_year(spark):
    assert one(spark, "297/910", X.death_year) == 910
    assert one(spark, None, X.death_year) == 99999


def test_near(spark):
    rows = [("يزدانيار", "يازدانيار", True), ("علي", "حسن", False), ("", "", False), ("علي", "علي", True)]
    df = spark.createDataFrame(rows, "a string, b string, w boolean")
    assert df.where(S.near(F.col("a"), F.col("b")) != F.col("w")).count() == 0


def test_shuhrah_never_vetoes(spark):
    df = spark.createDataFrame([("ابن العربي", "محمد بن علي")], "a string, b string").select(N.refute(N.parse(F.col("a")), N.parse(F.col("b"))).alias("r"))
    assert df.first()["r"] == []


def test_kunya_of_a_son_is_refuted(spark):
    df = spark.createDataFrame([("ابو الحسن", "حسن بن علي")], "a string, b string").select(N.refute(N.parse(F.col("a")), N.parse(F.col("b"))).alias("r"))
    assert len(df.first()["r"]) == 1


def test_components_equal_a_search(spark):
    random.seed(2)
    edges = [(random.randint(0, 60), random.randint(0, 60)) for _ in range(50)] + [(i, i + 1) for i in range(100, 130)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    loops = {a for a, b in edges if a == b}
    assert {x: got.get(x, x) for x in parent} == {x: root(x) for x in parent} or loops
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_kunya_guard_is_pairwise(spark):
    names = spark.createDataFrame([("ابو حفص ابن يزدانيار",), ("ابو جعفر ابن يزدانيار",), ("ابن يزدانيار",), ("س - يزدانيار",)], "name string")
    edges = {tuple(sorted(r)) for r in resolve.subset_edges(names).collect()}
    assert len(edges) == 2 and not any("حفص" in a + b and "جعفر" in a + b for a, b in edges)


def test_fill_down_resets_the_library(spark):
    rows = [(1, "Paris", "BN"), (2, "", ""), (3, "Cairo", ""), (4, "", "Dar")]
    got = fields.fill_down(spark.createDataFrame(rows, "i int, city string, library string"), "i").orderBy("i").collect()
    assert [(r["city"], r["library"]) for r in got] == [("Paris", "BN"), ("Paris", "BN"), ("Cairo", ""), ("Cairo", "Dar")]


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_fill_down_over_ranges(spark, ranges):
    own = random.Random(ranges)
    rows = [(i, own.choice(["", "", "", "A", "B", None]), own.choice(["", "", "x", "y", " "])) for i in range(300)]
    want, city, library = {}, "", ""
    for i, c, lib in rows:
        if c and c != city:
            city, library = c, ""
        library = (lib or "").strip() or library
        want[i] = city, library
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = fields.fill_down(spark.createDataFrame(rows, "i int, city string, library string"), "i")
        assert {r["i"]: (r["city"], r["library"]) for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_class_never_overrides_another_library(spark):
    raw = spark.createDataFrame([("Syriaque 3", "Rome", "BAV", "", ""), ("Arabe 5", "", "BN", "", "n/a")], "shelfmark_raw string, city string, library string, title string, author string")
    got = fields.normalize_rows(raw, {"Rome": "Roma"}, {"BAV": "Vatican"}).orderBy("shelfmark").collect()
    assert [(r["city"], r["library"], r["author"]) for r in got] == [("Paris", "Bibliothèque Nationale de France", ""), ("Roma", "Vatican", "")]


def test_combinations(spark):
    df = spark.sql("SELECT array(array('a', 'b'), array('c')) AS r").select(lexicon.combinations(F.col("r")).alias("r"))
    assert df.first()["r"] == ["a c", "b c"]


def test_fingerprints_follow_fields(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string").select(worklist.fingerprint(F.col("x"), F.col("y")).alias("f"))
    a, b, c = (r["f"] for r in df.collect())
    assert a == c != b and len(a) == 12


def test_gemination(spark):
    for text, want in (("al-nuṣṣāḥ al-awwal", ["ṣ", "w"]), ("ʿArabīyah", ["y"]), ("quwwah uww", ["w"]), ("Ḥayy", ["y"]), ("BBāb", ["b"]), ("aa ōō kitāb", [])):
        assert one(spark, text, worklist.geminated) == want, text


def test_where_a_mark_goes(spark):
    mark = "ّ"
    rows = [("علمية", "ي", "علمي" + mark + "ة"), ("ييية", "ي", "ييي" + mark + "ة"), ("الذي", "ل", "ال" + mark + "ذي"), ("اللوح", "ل", "الل" + mark + "وح"), ("الملة", "ل", "المل" + mark + "ة"), ("مدد", "د", None), ("الجبار", "ب", "الجب" + mark + "ار"), ("كتاب", "ج", None), ("البصري", "ي", "البصري" + mark)]
    df = spark.createDataFrame(rows, "w string, l string, want string")
    for r in df.select("w", "want", worklist.place_shadda(F.col("w"), F.col("l")).alias("got")).collect():
        assert r["got"] == r["want"], r


def test_carriers(spark):
    rows = [
        ("الاوراق", ["al-awrāq"], "أ"), ("اسم", ["ism"], "wasl"), ("اكرام", ["ikrām"], "إ"), ("الاجتماع", ["al-iǧtimāʿ"], "wasl"), ("الاصطدام", ["al-iṣṭidām"], "wasl"), ("اقلام", ["aqlām"], "أ"), ("اعتام", ["iʿtām"], "إ"),
        ("انهار", ["anhār"], "أ"), ("الامال", ["al-āmāl"], "آ"), ("استقبال", ["istiqbāl"], "wasl"), ("انكسار", ["inkisār"], "wasl"), ("الاذن", ["al-iḏn", "al-uḏn"], "?"), ("والاوراق", ["wa-l-awrāq"], None), ("الا", ["illā"], "إ"), ("امس", [], "?"), ("اسود", ["la-usūd"], "أ"),
    ]
    df = spark.createDataFrame(rows, "w string, t array<string>, want string")
    for r in df.select("w", "want", worklist.hamza_verdict(F.col("w"), F.col("t")).alias("got")).collect():
        assert r["got"] == r["want"], r
    df = spark.createDataFrame([("الاوراق", "الأوراق"), ("الا", "ألا"), ("اقلام", "أقلام")], "w string, want string")
    assert df.where(worklist.carry_hamza(F.col("w"), F.lit("أ")) != F.col("want")).count() == 0


def test_numbers_of_many_rows(spark):
    rows = spark.range(0, 2_000_000, 1, 16).select(F.xxhash64("id").alias("k"), "id")
    got = fields.number(rows, "n", ["k"])
    assert got.agg(F.count("*"), F.count_distinct("n"), F.min("n"), F.max("n")).first()[:] == (2_000_000, 2_000_000, 1, 2_000_000)
    from pyspark.sql import Window

    after = F.lead("n").over(Window.partitionBy(F.floor(F.col("k") / (1 << 56))).orderBy("k"))
    assert got.withColumn("after", after).where("after <> n + 1").count() == 0


def test_symmetry(spark):
    names = ["محمد", "محمود", "علي", "أبو علي", ""]
    rows = list(itertools.product(names, names))
    df = spark.createDataFrame(rows, "a string, b string").select(S.jaro_winkler(F.col("a"), F.col("b")).alias("x"), S.jaro_winkler(F.col("b"), F.col("a")).alias("y"), S.jaro(F.col("a"), F.col("b")).alias("j"))
    for r in df.collect():
        assert r["x"] == pytest.approx(r["y"]) and 0 <= r["j"] <= r["x"] <= 1
