"""Queries over names, shelfmarks and words that are put together from the customers' keys, so that their SQL knows the parts
without taking anything apart."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import names as N
from lamina.functions import textnorm as X
from lamina.operators import audit, fields, resolve, windows, worklist
from lamina.plans.registry import joined, query, table

ISMS = ("خالد", "سعيد", "هاشم", "داود", "حسن")
FATHERS = ("سالم", "خالد", "حسن", "حسان", "داود", "طاهر", "هاشم")
CHILDREN = ("سعيد", "طاهر", "هاشم", "منصور")
NISBAS = ("الدمشقي", "البغدادي", "الكوفي")
DIGITS, LETTERS = "0123456789", "رزوقكلمنبت"


def _pick(values, index):
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _sql(values, index):
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][({index}) + 1]"


def _names(spark, sf_dir):
    """k and name: kunya, ism, father, grandfather, nisba and a word of its own, each present or not by the key, with marks
    and tatweel that don't count."""
    k = F.col("c_custkey")
    part = lambda present, value: F.when(present, value)
    shuhrah = k % 11 == 0
    own = F.translate((F.floor(k / 3)).cast("string"), DIGITS, LETTERS)
    name = F.concat_ws(
        " ", part((k % 3 == 0) & ~shuhrah, F.concat(F.lit("أبو "), _pick(CHILDREN, k % 4))), F.when(shuhrah, F.concat(F.lit("ابن "), _pick(FATHERS, k % 7))).otherwise(_pick(ISMS, k % 5)),
        part((k % 4 != 2) & ~shuhrah, F.concat(F.lit("بن "), _pick(FATHERS, k % 7))), part((k % 4 == 0) & ~shuhrah, F.concat(F.lit("بن "), _pick(FATHERS, F.floor(k / 7) % 7))), part(k % 4 != 1, _pick(NISBAS, k % 3)),
        part(k % 6 == 0, own),
    )
    return table(spark, sf_dir, "customer").select(k.alias("k"), F.replace(F.replace(name, F.lit("س"), F.lit("سَ")), F.lit("دم"), F.lit("دـم")).alias("name"))


_NAMES_SQL = f"""nm AS (SELECT *, kunya IS NOT NULL AS has_kunya,
  list_filter([kunya, CASE WHEN shuhrah THEN 'ابن ' || father ELSE ism END, CASE WHEN NOT shuhrah AND father <> '' THEN 'بن ' || father END, CASE WHEN grand <> '' THEN 'بن ' || grand END, nisba, own], lambda x: x IS NOT NULL) AS parts,
  CASE WHEN shuhrah THEN [father] ELSE list_filter([father, grand], lambda x: x <> '') END AS chain,
  CASE WHEN shuhrah THEN 'ابن' ELSE ism END AS called
  FROM (SELECT c_custkey AS k, c_custkey % 11 = 0 AS shuhrah, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 11 <> 0 THEN {_sql(CHILDREN, 'c_custkey % 4')} END AS child, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 11 <> 0 THEN 'ابو ' || {_sql(CHILDREN, 'c_custkey % 4')} END AS kunya,
  {_sql(ISMS, 'c_custkey % 5')} AS ism, CASE WHEN c_custkey % 4 <> 2 OR c_custkey % 11 = 0 THEN {_sql(FATHERS, 'c_custkey % 7')} ELSE '' END AS father, CASE WHEN c_custkey % 4 = 0 AND c_custkey % 11 <> 0 THEN {_sql(FATHERS, '(c_custkey // 7) % 7')} ELSE '' END AS grand,
  CASE WHEN c_custkey % 4 <> 1 THEN {_sql(NISBAS, 'c_custkey % 3')} END AS nisba, CASE WHEN c_custkey % 6 = 0 THEN translate((c_custkey // 3)::VARCHAR, '{DIGITS}', '{LETTERS}') END AS own FROM customer)),
nf AS (SELECT *, array_to_string(parts, ' ') AS norm, CASE WHEN shuhrah OR len(chain) = 0 THEN NULL ELSE ism END AS parsed FROM nm)"""


@query(f"""WITH {_NAMES_SQL} SELECT k, norm, kunya, parsed AS ism, array_to_string(chain, '|') AS chain, coalesce(nisba, '') AS nisbahs, shuhrah FROM nf""")
def parsed_names(spark, sf_dir):
    parsed = _names(spark, sf_dir).select("k", N.parse(X.normalize_ar(F.col("name"))).alias("p"))
    return parsed.select("k", "p.norm", "p.kunya", "p.ism", joined("p.chain").alias("chain"), joined("p.nisbahs").alias("nisbahs"), "p.shuhrah")


#: One cluster for seven names in a row, or for a sixth of the table.
def _forms(spark, sf_dir, large):
    rows = _names(spark, sf_dir).withColumn("cluster_id", (F.col("k") % 6 if large else F.floor(F.col("k") / 7)).cast("string"))
    first = rows.groupBy("cluster_id").agg(F.min_by("name", "k").alias("canonical"))
    tokens = F.transform(X.tokens(X.normalize_ar(F.col("name"))), X.strip_article)
    rare = audit.rare(audit.token_df(rows.withColumn("id", F.col("k")), tokens))
    return rows.join(first.hint("merge"), "cluster_id").select("cluster_id", F.col("name").alias("form"), "canonical"), rare


def _one_byte(c):
    """Each letter as one byte, for DuckDB counts edits of bytes."""
    return f"translate({c}, 'خالدسعيهشموحنطر', 'abcdefghijklmno')"


def _refute_sql(a, b):
    child = lambda x, y: f"coalesce({x}.child = coalesce({y}.parsed, {y}.called), false)::INT"
    return f"""coalesce({a}.parsed <> {b}.parsed, false)::INT + {child(a, b)} + {child(b, a)} + coalesce({a}.parsed = {b}.chain[1] AND {b}.parsed = {a}.chain[1], false)::INT
      + (NOT {a}.shuhrah AND NOT {b}.shuhrah AND len(list_filter(range(1, least(len({a}.chain), len({b}.chain)) + 1), lambda i: {a}.chain[i] <> {b}.chain[i] AND levenshtein({_one_byte(f'{a}.chain[i]')}, {_one_byte(f'{b}.chain[i]')}) > 1)) > 0)::INT"""


@query(f"""WITH {_NAMES_SQL}, tk AS (SELECT *, list_distinct(list_transform(string_split(norm, ' '), lambda t: CASE WHEN left(t, 2) = 'ال' AND length(t) > 3 THEN substr(t, 3) ELSE t END)) AS ts, (k // 7)::VARCHAR AS cluster_id FROM nf),
rr AS (SELECT list(t) AS rs FROM (SELECT t FROM (SELECT k, unnest(ts) AS t FROM tk) GROUP BY 1 HAVING count(*) <= 3)), f AS (SELECT cluster_id, norm, any_value(parsed) AS parsed, any_value(called) AS called, any_value(child) AS child, any_value(chain) AS chain, any_value(shuhrah) AS shuhrah, any_value(ts) AS ts FROM tk GROUP BY 1, 2),
c AS (SELECT cluster_id, arg_min(norm, k) AS canonical, arg_min(ts, k) AS cts FROM tk GROUP BY 1),
p AS (SELECT a.cluster_id, least(a.norm, b.norm) AS form_a, greatest(a.norm, b.norm) AS form_b, {_refute_sql('a', 'b')} AS n, NOT (list_has_all(a.ts, b.ts) OR list_has_all(b.ts, a.ts)) AND NOT list_has_any(list_intersect(a.ts, b.ts), coalesce(rs, [])) AS weak
  FROM f a JOIN f b ON a.cluster_id = b.cluster_id AND a.norm < b.norm CROSS JOIN rr)
SELECT cluster_id, form_a, form_b, CASE WHEN n > 0 THEN 'refute' ELSE 'weak' END AS severity, CASE WHEN n > 0 THEN n ELSE 1 END AS n_reasons FROM p WHERE n > 0 OR weak
UNION ALL SELECT f.cluster_id, canonical, norm, 'refute', 1 FROM f JOIN c USING (cluster_id) WHERE norm <> canonical AND (parsed IS NOT NULL OR len(chain) > 0) AND len(list_filter(list_intersect(ts, cts), lambda t: NOT suffix(t, 'ي'))) = 0""")
def over_merge(spark, sf_dir):
    forms, rare = _forms(spark, sf_dir, False)
    plain = lambda c: X.normalize_ar(F.col(c)).alias(c)
    found = audit.over_merge(forms.select("cluster_id", plain("form"), plain("canonical")), rare)
    return found.select("cluster_id", "form_a", "form_b", "severity", F.size("reasons").alias("n_reasons"))


@query(f"""WITH {_NAMES_SQL}, f AS (SELECT DISTINCT (k % 6)::VARCHAR AS cluster_id, norm, parsed, called, child, chain, shuhrah FROM nf), p AS (SELECT a.cluster_id, a.parsed AS ai, b.parsed AS bi, a.child AS ac, b.child AS bc, a.called AS an, b.called AS bn, a.chain AS ah, b.chain AS bh, NOT a.shuhrah AND NOT b.shuhrah AS plain FROM f a JOIN f b ON a.cluster_id = b.cluster_id AND a.norm < b.norm)
SELECT cluster_id, 'ism' AS kind, count(*) AS n_pairs FROM p WHERE ai <> bi GROUP BY 1 UNION ALL SELECT cluster_id, 'kunya', sum((ac = coalesce(bi, bn))::INT + (bc = coalesce(ai, an))::INT)::BIGINT FROM (SELECT cluster_id, coalesce(ac, '') AS ac, coalesce(bc, '') AS bc, ai, bi, an, bn FROM p) WHERE ac = coalesce(bi, bn) OR bc = coalesce(ai, an) GROUP BY 1
UNION ALL SELECT cluster_id, 'inverted', count(*) FROM p WHERE ai = bh[1] AND bi = ah[1] AND ai <> bi GROUP BY 1
UNION ALL SELECT cluster_id, 'nasab', sum((ah[1] <> bh[1])::INT + coalesce(ah[2] <> bh[2], false)::INT)::BIGINT FROM p WHERE plain AND len(ah) > 0 AND len(bh) > 0 GROUP BY 1 HAVING sum((ah[1] <> bh[1])::INT + coalesce(ah[2] <> bh[2], false)::INT) > 0""")
def disagreements(spark, sf_dir):
    """How many pairs of forms disagree in each way in six large clusters, from groups of forms alone."""
    forms, rare = _forms(spark, sf_dir, True)
    plain = lambda c: X.normalize_ar(F.col(c)).alias(c)
    parsed = audit._parsed(forms.select("cluster_id", plain("form"), plain("canonical")), rare, "cluster_id", "form", "canonical")
    groups = audit._groups(parsed, "cluster_id", "form")
    # the witnesses of one place have its number of pairs each, and two places may have as many
    places = groups.where("kind IN ('ism', 'nasab')").select("cluster_id", "kind", "at", "n_pairs").distinct()
    rest = groups.where("kind NOT IN ('ism', 'nasab')").select("cluster_id", "kind", "at", "n_pairs")
    return places.unionByName(rest).groupBy("cluster_id", "kind").agg(F.sum("n_pairs").alias("n_pairs"))


# -- overlays, shelfmarks, keys -------------------------------------------------------------------
@query(f"""WITH v AS (SELECT c_nationkey AS n, {_sql(ISMS, 'c_custkey % 5')} AS key, c_custkey AS o FROM customer), f AS (SELECT n, key, arg_min(o, o) AS o FROM v GROUP BY 1, 2),
p AS (SELECT n, key, max(o) AS o FROM v WHERE o % 4 = 0 GROUP BY 1, 2),
o AS (SELECT n, CASE WHEN p.key IS NOT NULL THEN replace(f.key, 'س', 'سُ') WHEN f.o % 2 = 0 THEN replace(f.key, 'س', 'سَ') ELSE f.key END AS v FROM f LEFT JOIN p USING (n, key))
SELECT n::VARCHAR AS cluster_id, string_agg(v, '|' ORDER BY v) AS variants FROM o GROUP BY 1""")
def variant_overlay(spark, sf_dir):
    """The first spelling of each name in a nation, or its last pin; pins of names that no row has are dropped."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("cluster_id"), _pick(ISMS, k % 5).alias("plain"), k.alias("ord"))
    marked = lambda mark: F.replace("plain", F.lit("س"), F.lit("س" + mark))
    computed = rows.select("cluster_id", F.when(F.col("ord") % 2 == 0, marked("َ")).otherwise(F.col("plain")).alias("variant"), "ord")
    pinned = rows.where("ord % 4 = 0").select("cluster_id", marked("ُ").alias("variant"), "ord")
    gone = rows.where("ord % 9 = 0").select("cluster_id", F.lit("بلال").alias("variant"), "ord")
    return resolve.merge_variants(computed, pinned.unionByName(gone)).select("cluster_id", joined("variants").alias("variants"))


_SHELF = "CASE p_partkey % 7 WHEN 0 THEN {0} WHEN 1 THEN {1} WHEN 2 THEN {2} WHEN 3 THEN {3} WHEN 4 THEN {4} WHEN 5 THEN {5} ELSE {6} END"


@query(f"""SELECT p_partkey, {_SHELF.format("'Persan ' || n", "''", "'Fatih ' || n", "''", "'Nuru 7, ' || n", "'Halet ' || n", "n || ' mxt'")} AS shelfmark,
{_SHELF.format("''", "n || ' folios'", "'(2 vols.)'", "'(5 vols.)'", "'fol.' || n || 'b-' || (n + 3) || 'a'", "'pp.' || n || '-' || (n + 9) || ' (3 vols)'", "'fol.' || n || 'v'")} AS folios FROM (SELECT p_partkey, p_size + 10 AS n FROM part)""")
def shelfmark_split(spark, sf_dir):
    n = (F.col("p_size") + 10).cast("string")
    more = lambda k: (F.col("p_size") + 10 + k).cast("string")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    raw = [text("Persan", n), text(n, " folios"), text("Fatih ", n, " (2 vols.)"), text("(5 vols.)"), text("Nuru 7,", n, ", Fol.", n, "b- ", more(3), "a"), text("Halet  ", n, ", PP.", n, " -", more(9), " (3 vols)"), text(n, " mxt fol.,", n, "v")]
    kind = F.element_at(F.array(*raw), (F.col("p_partkey") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", fields.split_shelfmark(kind).alias("x")).select("p_partkey", "x.*")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Ana ' || upper(left(w, 1)) || substr(w, 2) WHEN 1 THEN upper(left(w, 1)) || substr(w, 2) || ' Ana' WHEN 2 THEN 'IfAO' ELSE 'Élise ' || upper(left(w, 1)) || substr(w, 2) END AS tidy FROM (SELECT c_custkey, lower(c_mktsegment) AS w FROM customer)""")
def latin_name_tidy(spark, sf_dir):
    w = F.lower("c_mktsegment")
    kinds = F.array(F.concat(w, F.lit(", ana")), F.concat(w, F.lit("   ana")), F.lit("IfAO"), F.concat(w, F.lit(",élise")))
    return table(spark, sf_dir, "customer").select("c_custkey", X.latin_author(F.element_at(kinds, (F.col("c_custkey") % 4 + 1).cast("int"))).alias("tidy"))


_KEYED = (("آ", "ا"), ("أ", "ا"), ("إ", "ا"), ("ٱ", "ا"), ("ى", "ي"), ("ة", "ه"))


@query(f"""SELECT c_custkey, 'ب' || {_sql([b for _, b in _KEYED], 'c_custkey % 6')} || name AS key, 'ب' || {_sql([a for a, _ in _KEYED], 'c_custkey % 6')} || name AS bare FROM (SELECT c_custkey, {_sql(NISBAS, 'c_custkey % 3')} AS name FROM customer)""")
def folded_keys(spark, sf_dir):
    k = F.col("c_custkey")
    raw = F.concat(F.lit("بّ"), _pick([a for a, _ in _KEYED], k % 6), F.lit("ـُ"), _pick(NISBAS, k % 3), F.lit("ْ"))
    return table(spark, sf_dir, "customer").select("c_custkey", X.normalize_ar(raw).alias("key"), X.bare(raw).alias("bare"))


@query("""SELECT p_partkey, replace(replace(replace(replace(replace(n, 'a', 'ā'), 'i', 'ī'), 's', 'ṣ'), 'd', 'ḏ'), 't', 'ṭ') AS full_form FROM (SELECT p_partkey, translate(p_name, 'u', 'o') AS n FROM part)""")
def shorthand(spark, sf_dir):
    """Names in which letters stand as they are typed without a keyboard for them."""
    typed = F.translate("p_name", "u", "o")
    for letter, mark in (("a", "a:"), ("i", "i:"), ("s", "s."), ("d", "d_"), ("t", "t.")):
        typed = F.replace(typed, F.lit(letter), F.lit(mark))
    return table(spark, sf_dir, "part").select("p_partkey", X.expand_shorthand(typed).alias("full_form"))


@query(f"""WITH w AS (SELECT DISTINCT {_sql(NISBAS, 'c_custkey % 3')} || substr({_sql(FATHERS, 'c_custkey % 7')}, 1, 1) AS word, substr({_sql(NISBAS, 'c_custkey % 3')}, 3 + c_custkey % 3, 1) AS letter FROM customer),
b AS (SELECT *, substr(word, 3) AS body FROM w), n AS (SELECT *, length(body) - length(replace(body, letter, '')) AS inside, length(word) - length(replace(word, letter, '')) AS everywhere FROM b)
SELECT word, letter, CASE WHEN inside = 1 THEN left(word, 2) || replace(body, letter, letter || 'ّ') WHEN inside = 0 AND everywhere = 1 THEN replace(word, letter, letter || 'ّ') END AS marked FROM n""")
def place_marks(spark, sf_dir):
    k, nisba = F.col("c_custkey"), _pick(NISBAS, F.col("c_custkey") % 3)
    words = table(spark, sf_dir, "customer").select(F.concat(nisba, F.left(_pick(FATHERS, k % 7), F.lit(1))).alias("word"), F.substr(nisba, (3 + k % 3).cast("int"), F.lit(1)).alias("letter")).distinct()
    return words.select("word", "letter", worklist.place_shadda(F.col("word"), F.col("letter")).alias("marked"))


_VOWELS, _MARKS = "aeiou", "ًْٰٕۖ"


@query("""SELECT doc_id, length(t) - length(translate(t, 'aeiou', '')) AS n_marks FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents)""")
def mark_ranges(spark, sf_dir):
    """Vowels are written as marks, and each text's characters that lie in a range of marks are counted."""
    plain = F.lower(F.coalesce("text", F.lit("")))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.translate(plain, _VOWELS, _MARKS).alias("t"))
    ranges = windows.mark_ranges(spark).select("first", "last")  # a few rows
    chars = docs.select("doc_id", F.explode(F.array_distinct(F.filter(F.split("t", ""), lambda c: c != ""))).alias("c"), "t").select("doc_id", F.ascii("c").alias("point"), (F.length("t") - F.length(F.replace("t", F.col("c"), F.lit("")))).alias("n"))
    found = chars.join(F.broadcast(ranges), F.col("point").between(F.col("first"), F.col("last"))).groupBy("doc_id").agg(F.sum("n").alias("n"))
    return docs.join(found, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).cast("int").alias("n_marks"))


@query("""WITH n AS (SELECT n_nationkey::VARCHAR AS cluster_id, CASE WHEN n_nationkey % 7 = 6 THEN '' ELSE translate(lower(regexp_replace(n_name, '[^A-Z]', '', 'g')), 'n', chr(97 + (n_nationkey * 11 % 26)::INTEGER)) || chr(97 + n_nationkey::INTEGER) END AS name FROM nation),
c AS (SELECT c_nationkey::VARCHAR AS cluster_id, count(*) AS n FROM customer GROUP BY 1) SELECT cluster_id, n, row_number() OVER (ORDER BY name = '', name, cluster_id) AS place FROM n JOIN c USING (cluster_id)""")
def authors_by_name(spark, sf_dir):
    """Names whose letters have accents and capitals here and there, in the order of their letters."""
    from lamina.operators import catalogue

    k = F.col("n_nationkey")
    plain = F.concat(F.translate(F.lower(F.regexp_replace("n_name", "[^A-Z]", "")), "n", "#"), F.char(97 + k))
    plain = F.replace(plain, F.lit("#"), F.char(97 + k * 11 % 26))
    dressed = F.when(k % 3 == 0, F.upper(plain)).when(k % 3 == 1, F.translate(plain, "aeiouyn", "áèîöúÿñ")).otherwise(plain)
    shown = F.when(k % 7 == 6, "").otherwise(dressed)
    clusters = table(spark, sf_dir, "nation").select(k.cast("string").alias("cluster_id"), F.lit("").alias("canonical_ar"), shown.alias("canonical_translit"), F.lit(None).cast("string").alias("full_name"), F.lit("").alias("dates"), F.lit(None).cast("string").alias("category"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("cluster_id"))
    found = catalogue.author_index(rows, clusters, sort="name")
    return fields.number(found.withColumn("o", F.struct((F.col("canonical_translit") == "").alias("blank"), F.collate("canonical_translit", "UNICODE").alias("name"), "cluster_id")), "place", ["o"]).select("cluster_id", "n", F.col("place").cast("long").alias("place"))
