"""Every query of the library by name, and the SQL that gives the same rows.

Operators run over the star schema, the documents, and names and titles made of them. Lists are compared as joined strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import similarity as S
from lamina.functions import textnorm as X
from lamina.operators import audit, candidates, catalogue, fields, lexicon, resolve, windows, worklist

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(c: str, sep: str = "|"):
    return F.array_join(c, sep)


def _norm():
    return F.lower(F.trim(F.regexp_replace("text", r"[ \t\n\r]+", " ")))


def _tokens():
    return F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda t: t != "")


_NORM_SQL = r"lower(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g')))"
_TOKENS_SQL = "list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda t: t <> '')"


# -- audits ---------------------------------------------------------------------------------------


@query(f"""WITH d AS (SELECT {_NORM_SQL} AS norm_title, source FROM documents)
SELECT norm_title, array_to_string(list_sort(list(DISTINCT source)), '|') AS clusters FROM d
WHERE length(norm_title) >= 6 GROUP BY 1 HAVING count(DISTINCT source) > 1""")
def attribution_conflicts(spark, sf_dir):
    found = audit.attribution(table(spark, sf_dir, "documents"), _norm(), "source")
    return found.select("norm_title", joined("clusters").alias("clusters"))


@query(f"""WITH d AS (SELECT lang, {_NORM_SQL} AS norm_title, source FROM documents)
SELECT lang, norm_title, array_to_string(list_sort(list(DISTINCT source)), '|') AS clusters FROM d
WHERE lang <> '' AND norm_title <> '' GROUP BY 1, 2 HAVING count(DISTINCT source) > 1""")
def bundle_conflicts(spark, sf_dir):
    found = audit.bundle_conflict(table(spark, sf_dir, "documents"), "lang", _norm(), "source")
    return found.select("lang", "norm_title", joined("clusters").alias("clusters"))


@query("""WITH p AS (SELECT p_name, lower(p_brand) AS normalized, p_brand FROM part)
SELECT p_name AS normalized, array_to_string(list_sort(list(DISTINCT p_brand)), '|') AS spellings FROM p
GROUP BY 1 HAVING count(DISTINCT p_brand) > 1""")
def spelling_forms(spark, sf_dir):
    found = audit.title_forms(table(spark, sf_dir, "part"), "p_brand", F.col("p_name"))
    return found.select("normalized", joined("spellings").alias("spellings"))


@query("""SELECT s_name AS author, array_to_string(list_sort(list(DISTINCT s_nationkey::VARCHAR)), '|') AS clusters
FROM (SELECT c_mktsegment AS s_name, c_nationkey AS s_nationkey FROM customer) GROUP BY 1 HAVING count(DISTINCT s_nationkey) > 1""")
def conservation(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("author"), F.col("c_nationkey").cast("string").alias("cluster_id"))
    return audit.conservation(rows).select("author", joined("clusters").alias("clusters"))


@query(f"SELECT token, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct({_TOKENS_SQL})) AS token FROM documents) GROUP BY 1")
def token_df(spark, sf_dir):
    return audit.token_df(table(spark, sf_dir, "documents"), _tokens(), "doc_id")


@query(f"SELECT token, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct({_TOKENS_SQL})) AS token FROM documents) GROUP BY 1 HAVING count(*) <= 3")
def rare_tokens(spark, sf_dir):
    return audit.rare(token_df(spark, sf_dir))


@query("""SELECT 'attribution' AS worklist, count(*) AS n FROM (SELECT p_name FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1)
UNION ALL SELECT 'case', count(*) FROM customer WHERE c_name <> lower(c_name)""")
def worklist_totals(spark, sf_dir):
    part, customer = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    return audit.totals(attribution=audit.several(part, ["p_name"], "p_brand"), case=customer.where(F.col("c_name") != F.lower("c_name")))


# -- candidates and similarity --------------------------------------------------------------------


@query("""WITH t AS (SELECT DISTINCT p_name AS id, unnest(string_split(p_name, ' ')) AS tok FROM (SELECT DISTINCT p_name FROM part)),
k AS (SELECT DISTINCT id, 't:' || tok AS key FROM t WHERE length(tok) >= 4 UNION SELECT DISTINCT id, 'p:' || left(tok, 4) FROM t WHERE length(tok) >= 4),
b AS (SELECT p_name AS id, string_split(p_name, ' ') AS w FROM (SELECT DISTINCT p_name FROM part)),
kb AS (SELECT id, 'b:' || w[i] || ' ' || w[i + 1] AS key FROM (SELECT id, w, unnest(range(1, len(w))) AS i FROM b) WHERE length(w[i]) >= 3 AND length(w[i + 1]) >= 3),
g AS (SELECT key, array_to_string(list_sort(list(DISTINCT id)), '|') AS members FROM (SELECT * FROM k UNION SELECT * FROM kb) GROUP BY 1 HAVING count(DISTINCT id) BETWEEN 2 AND 40)
SELECT members, count(*) AS n_keys FROM g GROUP BY 1""")
def key_groups(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("id")).distinct()
    keyed = parts.select("id", F.explode(candidates.keys(F.split("id", " "), F.expr("cast(array() as array<string>)"))).alias("k")).select("id", "k.*")
    found = candidates.groups(keyed.withColumn("label", F.col("key")), max_df=40)
    return found.select(joined("members").alias("members"), F.size("labels").cast("long").alias("n_keys"))


@query("""WITH p AS (SELECT DISTINCT p_name AS s FROM part)
SELECT a.s AS a, b.s AS b FROM p a JOIN p b ON a.s < b.s
WHERE levenshtein(a.s, b.s) BETWEEN 1 AND 2 AND levenshtein(a.s, b.s) / greatest(length(a.s), length(b.s)) <= 0.25""")
def spelling_neighbours(spark, sf_dir):
    return candidates.neighbours(table(spark, sf_dir, "part"), "p_name")


@query("""WITH p AS (SELECT DISTINCT p_brand, p_name FROM part),
m AS (SELECT a.p_brand, min(jaro_winkler_similarity(a.p_name, b.p_name)) AS s FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_name < b.p_name GROUP BY 1)
SELECT p_brand, coalesce(round_even(s, 3), 1.0) AS confidence FROM (SELECT DISTINCT p_brand FROM p) LEFT JOIN m USING (p_brand)""")
def jaro_winkler_min(spark, sf_dir):
    return resolve.confidence(table(spark, sf_dir, "part"), "p_brand", "p_name")


@query("""SELECT s_name, n_name, round(jaro_similarity(s_name, n_name), 9) AS jaro, round(jaro_winkler_similarity(s_name, n_name), 9) AS winkler
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def similarity_scores(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 rows
    return rows.select("s_name", "n_name", F.round(S.jaro(F.col("s_name"), F.col("n_name")), 9).alias("jaro"), F.round(S.jaro_winkler(F.col("s_name"), F.col("n_name")), 9).alias("winkler"))


# -- resolution -----------------------------------------------------------------------------------


@query("""WITH RECURSIVE n AS (SELECT DISTINCT p_name AS s, list_distinct(string_split(p_name, ' ')) AS t FROM part),
e AS (SELECT a.s AS a, b.s AS b FROM n a JOIN n b ON a.s <> b.s AND (list_has_all(a.t, b.t) OR list_has_all(b.t, a.t))
      AND len(list_filter(list_intersect(a.t, b.t), lambda x: length(x) > 2)) > 0),
r AS (SELECT s AS a, s AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT a AS name, min(b) AS component FROM r GROUP BY 1""")
def name_components(spark, sf_dir):
    return resolve.cluster_names(table(spark, sf_dir, "part").select(F.col("p_name").alias("name")))


@query("""WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)
SELECT p_brand, first(p_type ORDER BY n DESC, length(p_type), length(p_type) - length(replace(p_type, ' ', '')), p_type) AS canonical, CAST(sum(n) AS BIGINT) AS count FROM c GROUP BY 1""")
def canonical_pick(spark, sf_dir):
    return resolve.canonical(table(spark, sf_dir, "part"), ["p_brand"], "p_type")


@query("""WITH g AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_brand) AS k FROM g),
f AS (SELECT printf('n%03d', i) AS id, row_number() OVER (ORDER BY i) AS k FROM generate_series(1, 1000) t(i) WHERE printf('n%03d', i) NOT IN ('n001', 'n004'))
SELECT p_brand, n, id FROM r JOIN f USING (k)""")
def mint_ids(spark, sf_dir):
    groups = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    used = spark.createDataFrame([("n001",), ("n004",)], "id string")
    return resolve.mint_ids(groups, [-F.col("n"), F.col("p_brand")], used)


@query("""SELECT c_custkey, c_name, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def override_overlay(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    overrides = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("values", F.expr("map('c_mktsegment', '')"))
    return resolve.overlay(customer, overrides, ["c_mktsegment"], "c_custkey").select("c_custkey", "c_name", "c_mktsegment")


@query("""SELECT c_custkey, 'c_mktsegment=' || lower(c_mktsegment) AS changed FROM customer WHERE c_mktsegment <> lower(c_mktsegment)""")
def baseline_diff(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    found = resolve.baseline_diff(customer, customer.withColumn("c_mktsegment", F.lower("c_mktsegment")), ["c_name", "c_mktsegment"], "c_custkey")
    return found.select("c_custkey", F.array_join(F.transform(F.map_entries("values"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("changed"))


@query("""SELECT c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AS pinned, count(*) AS n FROM customer GROUP BY 1""")
def pin_split(spark, sf_dir):
    pins = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    pinned, rest = resolve.pin_split(table(spark, sf_dir, "customer"), pins, "c_nationkey")
    return pinned.agg(F.count("*").alias("n")).select(F.lit(True).alias("pinned"), "n").unionByName(rest.agg(F.count("*").alias("n")).select(F.lit(False).alias("pinned"), "n"))


@query("""SELECT p_brand, array_to_string(list_sort(list(DISTINCT p_type)), '|') AS clusters, arg_max(p_type, p_partkey) AS winner FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1""")
def name_conflicts(spark, sf_dir):
    return resolve.conflicts(table(spark, sf_dir, "part"), "p_brand", "p_type", "p_partkey").select("p_brand", joined("clusters").alias("clusters"), "winner")


@query("""WITH r AS (SELECT c_nationkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer)
SELECT c_nationkey, string_agg(c_name, '|' ORDER BY k) FILTER (k <= 4) AS c_names, greatest(0, count(*) - 4) AS more FROM r GROUP BY 1""")
def sample_titles(spark, sf_dir):
    return resolve.first_k(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey", 4, "c_name").select("c_nationkey", joined("c_names").alias("c_names"), "more")


@query("""SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 12""")
def top_clusters(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c_nationkey").limit(12)


# -- fields ---------------------------------------------------------------------------------------


@query("""WITH e AS (SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN 'C' || user_id END AS city, CASE WHEN event_type = 'click' THEN 'L' || user_id END AS library FROM events),
a AS (SELECT *, last_value(city IGNORE NULLS) OVER (PARTITION BY user_id % 7 ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS c FROM e),
b AS (SELECT *, CASE WHEN c IS DISTINCT FROM lag(c) OVER (PARTITION BY user_id % 7 ORDER BY event_id) THEN 1 ELSE 0 END AS t FROM a),
r AS (SELECT *, sum(t) OVER (PARTITION BY user_id % 7 ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM b)
SELECT event_id, coalesce(c, '') AS city, coalesce(last_value(library IGNORE NULLS) OVER (PARTITION BY user_id % 7, run ORDER BY event_id ROWS UNBOUNDED PRECEDING), '') AS library FROM r""")
def ffill_reset(spark, sf_dir):
    when = lambda kind, p: F.when(F.col("event_type") == kind, F.concat(F.lit(p), F.col("user_id").cast("string")))
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 7).alias("volume"), when("purchase", "C").alias("city"), when("click", "L").alias("library"))
    return fields.fill_down(rows, "event_id", partition="volume").select("event_id", "city", "library")


@query("""SELECT printf('r%04d', row_number() OVER (ORDER BY o_orderdate, o_orderkey)) AS id, o_orderkey FROM orders""")
def row_ids(spark, sf_dir):
    return fields.mint_row_ids(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"]).select("id", "o_orderkey")


@query("""SELECT DISTINCT n_name AS place FROM nation WHERE n_name NOT IN ('FRANCE', 'GERMANY', '')""")
def unmapped_places(spark, sf_dir):
    return fields.unmapped(table(spark, sf_dir, "nation"), "n_name", {"FRANCE": "France"}, ("GERMANY",))


# -- lexicon --------------------------------------------------------------------------------------
_PAIRS_SQL = """p AS (SELECT event_id AS doc_id, l, r FROM (SELECT event_id, unnest(string_split(event_type || ' ' || (user_id % 50), ' ')) AS l, unnest(string_split(upper(event_type) || ' ' || (event_id % 3), ' ')) AS r FROM events))"""


def _pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    left = F.array("event_type", (F.col("user_id") % 50).cast("string"))
    right = F.array(F.upper("event_type"), (F.col("event_id") % 3).cast("string"))
    return lexicon.aligned(rows, left, right, ("event_id",))


@query(f"WITH {_PAIRS_SQL} SELECT l, r, count(*) AS n FROM p GROUP BY 1, 2")
def aligned_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).groupBy("l", "r").agg(F.count("*").alias("n"))


@query(f"WITH {_PAIRS_SQL} SELECT l AS key, array_to_string(list_sort(list(DISTINCT r)), '|') AS readings, count(DISTINCT r) > 1 AS contested FROM p GROUP BY 1")
def contested_keys(spark, sf_dir):
    return lexicon.readings(_pairs(spark, sf_dir)).select("key", joined("readings").alias("readings"), "contested")


@query(f"WITH {_PAIRS_SQL} SELECT l AS key, min(r) AS reading FROM p GROUP BY 1 HAVING count(DISTINCT r) = 1")
def learned_lexicon(spark, sf_dir):
    return lexicon.lexicon(lexicon.readings(_pairs(spark, sf_dir)))


@query(f"""WITH t AS (SELECT doc_id, list_distinct({_TOKENS_SQL}) AS w FROM documents), e AS (SELECT doc_id, unnest(w) AS word FROM t),
k AS (SELECT word FROM e GROUP BY 1 HAVING count(*) > 3), u AS (SELECT * FROM e WHERE word NOT IN (SELECT word FROM k)), n AS (SELECT doc_id, count(*) AS c FROM u GROUP BY 1)
SELECT word, count(*) AS titles, CAST(sum(CASE WHEN c = 1 THEN 1 ELSE 0 END) AS BIGINT) AS unlocks FROM u JOIN n USING (doc_id) GROUP BY 1""")
def unlock_rank(spark, sf_dir):
    known = token_df(spark, sf_dir).where("df > 3").select(F.col("token").alias("word"))
    return lexicon.unlocks(table(spark, sf_dir, "documents"), _tokens(), known, "doc_id")


@query("""WITH v AS (SELECT CASE WHEN o_orderpriority = '' THEN 'independent' WHEN o_orderstatus = left(o_orderpriority, 1) THEN 'accepted' ELSE 'overridden' END AS verdict FROM orders WHERE o_orderstatus <> '')
SELECT verdict, count(*) AS n, round_even(100.0 * count(*) / sum(count(*)) OVER (), 3) AS percent FROM v GROUP BY 1""")
def provenance_tally(spark, sf_dir):
    return lexicon.provenance(table(spark, sf_dir, "orders").withColumn("o_orderpriority", F.left("o_orderpriority", F.lit(1))), "o_orderstatus", "o_orderpriority")


@query("""SELECT event_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS following FROM events""")
def next_word(spark, sf_dir):
    from pyspark.sql import Window

    return table(spark, sf_dir, "events").select("event_id", "event_type", F.lead("event_type").over(Window.partitionBy("user_id").orderBy("event_id")).alias("following"))


# -- adjudication ---------------------------------------------------------------------------------


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def keep_antijoin(spark, sf_dir):
    keeps = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return worklist.pending(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id"), keeps).select(F.col("id").alias("c_custkey"))


@query("""SELECT CAST(min(v) AS BIGINT) AS first, CAST(max(v) AS BIGINT) AS last, count(*) AS n, u AS user_id FROM (SELECT user_id AS u, event_id AS v, event_id - row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM (SELECT DISTINCT user_id, event_id FROM events)) GROUP BY u, g""")
def islands(spark, sf_dir):
    return windows.islands(table(spark, sf_dir, "events"), "event_id", ["user_id"])


# -- read layer -----------------------------------------------------------------------------------


@query("""SELECT count(*) AS n_rows, count(DISTINCT nullif(trim(c_mktsegment), '')) AS n_libraries, count(DISTINCT nullif(trim(n_name), '')) AS n_cities, count(DISTINCT c_nationkey) AS n_authors, count_if(c_mktsegment = 'BUILDING') AS n_published
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def catalogue_kpis(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows
    status = F.when(F.col("c_mktsegment") == "BUILDING", "published")
    return catalogue.kpis(rows.withColumn("status", status), "c_mktsegment", "n_name", "c_nationkey", "status").select("n_rows", "n_libraries", "n_cities", "n_authors", F.col("n_published").cast("decimal(38,0)").cast("long").alias("n_published"))


@query("""SELECT n_nationkey::VARCHAR AS cluster_id, n_name AS canonical_translit, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE contains(lower(n_name), '_1') GROUP BY 1, 2""")
def author_index(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("cluster_id"), F.lit("").alias("canonical_ar"), F.col("n_name").alias("canonical_translit"), F.lit("").alias("full_name"), F.lit("").alias("dates"), F.lit(None).cast("string").alias("category"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("cluster_id"))
    return catalogue.author_index(rows, nation, query="_1").select("cluster_id", "canonical_translit", "n")


@query("""SELECT 'c_mktsegment' AS facet, c_mktsegment AS value, count(*) AS n FROM customer WHERE c_nationkey = 3 GROUP BY 2
UNION ALL SELECT 'c_nationkey', c_nationkey::VARCHAR, count(*) FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 2""")
def facet_counts(spark, sf_dir):
    return catalogue.facets(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"], {"c_mktsegment": "BUILDING", "c_nationkey": 3})


@query("""SELECT r_name AS city, n_name AS library, count(*) AS n, CAST(CASE grouping(r_name, n_name) WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS INTEGER) AS level
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def place_rollup(spark, sf_dir):
    nation = F.broadcast(table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")))  # 25 rows
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return catalogue.places(rows.select(F.col("r_name").alias("city"), F.col("n_name").alias("library")), "city", "library")


@query("""SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND contains(lower(c_name), '00012')""")
def catalogue_search(spark, sf_dir):
    return catalogue.search(table(spark, sf_dir, "customer"), "00012", ["c_name"], {"c_mktsegment": "BUILDING"}).select("c_custkey")


@query("""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages""")
def url_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"))


@query("""SELECT event_id, k AS key, json_extract_string(props, '$.' || k) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def json_map_explode(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))


from lamina.plans import catalogue_queries, decision_queries, name_queries  # noqa: E402, F401  add their queries
