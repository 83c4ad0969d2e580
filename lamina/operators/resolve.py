"""Entity resolution: buckets, pins, conservative clustering, canonical forms, ids, overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import textnorm as X
from lamina.functions.similarity import jaro_winkler
from lamina.operators.graph import components


def subset_edges(names: DataFrame, name: str = "name", particles: str = "ابو|ام", generic: tuple[str, ...] = X.GENERIC) -> DataFrame:
    """Pairs a < b of distinct names of which one's tokens hold all of the other's, which share a
    distinctive token, neither of which is a co-attribution ("-"), and whose kunyas don't differ.

    A name whose tokens another holds shares all of its distinctive tokens with it, so its rarest one
    is met with all of the other's: nothing is lost, and a frequent token meets itself only where it is
    all that a name has.
    """
    base = names.select(F.col(name).alias("n")).where(F.col("n").isNotNull() & (F.instr("n", "-") == 0)).distinct()
    keyed = base.select("n", F.array_distinct(X.tokens(F.col("n"))).alias("t"), X.kunya(F.col("n"), particles).alias("k"), F.explode(X.distinctive(F.col("n"), generic)).alias("d"))
    df = keyed.groupBy("d").agg(F.count("*").alias("df"))
    rarest = keyed.join(df, "d").groupBy("n").agg(F.min_by(F.struct("t", "k", "d"), F.struct("df", "d")).alias("x")).select("n", "x.*")
    a, b = rarest.alias("a"), keyed.alias("b")
    differ = F.coalesce(F.col("a.k") != F.col("b.k"), F.lit(False))
    within = a.join(b, (F.col("a.d") == F.col("b.d")) & (F.col("a.n") != F.col("b.n")) & (F.size(F.array_except("a.t", "b.t")) == 0) & ~differ)
    return within.select(F.least("a.n", "b.n").alias("a"), F.greatest("a.n", "b.n").alias("b")).distinct()


def cluster_names(names: DataFrame, name: str = "name", **rule) -> DataFrame:
    """name, component: the smallest name of those that edges of the rule tie together."""
    found = components(subset_edges(names, name, **rule)).select(F.col("node").alias(name), "component")
    return names.select(name).distinct().join(found, name, "left").select(name, F.coalesce("component", name).alias("component"))


def canonical(forms: DataFrame, key: list[str], form: str) -> DataFrame:
    """The most frequent form of each key; then the shortest, with the fewest spaces, the first."""
    counted = forms.groupBy(*key, form).agg(F.count("*").alias("n"))
    order = F.struct(-F.col("n"), F.length(form), F.length(form) - F.length(F.replace(form, F.lit(" "), F.lit(""))), F.col(form))
    return counted.groupBy(*key).agg(F.min_by(form, order).alias("canonical"), F.sum("n").alias("count"))


def _letters(form: str, width: str) -> Column:
    """The letters of a form as an array without repeats: each with the stretch of `width` places it is in and a number."""
    places = F.transform(F.filter(F.split(form, ""), lambda c: c != ""), lambda c, i: F.concat(c, F.lit(":"), F.floor(i / F.col(width)).cast("string")))
    return F.transform(places, lambda x, i: F.concat(x, F.lit(":"), F.size(F.filter(F.slice(places, F.lit(1), i), lambda y: y == x)).cast("string")))


def least_similarity(members: DataFrame, key: str, form: str) -> DataFrame:
    """key, least (the least Jaro-Winkler similarity of two forms; null for one form), n_forms and n_compared (pairs for which it was worked
    out) without working it out for all pairs.

    Letters at places less than half the shorter form's length apart can be matched, so two forms match in at least as many letters as
    they share by stretches of that length, which bounds the similarity from below. Distances in shared letters from one form of the key
    bound those of all pairs by sums. First that form and the one farthest from it are compared with all; then the
    pairs whose bounds, by the sums and after that by the letters they share, don't exceed what was found.
    """
    distinct = members.select(key, F.col(form).alias("f")).where(F.col(form).isNotNull()).distinct()
    sizes = distinct.groupBy(key).agg(F.count("*").alias("n_forms"), F.min("f").alias("pivot"), F.greatest(F.floor(F.min(F.length("f")) / 2), F.lit(1)).alias("__w"))
    lettered = distinct.join(sizes, key).withColumn("n", F.length("f")).withColumn("l", F.when(F.col("n") > 0, _letters("f", "__w")).otherwise(F.expr("cast(array() as array<string>)")))
    pivots = lettered.where("f = pivot").select(key, F.col("l").alias("__pl"), F.col("n").alias("__pn"))
    far = lettered.join(pivots, key).withColumn("d", F.col("n") + F.col("__pn") - 2 * F.size(F.array_intersect("l", "__pl"))).drop("__pl", "__pn")
    ends = far.groupBy(key).agg(F.max_by("f", F.struct("d", "f")).alias("__far"))
    seen = far.join(ends, key)
    against = lambda c: seen.where(F.col("f") != F.col(c)).select(key, "f", F.col(c).alias("g"))
    first = against("pivot").unionByName(against("__far")).select(key, F.least("f", "g").alias("f"), F.greatest("f", "g").alias("g")).distinct().withColumn("s", jaro_winkler(F.col("f"), F.col("g")))
    best = first.groupBy(key).agg(F.min("s").alias("__best"), F.count("*").alias("n_first"))
    ready = seen.join(best, key).select(key, "f", "n", "l", "d", "__best", "pivot", "__far")
    x, y = ready.alias("x"), ready.alias("y")

    def bound(matched: Column) -> Column:
        """From below, by the letters that match at least."""
        m = F.greatest(matched, F.lit(0))
        return F.when(m <= 0, 0.0).otherwise((m / F.col("x.n") + m / F.col("y.n") + 0.5) / 3)

    by_sums = bound((F.col("x.n") + F.col("y.n") - F.col("x.d") - F.col("y.d")) / 2) <= F.col("x.__best")
    fresh = ~F.col("x.f").isin(F.col("x.pivot"), F.col("x.__far")) & ~F.col("y.f").isin(F.col("x.pivot"), F.col("x.__far"))
    met = x.join(y, (F.col(f"x.{key}") == F.col(f"y.{key}")) & (F.col("x.f") < F.col("y.f")) & by_sums & fresh)
    met = met.where(bound(F.size(F.array_intersect("x.l", "y.l"))) <= F.col("x.__best"))
    rest = met.select(F.col(f"x.{key}").alias(key), jaro_winkler(F.col("x.f"), F.col("y.f")).alias("s")).groupBy(key).agg(F.min("s").alias("__rest"), F.count("*").alias("n_rest"))
    out = sizes.join(best, key, "left").join(rest, key, "left")
    return out.select(key, F.least("__best", "__rest").alias("least"), "n_forms", (F.coalesce("n_first", F.lit(0)) + F.coalesce("n_rest", F.lit(0))).alias("n_compared"))


def confidence(members: DataFrame, key: str, form: str) -> DataFrame:
    """The least Jaro-Winkler similarity within each key, to 3 places, ties to even; 1 for one form."""
    return least_similarity(members, key, form).select(key, F.coalesce(F.bround("least", 3), F.lit(1.0)).alias("confidence"))


def mint_ids(groups: DataFrame, order: list[Column], used: DataFrame, prefix: str = "n", digits: int = 3, start: int = 1) -> DataFrame:
    """Gives groups in order the free ids prefix001, prefix002, ... that `used` (column id) lacks."""
    from lamina.operators.fields import number

    ranked = number(groups.select("*", F.struct(*order).alias("__o")), "__k", ["__o"]).drop("__o")
    n = ranked.count() + used.count()
    ids = groups.sparkSession.range(start, n + start).select(F.format_string(f"{prefix}%0{digits}d", "id").alias("id"), F.col("id").alias("__i")).join(used, "id", "left_anti")
    return ranked.join(number(ids, "__k", ["__i"]).select("id", "__k"), "__k").drop("__k")


def merge_variants(computed: DataFrame, pinned: DataFrame, cluster: str = "cluster_id", value: str = "variant", order: str = "ord") -> DataFrame:
    """The first computed spelling of each key, replaced by its last pin; pins whose key is no longer
    computed are dropped. cluster, variants (distinct, ascending)."""
    key = X.normalize_ar(F.col(value))
    first = computed.withColumn("__k", key).groupBy(cluster, "__k").agg(F.min_by(value, order).alias("v"))
    pin = pinned.withColumn("__k", key).groupBy(cluster, "__k").agg(F.max_by(value, order).alias("p"))
    return first.join(pin, [cluster, "__k"], "left").groupBy(cluster).agg(F.array_sort(F.collect_set(F.coalesce("p", "v"))).alias("variants"))


def pin_split(rows: DataFrame, pins: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is pinned, with the pin's columns, and the rest."""
    return rows.join(pins, key), rows.join(pins, key, "left_anti")


def overlay(rows: DataFrame, overrides: DataFrame, fields: list[str], key: str = "id", values: str = "values") -> DataFrame:
    """overrides: key and a map from field to value. A field that is present wins, even if empty."""
    joined = rows.join(overrides.select(key, F.col(values).alias("__v")), key, "left")
    pick = lambda f: F.when(F.coalesce(F.map_contains_key("__v", F.lit(f)), F.lit(False)), F.try_element_at("__v", F.lit(f))).otherwise(F.col(f))
    return joined.withColumns({f: pick(f) for f in fields}).drop("__v")


def baseline_diff(baseline: DataFrame, export: DataFrame, fields: list[str], key: str = "id") -> DataFrame:
    """key and a map of the fields whose exported value differs from the baseline's."""
    clean = lambda c: X.clean(F.coalesce(c.cast("string"), F.lit("")))
    a, b = baseline.alias("a"), export.alias("b")
    entries = F.array_compact(F.array(*(F.when(clean(F.col(f"a.{f}")) != clean(F.col(f"b.{f}")), F.struct(F.lit(f).alias("key"), clean(F.col(f"b.{f}")).alias("value"))) for f in fields)))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}")).select(F.col(f"a.{key}").alias(key), F.map_from_entries(entries).alias("values")).where(F.size("values") > 0)


def check_ids(baseline: DataFrame, export: DataFrame, key: str = "id") -> None:
    """Both sides must hold the same ids; else positions have drifted."""
    missing, extra = baseline.join(export, key, "left_anti").count(), export.join(baseline, key, "left_anti").count()
    if missing or extra or baseline.count() != export.count():
        raise ValueError(f"ids differ: {missing} missing, {extra} unknown")


def conflicts(names: DataFrame, name: str, cluster: str, order: str) -> DataFrame:
    """Names that stand under several clusters, and the last cluster in order, which wins."""
    return names.groupBy(name).agg(F.array_sort(F.collect_set(cluster)).alias("clusters"), F.max_by(cluster, order).alias("winner")).where(F.size("clusters") > 1)


def prune_suggestions(suggestions: DataFrame, rows: DataFrame, key: str = "id") -> DataFrame:
    """suggestions: key and a map field -> value. Drops fields that are blank in the row, then rows
    without any left. rows: key and a map field -> value of the current row."""
    kept = F.map_filter("values", lambda k, v: F.trim(F.coalesce(F.try_element_at("current", k), F.lit(""))) != "")
    return suggestions.join(rows.select(key, F.col("values").alias("current")), key).select(key, kept.alias("values")).where(F.size("values") > 0)


def first_k(rows: DataFrame, group: str, order: str, k: int, value: str) -> DataFrame:
    """The first k values of each group in order, and how many more there are. Each task passes on k rows a group and
    counts the rest, so a frequent group meets nowhere."""
    ranked = rows.select(group, order, value).withColumn("__k", F.row_number().over(Window.partitionBy(group).orderBy(order)))
    first = ranked.where(F.col("__k") <= k).groupBy(group).agg(F.array_sort(F.collect_list(F.struct("__k", value))).alias("xs"))
    top = first.join(rows.groupBy(F.col(group).alias("__g")).agg(F.count("*").alias("n")), F.col(group).eqNullSafe(F.col("__g")))
    return top.select(group, F.transform("xs", lambda x: x[value]).alias(f"{value}s"), F.greatest(F.lit(0), F.col("n") - k).alias("more"))


def pick_translit(members: DataFrame, key: str, form: str, curated: DataFrame, order: str, roles: dict[str, str]) -> DataFrame:
    """For each key the first curated hit in order, else a Latin form as it is, else letter by letter.
    curated: name, translit. A trailing role in brackets is looked up without and put back translated."""
    role = F.trim(F.regexp_extract(form, r"\(([^)]*)\)\s*$", 1))
    base = F.trim(F.regexp_replace(form, r"\s*\([^)]*\)\s*$", ""))
    c = curated
    looked = members.withColumn("__base", base).withColumn("__role", role)
    hit = looked.join(c.select(F.col("name").alias(form), F.col("translit").alias("__t")), form, "left").join(c.select(F.col("name").alias("__base"), F.col("translit").alias("__bt")), "__base", "left")
    named = X.mapped(F.col("__role"), roles)
    with_role = F.when(F.col("__role").isin(*roles) & F.col("__bt").isNotNull(), F.concat(F.col("__bt"), F.lit(" ("), named, F.lit(")"))).otherwise(F.col("__bt"))
    found = hit.withColumn("__hit", F.coalesce("__t", with_role))
    picked = found.groupBy(key).agg(F.min_by("__hit", F.when(F.col("__hit").isNotNull(), F.col(order))).alias("hit"), F.min_by(form, order).alias("first"))
    return picked.select(key, F.coalesce("hit", F.when(~X.has_arabic(F.col("first")), F.col("first")), X.mechanical(F.col("first"))).alias("translit"))
