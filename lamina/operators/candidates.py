"""Candidate groups by colliding keys, never united, and neighbours in spelling by exact blocking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.similarity import spelling_neighbours

MAX_DF = 4


def keys(content: Column, arabic: Column, common: tuple[str, ...] = (), given: tuple[str, ...] = (), common_arabic: tuple[str, ...] = ()) -> Column:
    """array<struct<key, label>> of a record with content and Arabic tokens: whole tokens, stems of
    four characters, adjacent pairs that aren't two given names, Arabic tokens."""
    full = F.filter(content, lambda t: F.length(t) >= 3)
    rare = F.filter(full, lambda t: (F.length(t) >= 4) & ~t.isin(*common, ""))
    made = lambda kind: lambda x: F.struct(F.concat(F.lit(f"{kind}:"), x).alias("key"), x.alias("label"))
    stems = F.transform(rare, lambda t: F.substr(t, F.lit(1), F.lit(4)))
    pairs = F.filter(F.zip_with(F.slice(full, F.lit(1), F.greatest(F.size(full) - 1, F.lit(0))), F.slice(full, F.lit(2), F.greatest(F.size(full) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: ~(p["a"].isin(*given, "") & p["b"].isin(*given, "")))
    ar = F.filter(arabic, lambda t: (F.length(t) >= 3) & ~t.isin(*common_arabic, ""))
    return F.array_distinct(F.concat(
        F.transform(rare, made("t")),
        F.transform(stems, lambda s: F.struct(F.concat(F.lit("p:"), s).alias("key"), F.concat(s, F.lit("…")).alias("label"))),
        F.transform(pairs, lambda p: F.struct(F.concat(F.lit("b:"), p["a"], F.lit(" "), p["b"]).alias("key"), F.concat(p["a"], F.lit(" "), p["b"]).alias("label"))),
        F.transform(ar, made("a")),
    ))


def groups(keyed: DataFrame, record: str = "id", max_df: int = MAX_DF) -> DataFrame:
    """keyed: record, key, label. Keys of 2 to max_df records, those with the same members as one
    group: members (ascending), labels, the longest label first.

    Keys are counted before their members are gathered, so a frequent key never meets in one task.
    """
    distinct = keyed.groupBy("key", record).agg(F.min("label").alias("label"))
    fit = distinct.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n").between(2, max_df)).select("key")
    members = distinct.join(fit, "key").groupBy("key").agg(F.array_sort(F.collect_list(record)).alias("members"), F.min("label").alias("label"))
    order = lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0)
    return members.groupBy("members").agg(F.array_sort(F.collect_set("label"), order).alias("labels"))


def rank(grouped: DataFrame, records: DataFrame, record: str = "id") -> DataFrame:
    """Adds label, n_confirmed, suggested_keep (confirmed, full name, highest count) and bare (whether a
    member has no full name) and by_count (the members, those with the highest count first), in order: bare first, fewer members, longer label."""
    members = grouped.withColumn("__m", F.explode("members")).join(records.withColumnRenamed(record, "__m"), "__m")
    best = F.struct(~F.col("user_confirmed"), F.coalesce("full_name", F.lit("")) == "", -F.col("count"), F.col("__m"))
    out = members.groupBy("members", "labels").agg(F.sum(F.col("user_confirmed").cast("int")).alias("n_confirmed"), F.min_by("__m", best).alias("suggested_keep"), F.max(F.coalesce("full_name", F.lit("")) == "").alias("bare"), F.transform(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("c"), F.col("__m").alias("m")))), lambda x: x["m"]).alias("by_count"))
    out = out.withColumn("label", F.get("labels", F.lit(0)))
    return out.orderBy(F.desc("bare"), F.size("members"), F.desc(F.length("label")), "members")


def neighbours(strings: DataFrame, value: str = "s") -> DataFrame:
    """Pairs a < b of distinct strings two edits apart at most, and a quarter of the longer.

    Of three even segments of a string, two edits leave one whole, at most two places away, in any
    other (Li et al., Pass-Join, PVLDB 5(3)). So a join on segments finds every pair.
    """
    base = strings.select(F.col(value).alias("s")).where(F.coalesce(F.col(value), F.lit("")) != "").distinct()
    cut = "CASE k WHEN 0 THEN 0 WHEN 1 THEN n DIV 3 WHEN 2 THEN (2 * n) DIV 3 ELSE n END"
    at = lambda k: cut.replace("k", k, 1)
    own = base.select("s", F.length("s").alias("n"), F.explode(F.array(*map(F.lit, range(3)))).alias("k"))
    own = own.select("s", "n", "k", F.expr(f"substring(s, ({at('k')}) + 1, ({at('(k + 1)')}) - ({at('k')}))").alias("seg"))
    probe = base.select("s", F.length("s").alias("m"), F.explode(F.expr("sequence(greatest(length(s) - 2, 1), length(s) + 2)")).alias("n")).select("*", F.explode(F.array(*map(F.lit, range(3)))).alias("k"))
    probe = probe.select("s", "n", "k", F.expr(f"({at('(k + 1)')}) - ({at('k')})").alias("size"), F.explode(F.expr(f"sequence(({at('k')}) - 2, ({at('k')}) + 2)")).alias("p"), "m").where("p >= 0 AND p + size <= m")
    probe = probe.select("s", "n", "k", F.expr("substring(s, p + 1, size)").alias("seg")).distinct()
    a, b = own.alias("a"), probe.alias("b")
    near = spelling_neighbours(F.col("a.s"), F.col("b.s"))
    met = a.join(b, (F.col("a.n") == F.col("b.n")) & (F.col("a.k") == F.col("b.k")) & (F.col("a.seg") == F.col("b.seg")) & (F.col("a.s") != F.col("b.s")) & near)
    return met.select(F.least("a.s", "b.s").alias("a"), F.greatest("a.s", "b.s").alias("b")).distinct()


def decide(grouped: DataFrame, decisions: DataFrame) -> DataFrame:
    """The export of all groups: decisions (group_id, action, keep, merged, note) over the default of
    keeping the suggestion; a merge with nothing ticked merges all others; the kept one is never
    merged; other actions merge nothing. An untouched group is there with a null action."""
    d = grouped.join(decisions, "group_id", "left").withColumn("keep", F.coalesce("keep", "suggested_keep"))
    others = F.array_except("members", F.array("keep"))
    ticked = F.filter(F.coalesce("merged", F.expr("cast(array() as array<string>)")), lambda x: x != F.col("keep"))
    return d.withColumn("merged", F.when(F.col("action") == "merge", F.when(F.size(ticked) > 0, ticked).otherwise(others)).otherwise(F.expr("cast(array() as array<string>)")))


def merge_transcript(decided: DataFrame, clusters: DataFrame) -> DataFrame:
    """variant, keep: one row for each variant of each merged cluster."""
    merged = decided.where("action = 'merge'").select("keep", F.explode("merged").alias("cluster_id"))
    return merged.join(clusters, "cluster_id").select(F.explode("variants").alias("variant"), "keep").distinct()
