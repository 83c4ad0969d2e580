"""Audits that look for grounds against what a catalogue asserts. Each returns its worklist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions import names as N
from lamina.functions import textnorm as X
from lamina.operators.graph import saved


def token_df(rows: DataFrame, tokens: Column, key: str = "id") -> DataFrame:
    """token, df: in how many rows each token is."""
    return rows.select(key, F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def rare(df: DataFrame, most: int = 3) -> DataFrame:
    return df.where(F.col("df") <= most)


def memberships(rows: DataFrame, by: list[str], member: str) -> DataFrame:
    """by, member and n: the distinct members of each key that has more than one, a row each, and how many there are. Keys whose
    least and largest member are one are left out before anything meets."""
    pairs = rows.select(*by, member).where(F.col(member).isNotNull()).distinct()
    counted = pairs.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1")
    return pairs.join(counted, by)


def several(rows: DataFrame, by: list[str], member: str, out: str = "members") -> DataFrame:
    """Keys that have more than one distinct member, and the members as an array. A key with one member, however frequent, is told by its
    least and largest and never gathered; the array holds distinct members only. Where those may be very many, memberships()
    gives them row by row."""
    ends = rows.where(F.col(member).isNotNull()).groupBy(*by).agg(F.min(member).alias("__lo"), F.max(member).alias("__hi")).where("__lo < __hi").select(*by)
    pairs = rows.select(*by, member).where(F.col(member).isNotNull()).join(ends, by, "left_semi").distinct()
    return pairs.groupBy(*by).agg(F.array_sort(F.collect_list(member)).alias(out))


def conservation(rows: DataFrame, author: str = "author", cluster: str = "cluster_id") -> DataFrame:
    """One spelling, several clusters."""
    return several(rows.where(F.trim(author) != ""), [author], cluster, "clusters")


def under_merge(clusters: DataFrame, name: str = "canonical_ar", cluster: str = "cluster_id") -> DataFrame:
    """Clusters that orthography alone keeps apart."""
    return several(clusters.withColumn("folded", X.fold_orthography(X.normalize_ar(F.col(name)))), ["folded"], cluster, "clusters")


def attribution(rows: DataFrame, title: Column, cluster: str, least: int = 6) -> DataFrame:
    """One title of `least` characters or more, several authors."""
    return several(rows.withColumn("norm_title", title).where(F.length("norm_title") >= least), ["norm_title"], cluster, "clusters")


def bundle_conflict(rows: DataFrame, bundle: str, title: Column, cluster: str) -> DataFrame:
    """One title in one bundle, several authors. A shared bundle alone says nothing."""
    return several(rows.withColumn("norm_title", title).where((F.col(bundle) != "") & (F.col("norm_title") != "")), [bundle, "norm_title"], cluster, "clusters")


def case_drift(rows: DataFrame, title: str = "title", translit: str = "title_translit", key: str = "id") -> DataFrame:
    return rows.where(X.has_arabic(F.col(title)) & (F.col(translit) != F.lower(translit))).select(key, F.col(translit).alias("value"), F.lower(translit).alias("expected"))


def title_forms(rows: DataFrame, title: str, norm: Column) -> DataFrame:
    """One folded title, several spellings."""
    return several(rows.withColumn("normalized", norm).where("normalized <> ''"), ["normalized"], title, "spellings")


#: A cluster of at most so many forms is judged pair by pair.
PAIRS = 40


def _parsed(forms: DataFrame, rare_tokens: DataFrame, cluster: str, form: str, canonical: str) -> DataFrame:
    """cluster, form, canonical, their parses p and c, and the form's rare tokens."""
    distinct = forms.select(cluster, form, canonical).distinct().withColumn("p", N.parse(X.normalize_ar(F.col(form)))).withColumn("c", N.parse(X.normalize_ar(F.col(canonical))))
    each = distinct.select(cluster, form, F.explode_outer(N.folded(F.col("p"))).alias("token")).join(rare_tokens.select("token").distinct().withColumn("r", F.col("token")).hint("merge"), "token", "left")
    own = each.groupBy(cluster, form).agg(F.array_compact(F.collect_set("r")).alias("rare"))
    return distinct.join(own.hint("merge"), [cluster, form])


def _judged(pairs: DataFrame, cluster: str, form: str) -> DataFrame:
    """cluster, form_a, form_b, severity, reasons of pairs a, b, a's form before b's, that there is something against. A pair is judged once: a
    filter would be put below, and judge it a second time."""
    judged = F.struct(N.refute(F.col("a.p"), F.col("b.p")).alias("up"), N.weak_link(F.col("a.p"), F.col("b.p"), F.col("a.rare")).alias("weak"))
    some = F.filter(F.array(judged), lambda j: (F.size(j["up"]) > 0) | j["weak"].isNotNull())
    out = pairs.select(F.col(f"a.{cluster}").alias(cluster), F.col(f"a.{form}").alias("form_a"), F.col(f"b.{form}").alias("form_b"), F.explode(some).alias("j"))
    against = F.size("j.up") > 0
    return out.select(cluster, "form_a", "form_b", F.when(against, "refute").otherwise("weak").alias("severity"), F.when(against, F.col("j.up")).otherwise(F.array("j.weak")).alias("reasons"))


def _groups(ready: DataFrame, cluster: str, form: str) -> DataFrame:
    """cluster, kind, at (the place in the chain), a, b (forms that disagree) and n_pairs (how many pairs of forms disagree in that way at that
    place) for clusters of any size, from groups and never from pairs of forms: for each ground, forms are grouped by what decides it."""
    key = lambda c: N.key(F.col(c) if isinstance(c, str) else c)
    child = key(F.nullif(F.regexp_extract(F.col("p.kunya"), r"^\S+ (.+)$", 1), F.lit("")))
    base = ready.select(
        cluster, F.col(form).alias("form"), key("p.ism").alias("ism"), child.alias("child"), N.key(F.coalesce("p.ism", "p.head")).alias("name"),
        F.transform("p.chain", N.key).alias("chain"), F.col("p.shuhrah").alias("shuhrah"),
    )

    def differing(groups: DataFrame, kind, near: DataFrame | None = None) -> DataFrame:
        """groups: cluster, at, value, n and form. A witness against the largest group of each place for each other one."""
        top = groups.groupBy(cluster, "at").agg(F.max_by(F.struct("value", "form", "n"), F.struct("n", "value")).alias("top"), F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("squares"))
        met = groups.join(top, [cluster, "at"]).where(F.col("value") != F.col("top.value"))
        counted = top.withColumn("n_pairs", ((F.col("all") * F.col("all") - F.col("squares")) / 2).cast("long"))
        if near is not None:
            counted = counted.join(near, [cluster, "at"], "left").withColumn("n_pairs", F.col("n_pairs") - F.coalesce("n_near", F.lit(0)))
        return met.select(cluster, "at", "form", F.col("top.form").alias("other")).join(counted.select(cluster, "at", "n_pairs"), [cluster, "at"]).where("n_pairs > 0").select(cluster, kind.alias("kind"), "at", F.col("other").alias("a"), F.col("form").alias("b"), "n_pairs")

    grouped = lambda df: df.groupBy(cluster, "at", "value").agg(F.count("*").alias("n"), F.min("form").alias("form"))
    isms = grouped(base.where("ism IS NOT NULL").select(cluster, F.lit(0).alias("at"), F.col("ism").alias("value"), "form"))
    places = base.where("NOT shuhrah").select(cluster, "form", F.posexplode("chain").alias("at", "value")).where("value IS NOT NULL")
    out = differing(isms, F.lit("ism")).unionByName(differing(grouped(places), F.lit("nasab")))
    fathers = base.where("child IS NOT NULL").groupBy(cluster, F.col("child").alias("value")).agg(F.count("*").alias("n"), F.min("form").alias("a"), F.max("form").alias("a2"))
    sons = base.where("name IS NOT NULL").groupBy(cluster, F.col("name").alias("value")).agg(F.count("*").alias("m"), F.min("form").alias("b"), F.max("form").alias("b2"))
    itself = base.where("child = name").groupBy(cluster, F.col("child").alias("value")).agg(F.count("*").alias("k"))
    kin = fathers.join(sons, [cluster, "value"]).join(itself, [cluster, "value"], "left").withColumn("n_pairs", F.col("n") * F.col("m") - F.coalesce("k", F.lit(0)))
    # a form may be both; then another one is on the one side or the other
    son = F.when(F.col("b") != F.col("a"), F.col("b")).otherwise(F.col("b2"))
    out = out.unionByName(kin.where("n_pairs > 0").select(cluster, F.lit("kunya").alias("kind"), F.lit(0).alias("at"), F.when(son != F.col("a"), F.col("a")).otherwise(F.col("a2")).alias("a"), son.alias("b"), "n_pairs"))
    of = base.where("ism IS NOT NULL AND get(chain, 0) IS NOT NULL").groupBy(cluster, "ism", F.get("chain", F.lit(0)).alias("father")).agg(F.count("*").alias("n"), F.min("form").alias("form"))
    x, y = of.alias("x"), of.alias("y")
    turned = x.join(y, (F.col(f"x.{cluster}") == F.col(f"y.{cluster}")) & (F.col("x.ism") == F.col("y.father")) & (F.col("x.father") == F.col("y.ism")) & (F.col("x.ism") < F.col("y.ism")))
    return out.unionByName(turned.select(F.col(f"x.{cluster}").alias(cluster), F.lit("inverted").alias("kind"), F.lit(0).alias("at"), F.col("x.form").alias("a"), F.col("y.form").alias("b"), (F.col("x.n") * F.col("y.n")).alias("n_pairs")))


def disagreements(forms: DataFrame, rare_tokens: DataFrame, cluster: str = "cluster_id", form: str = "form", canonical: str = "canonical") -> DataFrame:
    """cluster, kind (ism, nasab, kunya, inverted), at (the place in the chain), form_a, form_b and n_pairs: for each way in which a cluster's forms disagree, a
    witness for each group of forms that differs from the largest, and how many pairs disagree so in all (for nasab a bound from above, and each place in
    the chain by itself, since fathers one letter apart are taken for one). No pairs of forms are made, however many a cluster has."""
    found = _groups(_parsed(forms, rare_tokens, cluster, form, canonical), cluster, form)
    return found.select(cluster, "kind", "at", F.least("a", "b").alias("form_a"), F.greatest("a", "b").alias("form_b"), "n_pairs").distinct()


def over_merge(forms: DataFrame, rare_tokens: DataFrame, cluster: str = "cluster_id", form: str = "form", canonical: str = "canonical", pairs: int = PAIRS) -> DataFrame:
    """cluster, form_a, form_b, severity, reasons: forms of a cluster that name different people, or
    that nothing distinctive ties together; grounds against outweigh weak ties and come first. A form that shares with the
    canonical name its nisba alone, or nothing, is refuted too. The rare tokens meet the forms by a join on the token.

    No side of a join is broadcast, so the driver holds none. Parses are saved, and so is what is found, before it is put in order.

    In clusters of at most `pairs` forms all pairs are judged. In others those pairs are that disagreements() names, and each
    form with the canonical name's own, so what is judged grows with the forms and not with their square."""
    ready = saved(_parsed(forms, rare_tokens, cluster, form, canonical))
    sizes = ready.groupBy(cluster).agg(F.count("*").alias("__n"))
    lone = ready.select(cluster, F.col(canonical).alias("form_a"), F.col(form).alias("form_b"), N.nisba_only_link(F.col("p"), F.col("c")).alias("why")).where("why IS NOT NULL AND form_a <> form_b")
    few = ready.join(sizes.where(F.col("__n") <= pairs).select(cluster).hint("merge"), cluster, "left_semi")
    a, b = few.alias("a"), few.alias("b")
    small = a.join(b.hint("merge"), (F.col(f"a.{cluster}") == F.col(f"b.{cluster}")) & (F.col(f"a.{form}") < F.col(f"b.{form}")))
    many = ready.join(sizes.where(F.col("__n") > pairs).select(cluster).hint("merge"), cluster, "left_semi")
    named = _groups(many, cluster, form).select(cluster, F.least("a", "b").alias("__a"), F.greatest("a", "b").alias("__b")).distinct()
    own = many.where(F.col(form) != F.col(canonical)).select(cluster, F.least(form, canonical).alias("__a"), F.greatest(form, canonical).alias("__b"))
    asked = named.unionByName(own).distinct().alias("q")
    x, y = many.alias("a"), many.alias("b")
    large = asked.join(x.hint("merge"), (F.col(f"q.{cluster}") == F.col(f"a.{cluster}")) & (F.col("q.__a") == F.col(f"a.{form}"))).join(y.hint("merge"), (F.col(f"q.{cluster}") == F.col(f"b.{cluster}")) & (F.col("q.__b") == F.col(f"b.{form}")))
    found = _judged(small, cluster, form).unionByName(_judged(large, cluster, form))
    against = lone.select(cluster, "form_a", "form_b", F.lit("refute").alias("severity"), F.array("why").alias("reasons"))
    return saved(found.unionByName(against)).orderBy(F.col("severity") != "refute", cluster, "form_a", "form_b")


def totals(**worklists: DataFrame) -> DataFrame:
    out = None
    for name, df in worklists.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("worklist"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def unsettled(worklist: DataFrame, merges: DataFrame, on: str) -> DataFrame:
    """A worklist without what named merges (column norm) have settled."""
    return worklist.join(merges.select(F.col("norm").alias(on)), on, "left_anti")
