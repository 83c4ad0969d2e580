"""Name parsing and refutation, by patterns over folded names, so no Python runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.functions import textnorm as X
from lamina.functions.similarity import near

_PARTICLE, _CONNECTOR = "(?:ابو|ابي|ام)", "(?:بن|ابن)"
#: One name unit: particles, then a compound of two words or a single word.
_UNIT = rf"(?:{_PARTICLE} )*(?:عبد \S+|\S+)"


def parse(norm: Column) -> Column:
    """struct<norm, kunya, ism, head, chain, nisbahs, tokens, shuhrah> of a folded name."""
    norm = F.coalesce(norm, F.lit(""))
    some = lambda c: F.nullif(c, F.lit(""))
    kunya = some(F.regexp_extract(norm, rf"^({_PARTICLE}(?: {_UNIT})?)(?= |$)", 1))
    rest = F.ltrim(F.when(kunya.isNotNull(), F.substr(norm, F.length(kunya) + 1)).otherwise(norm))
    head = some(F.regexp_extract(rest, rf"^({_UNIT})", 1))
    ism = some(F.regexp_extract(rest, rf"^({_UNIT}) {_CONNECTOR}(?: |$)", 1))
    ism = F.when(ism == head, ism)
    chain = F.filter(F.regexp_extract_all(rest, F.lit(rf"(?<!\S){_CONNECTOR}(?: ({_UNIT}))?(?!\S)"), F.lit(1)), lambda x: x != "")
    tokens = X.tokens(norm)
    return F.struct(
        norm.alias("norm"), kunya.alias("kunya"), ism.alias("ism"), head.alias("head"), chain.alias("chain"),
        F.filter(tokens, lambda t: t.startswith("ال") & t.endswith("ي")).alias("nisbahs"), tokens.alias("tokens"),
        norm.rlike(rf"^{_CONNECTOR}(?: |$)").alias("shuhrah"),
    )


def key(element: Column) -> Column:
    """Article-free; null for none."""
    return F.nullif(F.array_join(F.transform(X.tokens(element), X.strip_article), " "), F.lit(""))


def folded(name: Column) -> Column:
    return F.array_distinct(F.transform(X.tokens(X.fold_orthography(name["norm"])), X.strip_article))


# The openings of the reasons below are fixed values: worklists are compared by them.
def refute(a: Column, b: Column) -> Column:
    """array<string>: the grounds on which two parsed names are of different people; empty if none."""
    other_ism = F.when(key(a["ism"]) != key(b["ism"]), F.concat_ws(" ", F.lit("different ism:"), a["ism"], F.lit("vs"), b["ism"]))

    def fathers(x: Column, y: Column) -> Column:
        own = key(F.nullif(F.regexp_extract(x["kunya"], r"^\S+ (.+)$", 1), F.lit("")))
        name = F.coalesce(y["ism"], y["head"])
        return F.when(own == key(name), F.concat_ws(" ", F.lit("kunya names the other form:"), x["kunya"], F.lit("is the father of"), name))

    a0, b0 = F.get(a["chain"], F.lit(0)), F.get(b["chain"], F.lit(0))
    inverted = F.when((key(a["ism"]) == key(b0)) & (key(b["ism"]) == key(a0)), F.concat_ws(" ", F.lit("inverted nasab:"), a["ism"], F.lit("b."), a0, F.lit("vs"), b["ism"], F.lit("b."), b0))
    shared = F.least(F.size(a["chain"]), F.size(b["chain"]))
    pairs = F.transform(F.arrays_zip(F.slice(a["chain"], F.lit(1), shared).alias("x"), F.slice(b["chain"], F.lit(1), shared).alias("y")), lambda p, i: F.struct(p["x"].alias("x"), p["y"].alias("y"), i.alias("i")))
    wrong = F.get(F.filter(pairs, lambda p: (key(p["x"]) != key(p["y"])) & ~near(key(p["x"]), key(p["y"]))), F.lit(0))
    lineage = F.when(~a["shuhrah"] & ~b["shuhrah"] & wrong.isNotNull(), F.concat_ws(" ", F.concat(F.lit("nasab differs at position "), (wrong["i"] + 1).cast("string"), F.lit(":")), wrong["x"], F.lit("vs"), wrong["y"]))
    return F.array_compact(F.array(other_ism, fathers(a, b), fathers(b, a), inverted, lineage))


def weak_link(a: Column, b: Column, rare: Column) -> Column:
    """Why two names of a cluster rest on common words alone, else null. rare: array of rare tokens."""
    x, y = folded(a), folded(b)
    nested = (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)
    shared = F.array_sort(F.array_intersect(x, y))
    why = F.concat(F.lit("no distinctive token in common"), F.when(F.size(shared) > 0, F.concat(F.lit(" (shared only: "), F.array_join(shared, ", "), F.lit(")"))).otherwise(""))
    return F.when(~nested & ~F.arrays_overlap(shared, rare), why)


def nisba_only_link(form: Column, canonical: Column) -> Column:
    shared = F.array_sort(F.array_intersect(folded(form), folded(canonical)))
    own = form["ism"].isNotNull() | (F.size(form["chain"]) > 0)
    return F.when(own & (F.size(shared) == 0), "shares nothing with the canonical name").when(own & F.forall(shared, lambda t: t.endswith("ي")), F.concat(F.lit("linked by nisba alone ("), F.array_join(shared, ", "), F.lit(")")))
