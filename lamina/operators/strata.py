"""The strata of cards: the fingerprint by which an answer knows its question, and one table of all cards.

A fingerprint covers what an answer depends on and nothing else. Prose, the rows around a card and lists of ids
are left out, so a card outlives a change of its surroundings; whether any title, author or cluster is concerned is
in, because it decides what is asked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(c: Column) -> Column:
    """The value as JSON; null as null."""
    whole = F.to_json(F.struct(c.cast("string").alias("v")), {"ignoreNullFields": "false"})
    return F.substr(whole, F.lit(6), F.length(whole) - 6)


def _flag(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), "true").otherwise("false")


def _some(c: Column) -> Column:
    return _flag(c > 0)


def _filled(c: Column) -> Column:
    return _flag(F.coalesce(c, F.lit("")) != "")


def _list(parts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))


def _sorted(c: Column) -> Column:
    return _list(F.transform(F.array_sort(F.coalesce(c, F.expr("cast(array() as array<string>)"))), _text))


def _options(keys: Column) -> Column:
    """Each key with its options' values, keys and values ascending."""
    plain = F.transform(keys, lambda k: F.struct(k["key"].alias("key"), F.array_sort(F.transform(k["options"], lambda o: o["value"])).alias("values")))
    return _list(F.transform(F.array_sort(plain), lambda k: _list(F.array(_text(k["key"]), _list(F.transform(k["values"], _text))))))


#: Fixed: the fields in a fingerprint and their order, for stored answers hold fingerprints.
FIELDS = {
    "ortho": (
        ("word", _text), ("proposed", _text), ("translit", _text), ("translits", _sorted), ("confidence", _text),
        ("key_changes", _flag), ("row_scoped", _flag), ("n_titles", _some), ("n_authors", _some), ("n_clusters", _some),
    ),
    "witness": (("row", _text), ("word", _text), ("current", _text), ("proposed", _text)),
    "homograph": (("title", _text), ("keys", _options)),
    "attribution": (
        ("row", _text), ("marker", _text), ("title", _text), ("tail", _text), ("proposed_title", _text), ("proposed_translit", _text),
        ("aligned", _flag), ("title_translit", _filled),
    ),
}


def signature(stratum: str) -> Column:
    """What an answer to a card of the stratum depends on, as a JSON array."""
    return _list(F.array(_text(F.lit(stratum)), *(write(F.col(c)) for c, write in FIELDS[stratum])))


def fingerprinted(cards: DataFrame, stratum: str) -> DataFrame:
    """Adds fp, twelve hex digits; the cards have the columns of FIELDS."""
    return cards.withColumn("fp", F.left(F.sha2(signature(stratum), 256), F.lit(12)))


def view(strata: dict[str, DataFrame]) -> DataFrame:
    """stratum, id, fp and card (a VARIANT of all its columns) of the cards of all strata, however unlike."""
    one = lambda name, cards: cards.select(F.lit(name).alias("stratum"), "id", "fp", F.to_variant_object(F.struct(*cards.columns)).alias("card"))
    return reduce(DataFrame.unionByName, (one(name, cards) for name, cards in strata.items()))


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """stratum, id and change of two views: new, gone, asked anew (another fingerprint) or kept."""
    a, b = (v.select("stratum", "id", F.col("fp").alias(name)) for v, name in ((before, "__a"), (after, "__b")))
    change = F.when(F.col("__a").isNull(), "new").when(F.col("__b").isNull(), "gone").when(F.col("__a") != F.col("__b"), "asked anew").otherwise("kept")
    return a.join(b, ["stratum", "id"], "full_outer").select("stratum", "id", change.alias("change"))
