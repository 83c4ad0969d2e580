"""Word lexicons learned from aligned columns, and values composed from them."""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import textnorm as X

#: Words that never end a construct, and openings of particles joined to their host. Fixed values.
NO_SECOND_TERM = ("fī", "min", "ʿan", "ʿalā", "ilā", "maʿa", "bayna", "allatī", "allaḏī", "hiya", "huwa", "mā", "lā", "kāna", "yakūn", "ʾan", "in")
PARTICLES = "^(?:wa-|bi-|li-|la-)"


def aligned(rows: DataFrame, left: Column, right: Column, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """pos, l, r: words of two arrays place by place, where both have as many. There is no filter on them, for below one either would be worked out anew."""
    both = F.arrays_zip(F.col("__l").alias("l"), F.col("__r").alias("r"))
    return rows.select(*keep, left.alias("__l"), right.alias("__r")).select(*keep, F.posexplode(F.when(F.size("__l") == F.size("__r"), both)).alias("pos", "__p")).select(*keep, "pos", "__p.l", "__p.r")


def readings(pairs: DataFrame) -> DataFrame:
    """key, readings (distinct, ascending), contested: more than one apart from the -at / -ah state. Pairs are made distinct before
    any are gathered, so what is sorted grows with the words and not with their occurrences."""
    found = pairs.select(F.col("l").alias("key"), "r").distinct().groupBy("key").agg(F.array_sort(F.collect_list("r")).alias("readings"))
    return found.withColumn("contested", F.size(F.array_distinct(F.transform("readings", X.state_free))) > 1)


def first_reading(pairs: DataFrame, order: list[str]) -> DataFrame:
    """key, reading: the first writer wins, contests are ignored."""
    return pairs.groupBy(F.col("l").alias("key")).agg(F.min_by("r", F.struct(*order)).alias("reading"))


def lexicon(found: DataFrame, decisions: DataFrame | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """key, reading, from readings(), decisions (key, reading, varies) and overrides (key, reading).

    A decision wins over what the corpus shows, but a contested key has no reading even if decided;
    an override is forced in; a key that varies never has one.
    """
    learned = found.where("NOT contested").select("key", X.state_free(F.get("readings", F.lit(0))).alias("learned"))
    out = learned.select("key", F.col("learned").alias("reading"))
    if decisions is not None:
        settled = decisions.where("NOT coalesce(varies, false) AND coalesce(trim(reading), '') <> ''").groupBy("key").agg(F.max(F.trim("reading")).alias("decided"))
        free = settled.join(found.where("contested").select("key"), "key", "left_anti")
        out = learned.join(free, "key", "full_outer").select("key", F.coalesce("decided", "learned").alias("reading"))
    if overrides is not None:
        out = out.join(overrides.withColumnRenamed("reading", "forced"), "key", "full_outer").select("key", F.coalesce("forced", "reading").alias("reading"))
    if decisions is not None:
        out = out.join(decisions.where("varies").select("key").distinct(), "key", "left_anti")
    return out


def states(found: DataFrame, decisions: DataFrame, decontest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys that are still contested, and contested ones ruled to vary with their context."""
    contested, varies = found.where("contested").select("key"), decisions.where("varies").select("key").distinct()
    return contested.join(decontest, "key", "left_anti").join(varies, "key", "left_anti"), contested.join(varies, "key", "left_semi")


def construct(parts: Column, words: Column) -> Column:
    """Readings with -at for -ah where a word heads a noun that follows: it has no article, and the
    next has letters, a reading, and is no particle. A rewritten reading is of its own place only."""

    def one(t: Column, i: Column) -> Column:
        after, word = F.get(parts, i + 1), F.get(words, i + 1)
        heads = ~F.get(words, i).startswith("ال") & after.isNotNull() & (after != "") & word.isNotNull() & ~F.lower(after).isin(*NO_SECOND_TERM) & ~F.lower(after).rlike(PARTICLES) & word.rlike(r"[ء-ي]")
        return F.when(t.endswith("ah") & F.coalesce(heads, F.lit(False)), F.concat(F.substr(t, F.lit(1), F.length(t) - 2), F.lit("at"))).otherwise(t)

    return F.transform(parts, one)


_PARTICLES, _ARABIC = re.compile(PARTICLES), re.compile("[ء-ي]")


def constructed(parts: list[str], words: list[str | None]) -> list[str]:
    """construct() of one title in Python; no part is null or empty."""
    out = list(parts)
    for i, (t, after) in enumerate(zip(parts, parts[1:])):
        if t.endswith("ah") and i + 1 < len(words) and words[i] is not None and words[i + 1] is not None:
            low = after.lower()
            if not words[i].startswith("ال") and low not in NO_SECOND_TERM and not _PARTICLES.match(low) and _ARABIC.search(words[i + 1]):
                out[i] = t[:-2] + "at"
    return out


def compose(rows: DataFrame, words: Column, lex: DataFrame, contested: DataFrame, varies: DataFrame, key: str = "id", construct_state: bool = True) -> DataFrame:
    """key, status and value for rows to fill (a title, none of `done`): composed where every word has
    a reading, else blocked by a word that varies, a contested one, or an unknown one."""
    exploded = rows.select(F.col(key).alias("__id"), F.posexplode(words).alias("pos", "key"))  # a title's words, without the title
    marks = lex.select("key", "reading").join(contested.select("key").withColumn("c", F.lit(True)), "key", "full_outer").join(varies.select("key").withColumn("v", F.lit(True)), "key", "full_outer")
    looked = exploded.join(marks, "key", "left")
    per = looked.groupBy("__id").agg(F.array_sort(F.collect_list(F.struct("pos", "reading", "key"))).alias("p"), F.max(F.coalesce("v", F.lit(False))).alias("v"), F.max(F.col("reading").isNull()).alias("m"), F.max(F.col("reading").isNull() & F.coalesce("c", F.lit(False))).alias("c"))
    parts = F.transform("p", lambda x: x["reading"])
    value = F.array_join(construct(parts, F.transform("p", lambda x: x["key"])) if construct_state else parts, " ")
    status = F.when(F.col("v"), "varies").when(F.col("c"), "contested").when(F.col("m"), "unknown").otherwise("composed")
    return per.select(F.col("__id").alias(key), status.alias("status"), F.when(status == "composed", value).alias("value"))


def unlocks(titles: DataFrame, words: Column, known: DataFrame, key: str = "id") -> DataFrame:
    """word, titles (that hold it), unlocks (of which it is the only unknown word), for unknown words,
    most frequent first in `(-titles, word)` order left to the caller."""
    each = titles.select(key, F.explode(F.array_distinct(words)).alias("word")).join(known.select("word"), "word", "left_anti")
    per = each.groupBy(key).agg(F.collect_list("word").alias("ws"))  # a title's own words
    counted = per.select(F.explode("ws").alias("word"), (F.size("ws") == 1).cast("long").alias("alone"))
    return counted.groupBy("word").agg(F.count("*").alias("titles"), F.sum("alone").alias("unlocks"))


def known_sample(lex: DataFrame, k: int = 40) -> DataFrame:
    """The first k keys of a lexicon, in order."""
    return lex.orderBy("key").limit(k)


def app_lexicon(rows: DataFrame, names: DataFrame) -> DataFrame:
    """key, reading of an editor's own suggestions: titles and transliterations (id, title, title_translit), then
    cluster names (cluster_id, canonical_ar, canonical_translit), word by word where both have as many; the first
    writer wins. Keys keep their letters and lose their marks only."""
    def pairs(df: DataFrame, key: str, ar: str, latin: str, first: int) -> DataFrame:
        words = F.filter(F.transform(X.tokens(X.squeeze(F.coalesce(ar, F.lit("")))), X.app_key), lambda w: w != "")
        own = aligned(df.withColumn("__id", F.col(key).cast("string")), words, X.tokens(X.squeeze(F.coalesce(latin, F.lit("")))), ("__id",))
        return own.withColumn("__first", F.lit(first))

    both = pairs(rows, "id", "title", "title_translit", 0).unionByName(pairs(names, "cluster_id", "canonical_ar", "canonical_translit", 1))
    return first_reading(both, ["__first", "__id", "pos"])


def suggestions(rows: DataFrame, lex: DataFrame, field: str = "title_translit", source: str = "title") -> DataFrame:
    """id, field and proposal for rows whose every word has a reading; none for a field that isn't a transliteration,
    nor where a word is unknown: half a suggestion would be accepted by reflex."""
    if not field.endswith("_translit"):
        rows = rows.limit(0)
    words = F.filter(F.transform(X.tokens(X.squeeze(F.coalesce(source, F.lit("")))), X.app_key), lambda w: w != "")
    each = rows.select("id", F.posexplode(words).alias("pos", "key")).join(lex.select("key", "reading"), "key", "left")
    found = each.groupBy("id").agg(F.max(F.col("reading").isNull()).alias("open"), F.array_sort(F.collect_list(F.struct("pos", "reading"))).alias("p")).where("NOT open")
    return found.select("id", F.lit(field).alias("field"), F.array_join(F.transform("p", lambda x: x["reading"]), " ").alias("proposal"))


def looked_up(words: Column, lex: Column) -> Column:
    """Each word's value in a map of the row's own, null for none. A map of Spark is searched from its begin for each word, which takes too long
    for long texts; so Python looks them up."""

    @F.pandas_udf("array<string>")
    def found(words: pd.Series, lex: pd.Series) -> pd.Series:
        return pd.Series([None if ws is None else list(map(dict(() if own is None else own).get, ws)) for ws, own in zip(words, lex, strict=True)], dtype=object)

    return found(words, lex)


def gloss(words: Column, lex: Column) -> Column:
    """Each word's value in a map, or an ellipsis."""
    return F.array_join(looked_up(words, lex), " ", "…")


def classify(value: Column, proposal: Column) -> Column:
    """How a value relates to what was proposed for it."""
    return F.when(F.coalesce(proposal, F.lit("")) == "", "independent").when(value == proposal, "accepted").otherwise("overridden")


def provenance(rows: DataFrame, value: str, proposal: str) -> DataFrame:
    """verdict, n and percent of the rows that have a value."""
    filled = rows.where(F.coalesce(F.col(value), F.lit("")) != "").select(classify(F.col(value), F.col(proposal)).alias("verdict"))
    counted = filled.groupBy("verdict").agg(F.count("*").alias("n"))
    return counted.withColumn("percent", F.bround(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))), 3))  # three rows


def combinations(readings_per_key: Column) -> Column:
    """Every way to take one of each array's values, joined by spaces; null parts make it null."""
    return F.aggregate(readings_per_key, F.array(F.lit("")), lambda done, options: F.flatten(F.transform(done, lambda d: F.transform(options, lambda o: F.trim(F.concat(d, F.lit(" "), o))))))


def best_choices(options: Column, k: int) -> Column:
    """array<struct<weight, values>>: the k best ways to take one of each array's options (struct<value, weight>), the greatest
    sum of weights first, then by the values. One array after the other is added and the best k so far are kept,
    which is exact, because what comes later adds the same to each; so memory is bounded by k and one array, however many ways there are. The
    i-th best way so far needs an array's best k / i options only, for those before in both are no worse. In Python, for Spark interprets sorts of nested arrays."""

    @F.arrow_udf("array<struct<weight:bigint,values:array<string>>>")
    def best(options: pa.Array) -> pa.Array:
        inner = options.flatten()
        value, weight = (column.to_pylist() for column in inner.flatten().flatten())
        weight = [None if w is None else -w for w in weight]
        # nulls come first, as in Spark
        order = (lambda x: (x[0] is not None, x[0] or 0, [(v is not None, v or "") for v in x[1]])) if None in value or None in weight else None
        pairs = zip(weight, zip(value), strict=True)
        lists = [None if n is None else sorted(islice(pairs, n), key=order) for n in inner.value_lengths().to_pylist()]
        lists, out = iter(lists), []
        for n in options.value_lengths().to_pylist():
            own = None if n is None else list(islice(lists, n))
            out.append(None if own is None or None in own else _best(own, k, order))
        every = [x for done in out if done is not None for x in done]
        made = pa.StructArray.from_arrays([pa.array([None if c is None else -c for c, _ in every], pa.int64()), pa.array([v for _, v in every], pa.list_(pa.string()))], names=["weight", "values"])
        ends = pa.array(np.cumsum([0] + [len(done or ()) for done in out]), pa.int32())
        return pa.ListArray.from_arrays(ends, made, mask=pa.array([done is None for done in out], pa.bool_()))

    return best(options)


def _best(lists: list[list[tuple]], k: int, order: Callable | None) -> list[tuple]:
    """The k least sums of costs, and then values, of one of each list's (cost, values), which are sorted."""
    done = [(0, ())]
    for more in lists:
        plus = [(None if c is None or d is None else c + d, v + x) for i, (c, v) in enumerate(done, 1) for d, x in more[: k // i]]
        done = sorted(plus, key=order)[:k]
    return done


def n_choices(options: Column) -> Column:
    """How many ways there are, as a decimal of 38 digits; null beyond."""
    size = lambda o: F.size(o).cast("decimal(38,0)")
    return F.aggregate(options, F.lit(1).cast("decimal(38,0)"), lambda n, o: F.try_multiply(n, size(o)).cast("decimal(38,0)"))


def merge_suggestions(prior: DataFrame, new: DataFrame) -> DataFrame:
    """id, field, proposal: what was proposed before and now, the new for the same id and field. A harvest that is done again
    changes nothing."""
    both = prior.select("id", "field", "proposal", F.lit(1).alias("__p")).unionByName(new.select("id", "field", "proposal", F.lit(0).alias("__p")))
    return both.groupBy("id", "field").agg(F.min_by("proposal", F.struct("__p", "proposal")).alias("proposal"))


def live_suggestions(suggestions: DataFrame, rows: DataFrame) -> DataFrame:
    """Those whose row still has a value in the field: without one there is nothing to compare a proposal with.
    Fields that the rows lack are blank."""
    fields = [c for c, kind in rows.dtypes if kind == "string" and c != "id"]
    filled = F.array_compact(F.array(*(F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.lit(c)) for c in fields)))
    own = rows.select("id", filled.alias("__fields"))
    return suggestions.join(own, "id").where(F.array_contains("__fields", F.col("field"))).drop("__fields")


def suggestion_entries(doc: DataFrame, field: str = "machine_suggestions") -> DataFrame:
    """id, field, proposal of a document's nested maps."""
    each = doc.select(F.explode(field).alias("id", "__v"))
    return each.select("id", F.explode("__v").alias("field", "proposal"))


def suggestion_maps(suggestions: DataFrame) -> DataFrame:
    """id and a map field -> proposal, as a document holds them."""
    return suggestions.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "proposal")))).alias("values"))  # a row's own fields


def record_suggestions(shown: DataFrame, rows: DataFrame, field: str = "title_translit") -> DataFrame:
    """id, field, proposal for what was shown for that row and field and whose field now has a value."""
    own = rows.where(F.trim(F.coalesce(F.col(field), F.lit(""))) != "").select("id")
    return shown.where(F.col("field") == field).join(own, "id", "left_semi").select("id", "field", "proposal")
