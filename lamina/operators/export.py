"""What annotators answered, as decisions: one record for each card, whatever its state.

An answer has the fingerprint of the card it was made on (fp). It is stale if the card has another one now; it then
counts for nothing, and the card is exported as open, marked as stale. A card is ready when all that
it asks is answered, and done when the answer is confirmed, ready and not put off. Answers of schema version 1
have no fingerprint and are taken to be of the card as it is; there a title written by hand stood where
the disposition does.

answers: id, fp, confirmed, deferred, note and what is asked by stratum: form (accept, keep, custom), form_text and translit
for ortho; verdict (fix, keep, custom) and reading for witness; disposition (strip, keep, custom), title and
title_translit for attribution; readings (a map from key to reading) for homograph. Columns that are missing are null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import textnorm as X

ANSWERS = {
    "fp": "string", "confirmed": "boolean", "deferred": "boolean", "note": "string", "form": "string", "form_text": "string", "translit": "string", "verdict": "string",
    "reading": "string", "disposition": "string", "title": "string", "title_translit": "string", "readings": "map<string,string>",
}
DISPOSITIONS = ("strip", "keep", "custom")
#: A decision's fields after its id, stratum and state.
VALUES = {
    "word": "string", "target": "string", "translit": "string", "translit_source": "string", "confidence": "string", "row_scoped": "boolean", "n_titles": "bigint", "row": "string", "action": "string",
    "was": "string", "tail": "string", "tail_translit": "string", "target_translit": "string", "aligned": "boolean", "readings": "map<string,string>",
}


def _filled(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def migrated(answers: DataFrame, cards: DataFrame) -> DataFrame:
    """Answers of either schema version as those of version 2. cards: id, fp."""
    has = {f.name: f.dataType for f in answers.schema.fields}
    full = answers.select("id", *(F.col(c).cast(kind).alias(c) if c in has and not isinstance(has[c], T.NullType) else F.lit(None).cast(kind).alias(c) for c, kind in ANSWERS.items()))
    by_hand = F.col("disposition").isNotNull() & ~F.col("disposition").isin(*DISPOSITIONS)
    full = full.withColumns({"title": F.when(by_hand, F.col("disposition")).otherwise(F.col("title")), "disposition": F.when(by_hand, "custom").otherwise(F.col("disposition"))})
    return full.join(cards.select("id", F.col("fp").alias("__fp")), "id").withColumn("fp", F.coalesce("fp", "__fp")).drop("__fp")


def _ortho(a: dict[str, Column]) -> tuple[Column, dict[str, Column]]:
    offered, given, typed = F.col("translit"), _filled(a["translit"]), _filled(a["form_text"])
    translit, asks = F.coalesce(given, offered), F.col("n_titles") > 0  # a card without titles has no romanization to give
    accept, custom = (a["form"] == "accept") & F.col("proposed").isNotNull(), (a["form"] == "custom") & typed.isNotNull()
    changes = accept | custom
    ready = (a["form"] == "keep") | (changes & (~asks | translit.isNotNull()))
    target = F.when(a["form"] == "keep", F.col("word")).when(accept, F.col("proposed")).when(custom, typed)
    source = F.when(given.isNull(), "default").when(F.array_contains("translits", given), "chosen").otherwise("typed")
    shown = changes & translit.isNotNull() & asks
    return ready, {
        "word": F.col("word"), "target": target, "translit": F.when(shown, translit), "translit_source": F.when(shown, source), "confidence": F.col("confidence"),
        "row_scoped": F.col("row_scoped"), "n_titles": F.col("n_titles"),
    }


def _witness(a: dict[str, Column]) -> tuple[Column, dict[str, Column]]:
    typed = _filled(a["reading"])
    target = F.when(a["verdict"] == "fix", F.col("proposed")).when(a["verdict"] == "keep", F.col("current")).when(a["verdict"] == "custom", typed)
    return target.isNotNull(), {"row": F.col("row"), "word": F.col("word"), "was": F.col("current"), "target": target, "action": F.when(target.isNotNull(), F.when(a["verdict"] == "keep", "keep").otherwise("fix"))}


def _attribution(a: dict[str, Column]) -> tuple[Column, dict[str, Column]]:
    kind, title, translit = a["disposition"], _filled(a["title"]), _filled(a["title_translit"])
    needs = F.coalesce("title_translit", F.lit("")) != ""  # a row that has a transliteration needs one for its new title
    custom = (kind == "custom") & title.isNotNull()
    ready = kind.isin("strip", "keep") | (custom & (~needs | translit.isNotNull()))
    target = F.when(kind == "strip", F.col("proposed_title")).when(kind == "keep", F.col("title")).when(custom, title)
    return ready, {
        "row": F.col("row"), "was": F.col("title"), "tail": F.col("tail"), "tail_translit": F.col("tail_translit"), "aligned": F.col("aligned"), "target": target,
        "target_translit": F.when(kind == "strip", F.col("proposed_translit")).when(custom, translit),
        "action": F.when(kind == "strip", "strip_tail").when(kind == "keep", "keep").when(custom, "set_title"),
    }


def _homograph(a: dict[str, Column]) -> tuple[Column, dict[str, Column]]:
    chosen = F.coalesce(a["readings"], F.expr("cast(map() as map<string,string>)"))
    ready = F.forall("keys", lambda k: F.coalesce(_filled(F.try_element_at(chosen, k["key"])), F.lit("")) != "")
    return ready, {"row": F.col("id"), "readings": a["readings"]}


_STRATA = {"ortho": _ortho, "witness": _witness, "attribution": _attribution, "homograph": _homograph}


def _exported(cards: DataFrame, answers: DataFrame, stratum: str) -> DataFrame:
    mine = migrated(answers, cards)
    met = cards.join(mine.select("id", F.struct(*ANSWERS).alias("__a")), "id", "left")
    stale = F.coalesce(F.col("__a.fp") != F.col("fp"), F.lit(False))
    given = met.withColumn("stale", stale).withColumn("__a", F.when(~F.col("stale"), F.col("__a")))  # a stale answer counts for nothing
    yes = lambda c: F.coalesce(F.col(f"__a.{c}"), F.lit(False))
    ready, values = _STRATA[stratum]({c: F.col(f"__a.{c}") for c in ANSWERS})
    done = yes("confirmed") & ~yes("deferred") & F.coalesce(ready, F.lit(False))
    state = F.when(yes("deferred"), "deferred").when(done, "resolved").otherwise("open")
    out = {"disposition": state, "done": done, "note": F.coalesce("__a.note", F.lit(""))} | {c: values[c] if c in values else F.lit(None) for c in VALUES}
    kinds = VALUES | {"disposition": "string", "done": "boolean", "note": "string"}
    return given.select("id", F.lit(stratum).alias("stratum"), "fp", "stale", F.coalesce(ready, F.lit(False)).alias("ready"), *(c.cast(kinds[name]).alias(name) for name, c in out.items()))


def decisions(strata: dict[str, DataFrame], answers: DataFrame) -> DataFrame:
    """A record for each card of the strata (with fp, as jobs.cards gives them): id, stratum, fp, disposition (open, resolved, deferred), done,
    ready, stale, note and the answer's values. Answers to cards that are gone are left out."""
    return reduce(DataFrame.unionByName, (_exported(cards, answers, stratum) for stratum, cards in strata.items() if stratum in _STRATA))


def word_decisions(worklist: DataFrame, answers: DataFrame) -> DataFrame:
    """word, translit, varies, decided for each word of a worklist: what is untouched is explicitly undecided. answers: word, translit,
    varies. A transliteration in Arabic letters is refused, with all of its answer; that a word varies
    decides it without one."""
    own = answers.select("word", F.trim(F.coalesce("translit", F.lit(""))).alias("__t"), F.coalesce("varies", F.lit(False)).alias("__v")).dropDuplicates(["word"])
    met = worklist.select("word").distinct().join(own, "word", "left")
    kept = F.coalesce(~X.typed_arabic(F.col("__t")), F.lit(False))
    decided = kept & ((F.col("__t") != "") | F.col("__v"))
    return met.select("word", F.when(decided, F.col("__t")).otherwise("").alias("translit"), (decided & F.col("__v")).alias("varies"), decided.alias("decided"))


def lexicon_entries(words: DataFrame) -> DataFrame:
    """key, reading, varies of exported words, as the lexicon and the composer take them; undecided ones are left out."""
    return words.where("decided").select(X.normalize_ar(F.col("word")).alias("key"), F.nullif("translit", F.lit("")).alias("reading"), "varies")


def counts(words: DataFrame) -> DataFrame:
    """words, decided, varies: the totals an export is headed by."""
    return words.agg(F.count("*").alias("words"), F.count_if("decided").alias("decided"), F.count_if("varies").alias("varies"))
