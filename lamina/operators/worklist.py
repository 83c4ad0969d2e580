"""Cards for human decisions: derived proposals, fingerprints, suppression, staleness."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions import textnorm as X
from lamina.operators.graph import saved

# The letters that consonants stand for, the proclitics of a romanization, and what
# tells a joining alif from a carrier.
CONSONANTS = {
    "b": "ب", "t": "ت", "ṯ": "ث", "ǧ": "ج", "ḥ": "ح", "ḫ": "خ", "d": "د", "ḏ": "ذ", "r": "ر", "z": "ز", "s": "س", "š": "ش", "ṣ": "ص", "ḍ": "ض",
    "ṭ": "ط", "ẓ": "ظ", "ʿ": "ع", "ġ": "غ", "f": "ف", "q": "ق", "k": "ك", "l": "ل", "m": "م", "n": "ن", "h": "ه", "w": "و", "y": "ي",
}
SHADDA = "ّ"
PROCLITICS = ("wa-l-", "li-l-", "bi-l-", "wa-", "al-", "li-", "bi-", "la-")
JOINING_WORDS = ("ابن", "ابنة", "اسم", "امرؤ", "امرأة", "اثنان", "اثنين", "الله", "اللهم")
JOINING_OPENINGS = ("ست", "صط", "ضط", "طط", "ظط", "زد", "دد", "ذذ", "ثث", "ن")
CARRIERS = "أإآٱ"


def geminated(translit: Column) -> Column:
    """The consonants that a romanization doubles: the semivowels of īy, iyy, ayy and uww, then any
    consonant that stands twice, each once, in order."""
    low = F.lower(translit)
    vowels = F.transform(F.regexp_extract_all(low, F.lit("īy|uww|iyy|ayy"), F.lit(0)), lambda x: F.substr(x, F.lit(-1)))
    twice = F.regexp_extract_all(low, F.lit(f"([{''.join(CONSONANTS)}])\\1"), F.lit(1))
    return F.array_distinct(F.concat(vowels, twice))


def _article(word: Column) -> Column:
    """Letters of the article that opens the word; a word of three letters has none."""
    return F.when(word.startswith("ال") & (F.length(word) > 3), 2).otherwise(0)


def place_shadda(word: Column, letter: Column) -> Column:
    """The word with a doubling mark on the letter, where it stands once after the article, or once in
    the word if not after it; null where that is open. The ya before a final ta marbuta takes it
    first, however many others there are."""
    head, body = F.substr(word, F.lit(1), _article(word)), F.substr(word, _article(word) + 1)
    times = lambda s: F.length(s) - F.length(F.replace(s, letter, F.lit("")))
    marked = lambda s: F.replace(s, letter, F.concat(letter, F.lit(SHADDA)))
    relative = F.concat(F.substr(word, F.lit(1), F.length(word) - 1), F.lit(SHADDA + "ة"))
    return F.when((letter == "ي") & word.endswith("ية"), relative).when(times(body) == 1, F.concat(head, marked(body))).when((times(body) == 0) & (times(word) == 1), marked(word))


def without_proclitic(translit: Column) -> Column:
    """In lower case, past the longest proclitic."""
    return F.regexp_replace(F.lower(translit), f"^(?:{'|'.join(PROCLITICS)})", "")


def initial_vowel(translit: Column) -> Column:
    """The first letter past the longest proclitic, lower-cased; null for none."""
    return F.nullif(F.substr(without_proclitic(translit), F.lit(1), F.lit(1)), F.lit(""))


def stem(word: Column) -> Column:
    return F.substr(word, _article(word) + 1)


def hamza_verdict(word: Column, translits: Column) -> Column:
    """The carrier of a bare opening alif by the vowels of its romanizations, `wasl` for a joining one, `?`
    where they disagree or say nothing; null for a word that opens otherwise.

    A long a is an alif with a madda; a and u never join. With an i it joins if the stem opens as forms VII, VIII
    and X do. An infixed t after the first root letter alone doesn't tell form VIII from IV: the first
    has a second i.
    """
    own = stem(word)
    vowels = F.transform(translits, initial_vowel)
    only = lambda *vs: (F.size(translits) > 0) & F.forall(vowels, lambda v: F.coalesce(v.isin(*vs), F.lit(False)))
    infix = own.rlike("^ا.ت")
    second = F.exists(translits, lambda t: without_proclitic(t).rlike("^i[^i]*i"))
    opening = own.rlike(f"^ا(?:{'|'.join(JOINING_OPENINGS)})")
    by_i = F.when(infix & second, "wasl").when(opening & ~infix, "wasl").otherwise("إ")
    return F.when(own.startswith("ا"), F.when(own.isin(*JOINING_WORDS), "wasl").when(only("ā"), "آ").when(only("a", "u"), "أ").when(only("i", "ī"), by_i).otherwise("?"))


def carry_hamza(word: Column, carrier: Column) -> Column:
    """The word with the carrier for the alif that opens it, after the article if it has one."""
    return F.overlay(word, carrier, _article(word) + 1, F.lit(1))


def fingerprint(*fields: Column) -> Column:
    """Twelve hex digits that change with any field of a card."""
    return F.substr(F.sha2(F.to_json(F.struct(*(f.alias(f"f{i}") for i, f in enumerate(fields))), {"ignoreNullFields": "false"}), 256), F.lit(1), F.lit(12))


def still_faulty(text: Column, word: Column, proposed: Column) -> Column:
    """A token reads `word` mark-blind and isn't what is proposed, or nothing is proposed."""
    return F.exists(X.words(text), lambda t: (X.bare(t) == word) & (proposed.isNull() | (t != proposed)))


def pending(cards: DataFrame, keeps: DataFrame) -> DataFrame:
    """Cards that no keep rules out."""
    return cards.join(keeps.select("id"), "id", "left_anti")


def merge_keeps(prior: DataFrame, new: DataFrame) -> DataFrame:
    """By id, the new keep before the prior one."""
    both = prior.withColumn("__p", F.lit(1)).unionByName(new.withColumn("__p", F.lit(0)))
    rest = [c for c in prior.columns if c != "id"]
    return both.groupBy("id").agg(F.min_by(F.struct(*rest), "__p").alias("k")).select("id", "k.*")


def export(cards: DataFrame, answers: DataFrame) -> DataFrame:
    """Every card: its answer if made of the same fingerprint, else open; stale tells of one that isn't."""
    a = answers.select("id", F.col("fp").alias("__fp"), F.col("disposition").alias("__d"), F.col("answer"))
    joined = cards.join(a, "id", "left")
    fresh = F.coalesce(F.col("fp") == F.col("__fp"), F.lit(False))
    return joined.select(*cards.columns, F.when(fresh, F.col("__d")).otherwise("open").alias("disposition"), F.when(fresh, F.col("answer")).alias("answer"), (F.col("__fp").isNotNull() & ~fresh).alias("stale"))


def homographs(titles: DataFrame, words: Column, found: DataFrame, key: str = "id") -> DataFrame:
    """id, word, options for each contested word of the titles to fill."""
    return titles.select(key, F.explode(F.array_distinct(words)).alias("key")).join(found.where("contested").select("key", F.col("readings").alias("options")), "key")


#: So many ways to read a title are composed beforehand, those with the most witnesses first.
COMPOSED = 64


def homograph_items(rows: DataFrame, pairs: DataFrame, lex: DataFrame, contested: DataFrame, k: int = COMPOSED) -> DataFrame:
    """id, title, keys, words, settled, n_compositions and compositions of each row without a transliteration whose title
    holds contested words.

    keys: array<struct<key, raw (the spelling in this title), options: array<struct<value, n_witnesses,
    witnesses (the first three rows that read it so)>>>>, in order of the words. words and settled: the title's keys and
    the reading of each that has one. Together these are a lattice of the title's readings. n_compositions: how
    many ways there are to read it. compositions: the title for each choice of readings (joined by |), null where another
    word is open: all of them, or the k whose readings have the most witnesses in sum. Any other is composed
    when it is asked for, by composed(). pairs: id, l, r of aligned words, or l, r, n, ids of witnessed().
    """
    from lamina.operators.lexicon import best_choices, n_choices
    from lamina.operators.resolve import first_k

    open_ = contested.select("key")
    title = F.coalesce("title", F.lit(""))
    todo = rows.where((F.trim(title) != "") & (F.trim(F.coalesce("title_translit", F.lit(""))) == "")).select("id", "title", X.words(title).alias("raws"), X.word_keys(title).alias("w"))
    each = todo.select("id", F.posexplode(F.arrays_zip("raws", "w")).alias("pos", "x")).select("id", "pos", F.col("x.raws").alias("raw"), F.col("x.w").alias("key"))
    if "ids" in pairs.columns:
        some = pairs.join(open_.select(F.col("key").alias("l")), "l", "left_semi")
        shown = some.groupBy("l", "r").agg(F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, NAMED).alias("ids"))
    else:
        seen = pairs.select(F.concat_ws("|", "l", "r").alias("reading"), "l", "r", "id").distinct()
        shown = first_k(seen, "reading", "id", NAMED, "id").join(seen.select("reading", "l", "r").distinct(), "reading").withColumn("n", (F.size("ids") + F.col("more")).cast("long"))
    options = shown.groupBy(F.col("l").alias("key")).agg(F.array_sort(F.collect_list(F.struct(F.col("r").alias("value"), F.col("n").alias("n_witnesses"), F.col("ids").alias("witnesses")))).alias("options"))
    hits = each.join(open_, "key").groupBy("id", "key").agg(F.min(F.struct("pos", "raw")).alias("at")).join(options, "key")
    keys = hits.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(F.col("at.pos").alias("pos"), "key", X.bare(F.col("at.raw")).alias("raw"), "options"))).alias("keys"))
    settled = each.join(lex.select("key", "reading"), "key", "left").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "reading"))).alias("p"))
    cards = todo.join(keys, "id").join(settled, "id").withColumn("settled", F.transform("p", lambda x: x["reading"]))
    options = F.transform("keys", lambda k: F.transform(k["options"], lambda o: F.struct(o["value"].alias("value"), o["n_witnesses"].alias("weight"))))
    cards = cards.withColumns({"ways": best_choices(options, k), "n_ways": n_choices(options)})
    composed_ways = _composed(F.col("w"), F.col("settled"), F.transform("keys", lambda k: k["key"]), F.transform("ways", lambda c: c["values"]))
    compositions = F.map_from_entries(F.array_sort(F.zip_with("ways", composed_ways, lambda c, v: F.struct(F.array_join(c["values"], "|").alias("choice"), v.alias("value")))))
    shown_keys = F.transform("keys", lambda k: F.struct(k["key"].alias("key"), k["raw"].alias("raw"), k["options"].alias("options")))
    return cards.select("id", "title", shown_keys.alias("keys"), F.col("w").alias("words"), "settled", F.col("n_ways").alias("n_compositions"), compositions.alias("compositions"))


def _composed(words: Column, settled: Column, keys: Column, ways: Column) -> Column:
    """The title from settled readings and a value for each of some keys, for each of some ways to choose these; null where a word has
    neither. In Python, for a lambda of Spark works the whole array out anew at each word, so a title took time with the square of its words."""
    from lamina.operators.lexicon import constructed

    @F.pandas_udf("array<string>")
    def values(words: pd.Series, settled: pd.Series, keys: pd.Series, ways: pd.Series) -> pd.Series:
        out = []
        for own, given, asked, each in zip(words, settled, keys, ways, strict=True):
            if own is None or given is None or each is None:
                out.append(None if each is None else [None] * len(each))
                continue
            own, given = list(own), list(given)
            at = {w: i for i, w in reversed(list(enumerate(() if asked is None else asked)))}
            places = [(i, at[w]) for i, w in enumerate(own) if w is not None and w in at]
            left = {i for i, r in enumerate(given) if not r} - {i for i, _ in places}
            made: list[str | None] = []
            for way in each:
                parts = list(given)
                for i, k in () if left else places:
                    if way is not None and k < len(way) and way[k] is not None:
                        parts[i] = way[k]
                made.append(None if left or not all(parts) else " ".join(constructed(parts, own)))
            out.append(made)
        return pd.Series(out, dtype=object)

    return values(words, settled, keys, ways)


def composed(cards: DataFrame, choices: DataFrame) -> DataFrame:
    """id, choice and value for the choices asked for (id and values, a reading for each of the card's keys in order), from the
    cards' lattices. Values that aren't among the options give null."""
    met = choices.select("id", F.col("values").alias("__v")).join(cards, "id")
    keyed = F.transform("keys", lambda k: k["key"])
    offered = (F.size("__v") == F.size("keys")) & F.forall(F.zip_with("keys", "__v", lambda k, v: F.exists(k["options"], lambda o: o["value"] == v)), lambda x: F.coalesce(x, F.lit(False)))
    return met.select("id", F.array_join("__v", "|").alias("choice"), F.when(offered, F.get(_composed(F.col("words"), F.col("settled"), keyed, F.array("__v")), F.lit(0))).alias("value"))


def digest(text: Column) -> Column:
    """32 bytes that stand for a text, null for null. Texts are taken to be equal if these are."""
    return F.unhex(F.sha2(text, 256))


def sharing(rows: DataFrame, text: str) -> DataFrame:
    """The rows whose text may be another's too: those whose hash is. Only hashes are counted, so texts of their own never meet."""
    hashed = rows.withColumn("__h", F.xxhash64(text))
    return hashed.join(hashed.groupBy("__h").agg(F.count("*").alias("__n")).where("__n > 1").select("__h"), "__h", "left_semi").drop("__h")


def _shared(norm: DataFrame, key: str) -> DataFrame:
    """key and collides_with, the others with the same norm, for rows (key, norm) that have some. norm: a digest, so that no text is shuffled."""
    from lamina.operators.audit import several

    some = sharing(norm, "norm")
    return some.join(several(some, ["norm"], key, "all"), "norm").select(key, F.array_remove("all", F.col(key)).alias("collides_with"))


def collisions(cards: DataFrame, proposed: Column, key: str = "id") -> DataFrame:
    """Cards whose proposals fold to one title, with the others' ids."""
    return _shared(saved(cards.select(F.col(key).alias("id"), digest(X.fold(proposed)).alias("norm"))), "id")


def preview(text: Column, word: Column, proposed: Column) -> Column:
    """For display only: the ingest replaces whole tokens."""
    return F.replace(text, word, proposed)


def witness_items(cards: DataFrame, rows: DataFrame, keeps: DataFrame, homographs: DataFrame | None = None) -> DataFrame:
    """cards (id, row, current, ...) whose current reading still stands in the row's transliteration and
    that no keep rules out; with homographs (id, key) and a column word also unblocks, how many rows wait for that word."""
    own = rows.select(F.col("id").alias("row"), X.tokens(F.coalesce("title_translit", F.lit(""))).alias("__t"))
    found = pending(cards.join(own, "row").where(F.array_contains("__t", F.col("current"))).drop("__t"), keeps)
    if homographs is None:
        return found
    waiting = homographs.groupBy("key").agg(F.count_distinct("id").alias("unblocks"))
    return found.withColumn("key", X.normalize_ar(F.col("word"))).join(waiting, "key", "left").withColumn("unblocks", F.coalesce("unblocks", F.lit(0)).cast("long")).drop("key")


def aligned_words(rows: DataFrame) -> DataFrame:
    """id, pos, l, r: words of a title and of its transliteration, place by place."""
    from lamina.operators.lexicon import aligned

    return aligned(rows, X.words(F.coalesce("title", F.lit(""))), X.tokens(F.coalesce("title_translit", F.lit(""))))


#: So many bytes of titles Python takes at a time, or one title.
AT_ONCE = 16 << 20


def _both(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(F.coalesce("title", F.lit("")).alias("title"), F.coalesce("title_translit", F.lit("")).alias("title_translit"), *keep)


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The parts between single spaces that aren't empty, and each one's row."""
    parts = pc.split_pattern(texts, " ")
    flat, row = parts.flatten(), np.repeat(np.arange(len(texts)), parts.value_lengths().to_numpy())
    some = pc.binary_length(flat).to_numpy() > 0
    return (flat, row) if some.all() else (flat.filter(pa.array(some)), row[some])


def _coded(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _titles_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """Some rows at a time, the words of their first column as X.words() has them, and each word's row."""
    other = "[^" + X.WORD.encode().decode("unicode_escape").strip("[]+") + "]"
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(0)).to_numpy())
        k = 0
        while k < batch.num_rows:
            n = max(1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + AT_ONCE, "right")) - k)
            part, k = batch.slice(k, n), k + n
            title = part.column(0)
            odd = pc.match_substring_regex(title, f"{other[:-1]} ]")
            if pc.any(odd).as_py():
                title = pc.if_else(odd, pc.replace_substring_regex(title, other, " "), title)
            yield part, *_split(title)


def _aligned_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The words of aligned_words() of some rows of _both() at a time: the rows, each word's row and pos, and l and r as values and codes."""
    for part, left, at in _titles_in(batches):
        right, beside = _split(part.column(1))
        counts = np.bincount(at, minlength=part.num_rows)
        same = counts == np.bincount(beside, minlength=part.num_rows)
        if not same.all():
            left, right, at, counts = left.filter(pa.array(same[at])), right.filter(pa.array(same[beside])), at[same[at]], np.where(same, counts, 0)
        yield part, at, np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts), _coded(left), _coded(right)


def word_pairs(rows: DataFrame) -> DataFrame:
    """l, r of aligned_words(), each pair at least once: what a task looks at together is made distinct, so Spark sees words and not their
    occurrences. Who reads them makes them distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, (left, i), (right, j) in _aligned_in(batches):
            found = pd.unique(i * max(1, len(right)) + j)
            yield pa.RecordBatch.from_arrays([left.take(pa.array(found // max(1, len(right)))), right.take(pa.array(found % max(1, len(right))))], names=["l", "r"])

    return _both(rows).mapInArrow(run, "l string, r string")


def first_pairs(rows: DataFrame) -> DataFrame:
    """l, id, pos, r of aligned_words(), among them each word's first by id and pos: of what a task looks at together, the first of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, row, pos, (left, i), (right, j) in _aligned_in(batches):
            order = pc.array_sort_indices(part.column(2)).to_numpy()
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            by = np.argsort(rank[row], kind="stable")  # places are in order within a row
            first = by[~pd.Series(i[by]).duplicated().to_numpy()]
            yield pa.RecordBatch.from_arrays([left.take(pa.array(i[first])), part.column(2).take(pa.array(row[first])), pa.array(pos[first].astype(np.int32)), right.take(pa.array(j[first]))], names=["l", "id", "pos", "r"])

    return _both(rows, "id").mapInArrow(run, "l string, id string, pos int, r string")


#: So many rows of each reading are named.
NAMED = 3


def witnessed(rows: DataFrame) -> DataFrame:
    """l, r, n and ids of aligned_words(), some rows for each pair, of different ids: in how many ids it is, and the first of them. Each id has one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, row, _, (left, i), (right, j) in _aligned_in(batches):
            ids, own = _coded(part.column(2))
            order = pc.array_sort_indices(ids).to_numpy()
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            pair, which = pd.factorize(i * max(1, len(right)) + j)
            seen = np.unique(pair * max(1, len(ids)) + rank[own[row]])
            pair, at = seen // max(1, len(ids)), seen % max(1, len(ids))
            n = np.bincount(pair, minlength=len(which))
            first = np.arange(len(pair)) - (np.cumsum(n) - n)[pair] < NAMED
            named = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.minimum(n, NAMED))).astype(np.int32)), ids.take(pa.array(order[at[first]])))
            yield pa.RecordBatch.from_arrays([left.take(pa.array(which // max(1, len(right)))), right.take(pa.array(which % max(1, len(right)))), pa.array(n.astype(np.int64)), named], names=["l", "r", "n", "ids"])

    return _both(rows, "id").mapInArrow(run, "l string, r string, n bigint, ids array<string>")


def vocabulary(rows: DataFrame, names: DataFrame) -> DataFrame:
    """word, distinct, of occurrences(): of titles each task passes on distinct words of what it looks at together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found, _ in _titles_in(batches):
            yield pa.RecordBatch.from_arrays([found.unique()], names=["raw"])

    each = lambda df, c: df.select(F.explode(X.words(F.coalesce(c, F.lit("")))).alias("raw"))
    raw = rows.select(F.coalesce("title", F.lit(""))).mapInArrow(run, "raw string").unionByName(each(rows, "author")).unionByName(each(names, "name"))
    return raw.distinct().select(X.bare(F.col("raw")).alias("word")).distinct()


def occurrences(rows: DataFrame, names: DataFrame) -> DataFrame:
    """surface (title, author or cluster), id, raw and word (raw without marks) of every word of titles,
    authors and cluster names (cluster_id, name), each once a row."""
    of = lambda df, key, c, surface: df.select(F.lit(surface).alias("surface"), F.col(key).alias("id"), F.explode(F.array_distinct(X.words(F.coalesce(c, F.lit(""))))).alias("raw"))
    each = of(rows, "id", "title", "title").unionByName(of(rows, "id", "author", "author")).unionByName(of(names, "cluster_id", "name", "cluster"))
    return each.withColumn("word", X.bare(F.col("raw")))


def _counted(found: DataFrame, by: list[str]) -> DataFrame:
    """How many titles, authors and clusters of each key; the rows themselves aren't gathered."""
    each = found.select(*by, "surface", "id").distinct()
    return each.groupBy(*by).agg(*(F.count_if(F.col("surface") == s).alias(f"n_{s}s") for s in ("title", "author", "cluster")))


def shadda_items(rows: DataFrame, covered: DataFrame, fixes: DataFrame | None = None, exclude: tuple[str, ...] = ()) -> DataFrame:
    """word, proposed, translit, translits, confidence, n_rows: words that stand unmarked in n_rows titles and
    whose romanizations double a consonant. A mark is proposed where there is one romanization that doubles one
    letter with one place. A ya with a hamza isn't doubled. Words that a card of another kind covers
    are left out. fixes: word and the corrected romanization that is offered instead."""
    pairs = aligned_words(rows)
    seen = saved(pairs.select("l", "r").distinct().select("l", X.bare(F.col("l")).alias("word"), "r"))  # words, not their occurrences
    per = seen.groupBy("word").agg(F.array_sort(F.collect_set("r")).alias("translits"))
    doubled = F.array_distinct(F.flatten(F.transform("translits", geminated)))
    found = per.where(~F.col("word").isin("", *exclude)).withColumn("doubled", doubled)
    found = saved(found.where((F.size("doubled") > 0) & ~((F.array_join("doubled", "") == "y") & F.contains("word", F.lit("يئ")))).join(covered.select("word").distinct(), "word", "left_anti"))
    # rows are counted for the words that are left only
    unmarked = seen.where(~F.contains("l", F.lit(SHADDA))).select("l", "word").distinct().join(found.select("word"), "word", "left_semi")
    counted = pairs.select("id", "l").join(unmarked, "l").select("word", "id").distinct().groupBy("word").agg(F.count("id").alias("n_rows")).where("n_rows > 0")
    found = found.join(counted, "word")
    sure = (F.size("doubled") == 1) & (F.size("translits") == 1)
    found = found.withColumn("proposed", F.when(sure, place_shadda(F.col("word"), X.mapped(F.get("doubled", F.lit(0)), CONSONANTS))))
    fixed = (fixes if fixes is not None else rows.sparkSession.createDataFrame([], "word string, fix string")).select(X.bare(F.col("word")).alias("word"), F.col(fixes.columns[1] if fixes is not None else "fix").alias("__fix")).dropDuplicates(["word"])
    offered = F.coalesce("__fix", F.when(F.size("translits") == 1, F.get("translits", F.lit(0))))
    return found.join(fixed, "word", "left").select("word", "proposed", offered.alias("translit"), "translits", F.when(F.col("proposed").isNotNull(), "shadda").otherwise("shadda-manual").alias("confidence"), "n_rows")


def hamza_items(rows: DataFrame, names: DataFrame, covered: DataFrame, known: dict[str, str] | None = None) -> DataFrame:
    """word, verdict, proposed, translits, confidence, n_titles, n_authors, n_clusters for words that open with a
    bare alif in titles, authors or names (cluster_id, name) and may need a carrier. A word that no
    romanization is aligned with takes its form from `known`, else none is proposed; one that joins is left out."""
    pairs = saved(aligned_words(rows).select("l", "r").distinct())  # before they are gathered, which sorts
    readings = pairs.groupBy(X.bare(F.col("l")).alias("word")).agg(F.array_sort(F.collect_set("r")).alias("translits"))
    seen = occurrences(rows, names).where(stem(F.col("word")).startswith("ا") & ~F.col("word").rlike(f"[{CARRIERS}]"))
    per = _counted(seen, ["word"]).join(covered.select("word").distinct(), "word", "left_anti").join(readings, "word", "left")
    none = F.expr("cast(array() as array<string>)")
    judged = per.withColumn("translits", F.coalesce("translits", none)).withColumn("verdict", F.when(F.size("translits") > 0, hamza_verdict(F.col("word"), F.col("translits"))).otherwise("?"))
    named = F.when(F.col("word").isin("", *(known or {})), X.mapped(F.col("word"), known or {}))
    proposed = F.when(F.size("translits") == 0, named).when(F.col("verdict") != "?", carry_hamza(F.col("word"), F.col("verdict")))
    out = judged.where("verdict <> 'wasl'").withColumn("proposed", proposed)
    return out.select("word", "verdict", "proposed", "translits", F.when(F.col("proposed").isNotNull(), "hamza").otherwise("hamza-manual").alias("confidence"), "n_titles", "n_authors", "n_clusters")


def ortho_scope(cards: DataFrame, rows: DataFrame, names: DataFrame) -> DataFrame:
    """card, surface, id: where the fault of each card (id, word, proposed, only_rows) still stands, mark-blind but
    for what already reads as proposed. A card with only_rows reaches those rows' titles alone."""
    c = cards.select(F.col("id").alias("card"), "word", "proposed", "only_rows")
    met = c.join(occurrences(rows, names), "word").where(F.col("proposed").isNull() | (F.col("raw") != F.col("proposed")))
    own = F.coalesce(F.size("only_rows") == 0, F.lit(True)) | ((F.col("surface") == "title") & F.array_contains("only_rows", F.col("id")))
    return met.where(own).select("card", "surface", "id").distinct()


def ortho_items(cards: DataFrame, rows: DataFrame, names: DataFrame, keeps: DataFrame, lex: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """id, word, proposed, key_changes, row_scoped, translit_was, n_titles, n_authors, n_clusters of the cards whose fault
    still stands somewhere and that no keep rules out. lex: key, reading. found: key and readings, of which a single one
    tells how a word is romanized today where the lexicon doesn't."""
    counted = _counted(ortho_scope(pending(cards, keeps), rows, names), ["card"]).withColumnRenamed("card", "id")
    own = cards.join(counted, "id").withColumn("key", X.normalize_ar(F.col("word")))
    changes = F.coalesce(F.col("key") != X.normalize_ar(F.col("proposed")), F.lit(False))
    known = own.join(lex.select("key", F.col("reading").alias("translit_was")), "key", "left")
    if found is not None:
        single = found.where(F.size("readings") == 1).select("key", F.get("readings", F.lit(0)).alias("__single"))
        known = known.join(single, "key", "left").withColumn("translit_was", F.coalesce("translit_was", "__single"))
    scoped = F.coalesce(F.size("only_rows") > 0, F.lit(False))
    return known.select("id", "word", "proposed", changes.alias("key_changes"), scoped.alias("row_scoped"), "translit_was", "n_titles", "n_authors", "n_clusters")


def ortho_rows(cards: DataFrame, rows: DataFrame, names: DataFrame, keeps: DataFrame) -> DataFrame:
    """card, surface, id, text, after and translit: what each card would change, a row for each title and author that it
    reaches and each cluster (without a text). A card may reach a third of all rows, so they aren't gathered."""
    met = ortho_scope(pending(cards, keeps), rows, names).join(cards.select(F.col("id").alias("card"), "word", "proposed"), "card")
    own = rows.select("id", "title", "author", F.coalesce("title_translit", F.lit("")).alias("translit"))
    text = F.when(F.col("surface") == "title", F.col("title")).when(F.col("surface") == "author", F.col("author"))
    shown = met.join(own, "id", "left").withColumn("text", text)
    return shown.select("card", "surface", "id", "text", preview(F.col("text"), F.col("word"), F.col("proposed")).alias("after"), F.when(F.col("surface") == "title", F.col("translit")).alias("translit"))


def card_list(hand: DataFrame, derived: DataFrame) -> DataFrame:
    """Cards written by hand and derived ones as one list, with a flag; only a hand card keeps its only_rows."""
    cards = hand.withColumn("hand", F.lit(True)).unionByName(derived.withColumn("hand", F.lit(False)), allowMissingColumns=True)
    rows = F.col("only_rows") if "only_rows" in cards.columns else F.lit(None).cast("array<string>")
    return cards.withColumn("only_rows", F.when(F.col("hand"), rows))


def _before(title: Column, marker: Column) -> Column:
    """The title up to the first word whose key the marker is, null for none. Only a title with marks or tatweel is taken apart: in others each letter of a
    key stands for one of the title, so the marker is looked for in the whole."""
    letter, word = X.WORD.removesuffix("+"), F.coalesce(marker, F.lit(""))
    parts = F.split(X.alike(title), F.concat(F.lit(f"(?<!{letter})"), word, F.lit(f"(?!{letter})")), 2)
    plain = F.when(word.rlike(f"^{X.WORD}$") & (F.size(parts) == 2), F.substr(title, F.lit(1), F.length(F.get(parts, F.lit(0)))))
    upto = lambda xs, n: F.slice(xs, F.lit(1), n)
    gaps = F.split(title, X.WORD, -1)
    head = lambda n: F.when(n >= 0, F.concat(F.array_join(F.zip_with(upto(gaps, n), upto(X.words(title), n), lambda gap, w: F.concat(gap, w)), ""), F.get(gaps, n)))
    whole = F.get(F.transform(F.array(F.array_position(X.word_keys(title), marker).cast("int") - 1), head), F.lit(0))
    return F.when(title.rlike(rf"[\p{{M}}{X.TATWEEL}]"), whole).otherwise(plain)


def _cut(marks: DataFrame, rows: DataFrame | None, keeps: DataFrame) -> DataFrame:
    """id, row, verdict, marker, title, title_translit and head (the title up to the marker) of marks whose row still holds it. What is cut is put through a
    generator, so that neither a filter nor a later column works it out anew."""
    held = lambda df: df.withColumns({c: F.coalesce(c, F.lit("")) for c in ("title", "title_translit")})
    asked = pending(marks.withColumn("id", F.concat("row", F.lit("-attr"))).withColumn("__m", X.normalize_ar(F.col("marker"))), keeps)
    own = held(asked) if rows is None else asked.select("id", "row", "verdict", "marker", "__m").join(held(rows.select(F.col("id").alias("row"), "title", "title_translit")), "row")
    return own.select("id", "row", "verdict", "marker", "title", "title_translit", F.explode(F.array_compact(F.array(_before(F.col("title"), F.col("__m"))))).alias("head"))


def _tails(cut: DataFrame, *more: Column) -> DataFrame:
    at = cut.withColumns({"l": X.tokens(F.col("title_translit")), "at": F.regexp_count("head", F.lit(X.WORD)), "n": F.regexp_count("title", F.lit(X.WORD))})
    aligned = (F.col("n") == F.size("l")) & (F.col("n") > 0)
    return at.withColumn("aligned", aligned).select(
        "id", "row", "verdict", F.trim(F.substr(F.col("title"), F.length("head") + 1)).alias("tail"), F.when(F.col("aligned"), F.array_join(F.slice("l", F.col("at") + 1, F.greatest(F.size("l") - F.col("at"), F.lit(0))), " ")).alias("tail_translit"),
        F.trim("head").alias("proposed_title"), F.when(F.col("aligned"), F.array_join(F.slice("l", F.lit(1), F.col("at")), " ")).alias("proposed_translit"), "aligned", "marker", "title", "title_translit", *more,
    )


def tails(marks: DataFrame, rows: DataFrame | None, keeps: DataFrame) -> DataFrame:
    """attribution_items() without collides_with."""
    return _tails(_cut(marks, rows, keeps))


#: Beyond so many rows whose proposals are others' too, titles are shuffled to meet them; a group's list goes to a part for each PART of its rows.
FEW, PART = 1_000_000, 1_000


def _with_groups(own: DataFrame, norm: DataFrame) -> DataFrame:
    """own (with a column row), and all: the rows whose norm (row, norm) is theirs too, null for none. A group's list is one row until it stands beside the
    members: the lists of all members grow with the square of a group, so they are neither shuffled nor broadcast."""
    from lamina.operators.audit import several

    some = saved(sharing(norm, "norm"))
    groups = saved(several(some, ["norm"], "row", "all"))
    if some.count() <= FEW:
        return own.join(F.broadcast(some), "row", "left").join(F.broadcast(groups), "norm", "left")
    n = F.ceil(F.size("all") / PART).cast("int")
    part = some.join(groups.select("norm", n.alias("n")), "norm").select("row", "norm", F.pmod(F.hash("row"), "n").alias("part"))
    # rows without a group are spread too
    met = own.join(part, "row", "left").withColumn("part", F.coalesce("part", F.pmod(F.hash("row"), F.lit(1 << 20))))
    return met.join(groups.select("norm", "all", F.explode(F.sequence(F.lit(0), n - 1)).alias("part")), ["norm", "part"], "left")


def attribution_items(marks: DataFrame, rows: DataFrame | None, keeps: DataFrame) -> DataFrame:
    """id, row, verdict, tail, tail_translit, proposed_title, proposed_translit, aligned, collides_with, and marker, title and
    title_translit as they are, for each mark (row, marker, verdict; one a row) whose row still holds the marker: the tail begins at its first place, and what is left
    of the title is proposed. rows: None where the marks have title and title_translit themselves, which then meet nothing. collides_with: the other rows of the batch whose
    proposals are the same title.

    Titles are cut twice, first for a digest of what is proposed, which is saved, and then for the result, so no title is saved or shuffled once more."""
    cut = _cut(marks, rows, keeps)
    norm = saved(cut.select("row", digest(X.normalize_ar(F.trim("head"))).alias("norm")))
    return _tails(_with_groups(cut, norm), F.coalesce(F.array_remove("all", F.col("row")), F.expr("cast(array() as array<string>)")).alias("collides_with"))
