"""Human decisions applied to rows as guarded, idempotent passes, each with its ledger.

Decisions carry an ordinal; those on one row are folded over it in that order, each seeing what the
ones before have left. Every decision ends in the ledger as applied, unchanged, quarantined with a
reason, or deferred. Rows meet their decisions by a join on the row id, so passes spread over keys.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import textnorm as X
from lamina.operators.graph import saved

_WORD = re.compile(X.WORD)
# The notes that rows carry about a tail that was taken off a title.
MOVED = "Title as catalogued ends «{}»"
UNTRIMMED = "title_translit not trimmed with the removed tail «{}» — word counts did not align."
ORTHO = "ord int, id string, word string, target string, translit string, confidence string, row_scoped boolean, translit_source string, rows array<string>, authors array<string>, title_scope array<string>"


def live(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Resolved decisions, and the rest."""
    return decisions.where("disposition = 'resolved'"), decisions.where("NOT coalesce(disposition = 'resolved', false)")


def reject_ortho(d: DataFrame) -> DataFrame:
    """Adds reason: why a spelling decision can't stand, null if it can."""
    target, translit = F.trim(F.coalesce("target", F.lit(""))), F.trim(F.coalesce("translit", F.lit("")))
    derived = F.coalesce("confidence", F.lit("")).rlike("^(?:hamza|shadda)")
    in_titles = (F.coalesce(F.size("rows"), F.lit(0)) > 0) | (F.coalesce(F.size("title_scope"), F.lit(0)) > 0) | ((F.coalesce("n_titles", F.lit(0)) > 0) if "n_titles" in d.columns else F.lit(False))
    reason = (
        F.when(target == "", "no canonical form recorded")
        .when(X.latin_in_arabic(target), "the Arabic form has Latin characters")
        .when(derived & (X.normalize_ar(F.col("word")) != X.normalize_ar(target)), "a derived card may only add marks or a carrier")
        .when((target != F.col("word")) & in_titles & (translit == ""), "a new spelling needs a transliteration")
    )
    return d.withColumns({"target": target, "translit": translit}).withColumn("reason", reason)


def gates(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overrides (key, reading) that standing decisions give the lexicon, and the keys they settle: only
    an answer typed or chosen settles, both the old key and the new; row-scoped ones do neither."""
    given = d.where("reason IS NULL AND translit <> '' AND NOT coalesce(row_scoped, false)").withColumn("new", X.normalize_ar(F.col("target"))).withColumn("old", X.normalize_ar(F.col("word")))
    overrides = given.groupBy(F.col("new").alias("key")).agg(F.max_by("translit", "ord").alias("reading"))
    settled = given.where(F.col("translit_source").isin("typed", "chosen")).select(F.explode(F.array("old", "new")).alias("key")).distinct()
    return overrides, settled


@lru_cache(1 << 16)
def _plain(w: str) -> str:
    return "".join(c for c in w if not unicodedata.combining(c) and c != X.TATWEEL)


def _replace(text: str, word: str, target: str) -> tuple[str, list[int]]:
    """Whole tokens that read `word` mark-blind become the target; their places among the tokens."""
    places: list[int] = []
    count = iter(range(len(text)))

    def turn(m: re.Match) -> str:
        i = next(count)
        if _plain(m[0]) != word:
            return m[0]
        places.append(i)
        return target

    return _WORD.sub(turn, text), places


def _fold_ortho(own: dict, decisions: list) -> tuple[dict, list[tuple]]:
    title, translit, author = own["title"], own["title_translit"], own["author"]
    ledger: list[tuple] = []
    for d in decisions:
        word, target = d["word"], d["target"]
        if d["surface"] == "author":
            fresh, places = _replace(author, word, target)
            ledger.append((d["id"], "ortho", "applied" if fresh != author else "unchanged", None, False))
            author = fresh
            continue
        fresh, places = _replace(title, word, target)
        if not places:
            done = any(_plain(w) == _plain(target) for w in _WORD.findall(title))
            ledger.append((d["id"], "ortho", "unchanged", None, False) if done else (d["id"], "ortho", "quarantine", f"the row no longer contains {word}", False))
            continue
        if fresh == title:
            ledger.append((d["id"], "ortho", "unchanged", None, False))
            continue
        n, title = len(_WORD.findall(title)), fresh
        parts = translit.split()
        if parts and len(parts) != n:  # the title is rewritten and the mismatch reported: partial
            ledger.append((d["id"], "ortho", "quarantine", f"title and transliteration have {n} and {len(parts)} words", True))
            continue
        for i in places if parts else ():
            bound = parts[i].endswith("at") and d["translit"].endswith("ah")
            parts[i] = d["translit"][:-2] + "at" if bound else d["translit"]
        translit = " ".join(parts) if parts else translit
        ledger.append((d["id"], "ortho", "applied", None, False))
    return {"title": title, "title_translit": translit, "author": author}, ledger


#: Python takes so many rows at a time, and ends a batch with the row that takes it beyond so many bytes.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

LEDGER = "array<struct<id:string,stratum:string,status:string,reason:string,partial:boolean>>"


def apply_ortho(rows: DataFrame, decisions: DataFrame, scope: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (id, title, title_translit, author, ...) after the spelling decisions, and the ledger (row,
    id, stratum, status, reason, partial). A decision whose target is its word is a keep and unchanged. scope: card, surface and id, what
    each decision reaches besides what it lists itself."""
    judged = reject_ortho(decisions)
    rejected = judged.where("reason IS NOT NULL").select(F.lit(None).cast("string").alias("row"), "id", F.lit("ortho").alias("stratum"), F.lit("quarantine").alias("status"), "reason", F.lit(False).alias("partial"))
    kept = judged.where("reason IS NULL AND target = word").select(F.lit(None).cast("string").alias("row"), "id", F.lit("ortho").alias("stratum"), F.lit("unchanged").alias("status"), F.lit(None).cast("string").alias("reason"), F.lit(False).alias("partial"))
    none = F.expr("cast(array() as array<string>)")
    on = lambda c, surface: judged.where("reason IS NULL AND target <> word").select("ord", "id", "word", "target", "translit", F.lit(surface).alias("surface"), F.explode(F.coalesce(c, none)).alias("row"))
    each = on("rows", "title").unionByName(on("authors", "author"))
    if scope is not None:
        reached = scope.where("surface <> 'cluster'").select(F.col("card").alias("id"), "surface", F.col("id").alias("row"))
        each = each.unionByName(judged.where("reason IS NULL AND target <> word").select("ord", "id", "word", "target", "translit").join(reached, "id")).dropDuplicates(["ord", "id", "surface", "row"])
    fresh, ledger = _fold_rows(rows, each, ("title", "title_translit", "author"), _fold_ortho)
    return fresh, ledger.unionByName(rejected).unionByName(kept)


def _fold_rows(rows: DataFrame, decisions: DataFrame, fields: tuple[str, ...], fold, key: str = "id", stratum: str = "ortho", entries: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose fields went through fold(values, decisions in order) -> (values, ledger), and the
    ledger. decisions: row, ord, id and what the fold reads. Rows without a decision don't
    reach Python; a row's decisions are folded together because each sees what the last one left. Rows that were folded are saved,
    so that neither decisions nor folds are worked out again for the rest of the rows and the ledger. entries: a column for a row's own
    ledger, null for none, so that who wants both needs no join of them."""
    spark = rows.sparkSession
    others = [c for c in decisions.columns if c != "row"]
    per_row = decisions.groupBy(F.col("row").alias(key)).agg(F.collect_list(F.struct(*others)).alias("__d"))
    kinds = dict(rows.select(*fields).dtypes)
    made = ", ".join(f"{c} {kinds[c]}" for c in fields)

    @F.pandas_udf(f"{made}, ledger {LEDGER}")
    def folded(values: pd.DataFrame, ds: pd.Series) -> pd.DataFrame:
        out = []
        for own, d in zip(values.to_dict("records"), ds, strict=True):
            fresh, ledger = fold({c: own[c] if own[c] is not None else "" for c in fields}, sorted(d, key=lambda x: x["ord"]))
            out.append({c: fresh[c] for c in fields} | {"ledger": [dict(zip(("id", "stratum", "status", "reason", "partial"), x, strict=True)) for x in ledger]})
        return pd.DataFrame(out, columns=[*fields, "ledger"])

    met = rows.join(per_row, key).withColumn("__f", folded(F.struct(*fields), F.col("__d")))
    before = {k: spark.conf.get(k, None) for k in BATCH}
    try:
        for k, v in BATCH.items():
            spark.conf.set(k, v)
        touched = saved(met.select(*(F.col(f"__f.{c}").alias(c) if c in fields else F.col(c) for c in rows.columns), F.col("__f.ledger").alias("__ledger")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    more = {entries: F.col("__ledger")} if entries else {}
    rest = rows.join(touched.select(key), key, "left_anti").select(*rows.columns, *(F.lit(None).cast(LEDGER).alias(c) for c in more))
    fresh = rest.unionByName(touched.select(*rows.columns, *(c.alias(name) for name, c in more.items())))
    ledger = touched.select(F.col(key).alias("row"), F.explode("__ledger").alias("l")).select("row", "l.*")
    missing = decisions.join(rows.select(F.col(key).alias("row")), "row", "left_anti")
    lost = missing.select("row", "id", F.lit(stratum).alias("stratum"), F.lit("quarantine").alias("status"), F.lit("no such row" if key == "id" else "no such cluster").alias("reason"), F.lit(False).alias("partial"))
    return fresh, ledger.unionByName(lost)


def apply_ortho_names(clusters: DataFrame, decisions: DataFrame, scope: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Clusters (cluster_id, canonical_ar, variants, ...) whose names the spelling decisions rewrite, and
    the ledger. decisions: as for apply_ortho, with clusters array<string>. Variants stay distinct and
    in order; a name that doesn't hold the word is left as it is."""
    judged = reject_ortho(decisions).where("reason IS NULL AND target <> word")
    each = judged.select("ord", "id", "word", "target", F.explode(F.coalesce("clusters", F.expr("cast(array() as array<string>)"))).alias("row"))
    if scope is not None:
        reached = scope.where("surface = 'cluster'").select(F.col("card").alias("id"), F.col("id").alias("row"))
        each = each.unionByName(judged.select("ord", "id", "word", "target").join(reached, "id")).dropDuplicates(["ord", "id", "row"])

    def fold(own: dict, ds: list) -> tuple[dict, list[tuple]]:
        ledger = []
        for d in ds:
            name = _replace(own["canonical_ar"], d["word"], d["target"])[0]
            variants = sorted({_replace(v, d["word"], d["target"])[0] for v in own["variants"]})
            changed = name != own["canonical_ar"] or any(_replace(v, d["word"], d["target"])[0] != v for v in own["variants"])
            own = {"canonical_ar": name, "variants": variants if changed else list(own["variants"])}
            ledger.append((d["id"], "ortho", "applied" if changed else "unchanged", None, False))
        return own, ledger

    return _fold_rows(clusters, each, ("canonical_ar", "variants"), fold, "cluster_id")


def _with(decisions: DataFrame, **kinds: str) -> DataFrame:
    """id, row, ord and the named columns, null where the decisions lack one."""
    has = set(decisions.columns)
    own = [F.col(c).cast(k).alias(c) if c in has else F.lit(None).cast(k).alias(c) for c, k in kinds.items()]
    return decisions.select("id", F.coalesce("row", "id").alias("row"), (F.col("ord") if "ord" in has else F.lit(0)).cast("int").alias("ord"), *own)


def _fold_witness(own: dict, decisions: list) -> tuple[dict, list[tuple]]:
    parts, ledger = own["title_translit"].split(), []
    for d in decisions:
        target, was = (d["target"] or "").strip(), d["was"] or None
        if d["action"] == "keep":
            verdict = "unchanged", None
        elif not target:
            verdict = "quarantine", "no reading recorded"
        elif " ".join(parts) == target or (target in parts and was not in parts):
            verdict = "unchanged", None
        elif was and was not in parts:
            verdict = "quarantine", "the row no longer reads what was corrected"
        else:
            parts, verdict = [target if w == was else w for w in parts], ("applied", None)
        ledger.append((d["id"], "witness", *verdict, False))
    changed = any(x[2] == "applied" for x in ledger)
    return {"title_translit": " ".join(parts) if changed else own["title_translit"]}, ledger


def apply_witness(rows: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """decisions: id, row, was, target, and if given action and ord; a row may have several. A word of the
    transliteration is replaced where it still reads `was`; one that already reads the target, and
    what is to be kept, is unchanged."""
    d = _with(decisions, action="string", was="string", target="string")
    return _fold_rows(rows, d, ("title_translit",), _fold_witness, stratum="witness")


def _key(s: str) -> str:
    """normalize_ar of one value."""
    s = "".join(c for c in unicodedata.normalize("NFKC", s) if not unicodedata.category(c).startswith("M"))
    return " ".join(s.translate(_LETTERS).split())


_LETTERS = str.maketrans("آأإٱىة", "ااااي" + "ه", X.TATWEEL)
_LATIN = re.compile(X.LATIN_OR_DIGIT)
ATTRIBUTED = ("title", "title_translit", "catalog_note", "discrepancy_note")


def _moved(note: str, tail: str, translit: str | None) -> str:
    own = MOVED.format(tail) + (f" ({translit})" if translit else "") + "."
    return f"{note.strip()} {own}".strip()


def _set_title(own: dict, d: dict, target: str, tail: str) -> dict | str:
    """The row's fields with the title that was written for it, or why it can't stand."""
    to, has = (d["target_translit"] or "").strip(), bool(own["title_translit"].strip())
    if _LATIN.search(target):
        return "the title has Latin characters"
    if d["was"] and d["was"].strip() and _key(own["title"]) != _key(d["was"]):
        return "the title is no longer the one corrected"
    if has and not to:
        return "the row has a transliteration and the new title none"
    note = _moved(own["catalog_note"], tail, d["tail_translit"]) if tail and tail not in target else own["catalog_note"]
    return own | {"title": target, "title_translit": to or own["title_translit"], "catalog_note": note}


def _strip_tail(own: dict, d: dict, target: str, tail: str) -> dict | str:
    """The row's fields without the tail's words at the end of the title as it stands now."""
    title = own["title"].strip()
    starts, n = [m.start() for m in _WORD.finditer(title)], len(_WORD.findall(tail))
    if not n or len(starts) <= n:
        return "the title no longer ends with the tail"
    short = title[: starts[-n]].strip()
    if _key(short) != _key(target):
        return "without the tail the title isn't the one decided on"
    out = own | {"title": short, "catalog_note": _moved(own["catalog_note"], tail, d["tail_translit"])}
    if d["target_translit"]:
        parts, last = own["title_translit"].split(), len((d["tail_translit"] or "").split())
        out["title_translit"] = " ".join(parts[:-last]) if 0 < last < len(parts) else d["target_translit"]
    elif not d["aligned"]:
        out["discrepancy_note"] = f"{own['discrepancy_note'].strip()} {UNTRIMMED.format(tail)}".strip()
    return out


def _fold_attribution(own: dict, decisions: list) -> tuple[dict, list[tuple]]:
    ledger = []
    for d in decisions:
        target, tail = (d["target"] or "").strip(), (d["tail"] or "").strip()
        done = {"set_title": _set_title, "strip_tail": _strip_tail}.get(d["action"])
        if d["action"] == "keep":
            verdict = "unchanged", None
        elif done is None:
            verdict = "quarantine", "unknown action"
        elif not target:
            verdict = "quarantine", "no title recorded"
        elif _key(own["title"]) == _key(target):
            verdict = "unchanged", None
        elif isinstance(fresh := done(own, d, target, tail), str):
            verdict = "quarantine", fresh
        else:
            own, verdict = fresh, ("applied", None)
        ledger.append((d["id"], "attribution", *verdict, False))
    return own, ledger


def apply_attribution(rows: DataFrame, decisions: DataFrame, entries: str | None = None) -> tuple[DataFrame, DataFrame]:
    """decisions: id, row, action, was, target, target_translit, tail, tail_translit, and if given aligned
    and ord; a row may have several.

    keep leaves the row; set_title assigns a title where the row still has the one it was made for,
    and needs a transliteration where the row has one; strip_tail takes as many words as the tail has
    off the current title, where that gives the title decided on, and off the transliteration, where one was
    decided on (else a note says that it was left). A tail that goes is moved to catalog_note. Other
    actions are refused. entries: a column of fresh for the row's own ledger, null for none.
    """
    d = _with(decisions, action="string", was="string", target="string", target_translit="string", tail="string", tail_translit="string", aligned="boolean")
    # what is kept is only counted, so its texts aren't gathered
    d = d.withColumns({c: F.when(~F.col("action").eqNullSafe("keep"), F.col(c)) for c in ("was", "target", "target_translit", "tail", "tail_translit")})
    missing = [c for c in ATTRIBUTED if c not in rows.columns]
    fresh, ledger = _fold_rows(rows.withColumns({c: F.lit("") for c in missing}) if missing else rows, d, ATTRIBUTED, _fold_attribution, stratum="attribution", entries=entries)
    return fresh, ledger


def apply_homograph(rows: DataFrame, decisions: DataFrame, lex: DataFrame) -> tuple[DataFrame, DataFrame]:
    """decisions: id, row, readings map<key, reading>, and if given ord; a row may have several. Composes
    the title from the chosen readings and the lexicon, by the first decision that can be; a row that has a
    transliteration is unchanged; a reading left open, and a word that nothing settles, is refused."""
    from lamina.operators.lexicon import construct, looked_up

    d = decisions.select(F.col("id").alias("did"), F.coalesce("row", "id").alias("row"), "readings", (F.col("ord") if "ord" in decisions.columns else F.lit(0)).alias("ord"))
    own = rows.select(F.col("id").alias("row"), F.coalesce("title", F.lit("")).alias("t"), F.trim(F.coalesce("title_translit", F.lit(""))).alias("l"))
    j = d.join(own, "row", "left").withColumn("w", X.word_keys(F.col("t")))
    # of each title its distinct words meet the lexicon, and what they find is looked up place by place
    known = j.select("did", "row", F.explode(F.array_distinct("w")).alias("key")).join(lex.select("key", "reading").where("reading IS NOT NULL"), "key")
    known = known.groupBy("did", "row").agg(F.map_from_entries(F.collect_list(F.struct("key", "reading"))).alias("known"))
    k = j.join(known, ["did", "row"], "left").withColumns({"chosen": looked_up(F.col("w"), F.col("readings")), "given": looked_up(F.col("w"), F.col("known"))})
    k = k.withColumn("parts", F.zip_with("chosen", "given", lambda own, reading: F.coalesce(F.nullif(own, F.lit("")), reading)))
    blank = F.exists(F.map_values(F.coalesce("readings", F.expr("cast(map() as map<string,string>)"))), lambda v: F.coalesce(v, F.lit("")) == "")
    reason = (
        F.when(F.col("t").isNull(), "no such row")
        .when((F.col("l") == "") & blank, "a reading was left open")
        .when((F.col("l") == "") & ((F.size("w") == 0) | F.exists("parts", lambda x: F.coalesce(x, F.lit("")) == "")), "a word is not settled")
    )
    judged = k.withColumn("r", reason).withColumn("can", F.col("r").isNull() & (F.col("l") == ""))
    # titles are composed once, and what is known of each decision is narrow
    judged = saved(judged.select("did", "row", "ord", "r", "can", F.when(F.col("can"), F.array_join(construct(F.col("parts"), F.col("w")), " ")).alias("value")))
    first = judged.where("can").groupBy("row").agg(F.min_by(F.struct("did", "value"), F.struct("ord", "did")).alias("first"))
    ledger = judged.join(first.select("row", F.col("first.did").alias("__first")), "row", "left").select("row", F.col("did").alias("id"), F.lit("homograph").alias("stratum"), F.when(F.col("r").isNotNull(), "quarantine").when(F.col("did") == F.col("__first"), "applied").otherwise("unchanged").alias("status"), F.col("r").alias("reason"), F.lit(False).alias("partial"))
    fresh = rows.join(first.select(F.col("row").alias("id"), F.col("first.value").alias("__v")), "id", "left").withColumn("title_translit", F.coalesce("__v", "title_translit")).drop("__v")
    return fresh, ledger


def keeps(decisions: DataFrame) -> DataFrame:
    """id, stratum, word, row, kept, note: resolved decisions that leave things as they are, so that
    their cards don't come back."""
    resolved, _ = live(decisions)
    target = F.trim(F.coalesce("target", F.lit("")))
    ortho = (F.col("stratum") == "ortho") & (target != "") & (target == F.col("word"))
    other = F.col("stratum").isin("witness", "attribution") & (F.col("action") == "keep")
    own = F.coalesce("row", "id")
    return resolved.where(ortho | other).select("id", "stratum", F.when(ortho, F.col("word")).alias("word"), F.when(other, own).alias("row"), F.when(ortho, target).otherwise(F.col("was")).alias("kept"), F.coalesce("note", F.lit("")).alias("note"))


def reverted(faulty: DataFrame) -> DataFrame:
    """Ledger entries for what unconserved() gives: an edit that a later pass has undone is in quarantine, though a pass
    has truthfully called it applied."""
    return faulty.select("row", "id", F.lit("ortho").alias("stratum"), F.lit("quarantine").alias("status"), F.lit("a later pass has undone the edit").alias("reason"), F.lit(False).alias("partial"))


def unconserved(rows: DataFrame, ledger: DataFrame, decisions: DataFrame) -> DataFrame:
    """Applied spelling decisions whose word is still in a row they touched."""
    d = decisions.select(F.col("id").alias("id"), "word", F.trim("target").alias("target"))
    met = ledger.where("stratum = 'ortho' AND status = 'applied'").select("row", "id").join(d, "id").join(rows.select(F.col("id").alias("row"), "title", "author"), "row")
    faulty = lambda c: F.exists(X.words(F.coalesce(F.col(c), F.lit(""))), lambda t: (X.bare(t) == F.col("word")) & (t != F.col("target")))
    return met.where(faulty("title") | faulty("author")).select("row", "id")
