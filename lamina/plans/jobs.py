"""Whole jobs: build a catalogue, harvest its decisions, group names, audit, make worklists, ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import textnorm as X
from lamina.operators import adjudicate, audit, candidates, fields, lexicon, resolve, strata, worklist
from lamina.operators import export as exporting
from lamina.operators.graph import saved, scratch_dir
from lamina.sources import documents

ROW_DEFAULTS = {"title_translit": "", "title_translation": "", "author_translit": "", "author_translation": "", "catalog_note": "", "pub_status": "unknown", "pub_citation": "", "pub_source": "", "work_url": "", "discrepancy_note": ""}
OVERRIDABLE = ("city", "library", "shelfmark", "folios", "title", "author", *ROW_DEFAULTS)


def extract(cells: DataFrame, captions: tuple[str, ...]) -> DataFrame:
    """Raw rows with ids from the cells (page, table, row, col, text) of ruled tables: headers and rows without a shelfmark,
    title, author or archive are left out, cities and libraries carried down."""
    table = documents.table_rows(cells).withColumns({c: X.squeeze(F.coalesce(c, F.lit(""))) for c in (f"c{i}" for i in range(6))})
    body = table.where(~documents.header(F.array(*(f"c{i}" for i in range(6))), captions))
    named = body.select("page", F.struct("page", "table", "row").alias("__at"), *(F.col(f"c{i}").alias(c) for i, c in enumerate(("city", "library", "shelfmark_raw", "title", "author", "archive"))))
    kept = fields.without_blank(fields.fill_down(named, "__at"), "shelfmark_raw", "title", "author", "archive")
    return fields.mint_row_ids(kept, ["__at"]).drop("__at")


#: What is given by hand: cards on spelling, corrections of single rows, and marks at which a tail of a title begins.
HAND = "id string, word string, proposed string, translit string, translits array<string>, confidence string, reason string, only_rows array<string>"
WITNESSES = "id string, row string, word string, current string, proposed string, why string"
MARKS = "row string, marker string, verdict string, note string"


def _given(spark, df: DataFrame | None, schema: str) -> DataFrame:
    """df with the columns of the schema, null where it lacks one; empty for none."""
    empty = spark.createDataFrame([], schema)
    if df is None:
        return empty
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema.fields))


def cards(
    rows: DataFrame, clusters: DataFrame, keeps: DataFrame, word_decisions: DataFrame, known: dict[str, str] | None = None,
    hand: DataFrame | None = None, witnesses: DataFrame | None = None, marks: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The cards for human decisions in four strata, each with its fingerprint (fp): ortho (marks, carriers and cards by hand),
    homograph, witness and attribution; and scope, what each ortho card reaches.

    keeps: id. word_decisions: key, reading, varies. hand, witnesses and marks have the columns of HAND, WITNESSES
    and MARKS; ones that are missing are null. A word that a card by hand is about has no derived card, even
    where that card is ruled out, for it would ask the same again. A corrected row's reading is offered for its word. Cards are derived
    from rows and clusters outside the modern category; corrections and marks are about any row.
    """
    spark = rows.sparkSession
    hand, witnesses, marks = (_given(spark, *x) for x in ((hand, HAND), (witnesses, WITNESSES), (marks, MARKS)))
    modern = clusters.where("category = 'modern'").select("cluster_id")
    old = rows.join(modern.withColumnRenamed("cluster_id", "author_cluster_id"), "author_cluster_id", "left_anti")
    kept = clusters.join(modern, "cluster_id", "left_anti")
    written = F.concat(F.array(F.coalesce("canonical_ar", F.lit(""))), F.coalesce("variants", F.expr("cast(array() as array<string>)")))
    names = kept.select("cluster_id", F.explode(F.array_distinct(written)).alias("name"))
    pairs = worklist.aligned_words(rows).withColumn("l", X.normalize_ar(F.col("l")))
    found = lexicon.readings(pairs)
    lex = lexicon.lexicon(found, word_decisions)

    covered = hand.select(X.bare(F.col("word")).alias("word")).distinct()
    shadda = worklist.shadda_items(old, covered, witnesses.select("word", "proposed"))
    hamza = worklist.hamza_items(old, names, covered, known).withColumn("translit", F.when(F.size("translits") == 1, F.get("translits", F.lit(0))))
    derived = lambda df, prefix: df.select(F.concat(F.lit(prefix), "word").alias("id"), "word", "proposed", "translit", "translits", "confidence")
    listed = worklist.card_list(hand, derived(shadda, "s-").unionByName(derived(hamza, "h-")))
    ortho = worklist.ortho_items(listed, old, names, keeps, lex, found).join(listed.select("id", "translit", "translits", "confidence", "reason", "hand"), "id")

    shown = clusters.select(F.col("cluster_id").alias("author_cluster_id"), F.coalesce(F.nullif("canonical_translit", F.lit("")), F.lit("—")).alias("author"))
    of_row = rows.select("id", "author_cluster_id").join(shown, "author_cluster_id", "left").select("id", F.coalesce("author", F.lit("—")).alias("author"))
    homograph = worklist.homograph_items(old, pairs, lex, found.where("contested")).join(of_row, "id", "left")
    waiting = homograph.select("id", F.explode("keys.key").alias("key"))
    fixes = witnesses.withColumn("row", F.coalesce("row", "id"))
    own = rows.select(F.col("id").alias("row"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("title_translit", F.lit("")).alias("title_translit"))
    witness = worklist.witness_items(fixes, rows, keeps, waiting).join(own, "row")
    tails = worklist.attribution_items(marks, rows, keeps).join(marks.select("row", "note").dropDuplicates(["row"]), "row").join(of_row.withColumnRenamed("id", "row"), "row", "left")
    strata_ = {"ortho": ortho, "homograph": homograph, "witness": witness, "attribution": tails}
    made = {name: strata.fingerprinted(df, name) for name, df in strata_.items()}
    return made | {"scope": worklist.ortho_rows(listed, old, names, keeps)}


def export(made: dict[str, DataFrame], answers: DataFrame) -> dict[str, DataFrame]:
    """A record for each card with what was answered, and the scope of the spelling decisions, as ingest takes them."""
    records = exporting.decisions({k: v for k, v in made.items() if k != "scope"}, answers)
    return {"decisions": records, "scope": made["scope"]}


def build(raw: DataFrame, pins: DataFrame, authority: DataFrame, overrides: DataFrame, curated: DataFrame, cities: dict[str, str], libraries: dict[str, str], roles: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """rows, clusters and detached from raw rows (id, shelfmark_raw, ...).

    pins: norm, cluster_id. authority: cluster_id and the metadata of its cluster. overrides: id and a
    map of fields. Pinned names keep their cluster; the rest is clustered, and minted ids that are free,
    larger clusters first. detached lists edited authors that no pin holds.
    """
    rows = fields.defaults(fields.normalize_rows(raw, cities, libraries), ROW_DEFAULTS)
    rows = resolve.overlay(rows, overrides, list(OVERRIDABLE)).withColumn("author", X.blank_placeholder(F.col("author")))
    rows = rows.withColumn("__norm", F.nullif(X.normalize_ar(F.trim("author")), F.lit("")))
    edited = overrides.where(F.map_contains_key("values", F.lit("author"))).select("id")
    detached = rows.where("__norm IS NOT NULL").join(edited, "id", "left_semi").join(pins, F.col("__norm") == F.col("norm"), "left_anti").select("id", "author")

    names = rows.where("__norm IS NOT NULL").select("id", F.trim("author").alias("form"), F.col("__norm").alias("norm"))
    pinned, rest = resolve.pin_split(names, pins, "norm")
    folded = rest.withColumn("fold", X.fold_orthography(F.col("norm")))
    grouped = folded.join(resolve.cluster_names(folded.select(F.col("fold").alias("name")).distinct()).withColumnRenamed("name", "fold"), "fold")
    sizes = grouped.groupBy("component").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    minted = resolve.mint_ids(sizes, [-F.col("n"), F.col("first")], pinned.select(F.col("cluster_id").alias("id")).distinct(), start=0).select("component", F.col("id").alias("cluster_id"))
    members = pinned.select("cluster_id", "id", "form", "norm").unionByName(grouped.join(minted, "component").select("cluster_id", "id", "form", "norm"))

    picked = resolve.canonical(members, ["cluster_id"], "form").withColumn("canonical", X.squeeze(F.regexp_replace("canonical", " [ً-ْٰ]+", "")))
    translit = resolve.pick_translit(members, "cluster_id", "norm", curated, "id", roles)
    fresh = resolve.confidence(members.join(pinned.select("cluster_id").distinct(), "cluster_id", "left_anti"), "cluster_id", "norm")
    computed = members.groupBy("cluster_id", F.col("form").alias("variant")).agg(F.min("id").alias("ord"))
    pins_of = authority.select("cluster_id", F.posexplode(F.coalesce("variants", F.expr("cast(array() as array<string>)"))).alias("ord", "variant"))
    variants = resolve.merge_variants(computed, pins_of)
    meta = authority.select("cluster_id", F.nullif("canonical_ar", F.lit("")).alias("__ar"), F.nullif("canonical_translit", F.lit("")).alias("__tr"), "full_name", "dates", "category", "authorities", "user_confirmed")
    clusters = picked.join(translit, "cluster_id").join(variants, "cluster_id").join(fresh, "cluster_id", "left").join(meta, "cluster_id", "left")
    clusters = clusters.select("cluster_id", F.coalesce("__ar", "canonical").alias("canonical_ar"), F.coalesce("__tr", "translit").alias("canonical_translit"), "full_name", "dates", "category", "variants", "count", F.coalesce("confidence", F.lit(1.0)).alias("confidence"), F.coalesce("user_confirmed", F.lit(False)).alias("user_confirmed"), "authorities").orderBy(F.desc("count"), "cluster_id")
    tagged = rows.join(members.select("norm", "cluster_id").distinct(), F.col("__norm") == F.col("norm"), "left").withColumn("author_cluster_id", F.coalesce("cluster_id", F.lit(""))).drop("__norm", "norm", "cluster_id")
    return tagged, clusters, detached


def harvest(rows: DataFrame, clusters: DataFrame, baseline: DataFrame, named_merges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """pins, authority, overrides and conflicts from an export: rows against the stable baseline, so that
    harvesting again changes nothing. named_merges: variant, cluster_id, which win. Refuses an export
    whose ids aren't the baseline's."""
    resolve.check_ids(baseline, rows)
    named = rows.where("coalesce(author_cluster_id, '') <> '' AND coalesce(trim(author), '') <> ''").select(X.normalize_ar(F.trim("author")).alias("norm"), F.col("author_cluster_id").alias("cluster_id"), F.col("id").alias("ord"))
    last = named.groupBy("norm").agg(F.max_by("cluster_id", "ord").alias("cluster_id"))
    forced = named_merges.select(X.normalize_ar(F.col("variant")).alias("norm"), "cluster_id").dropDuplicates(["norm"])
    pins = last.join(forced, "norm", "left_anti").unionByName(forced)
    authority = clusters.join(pins.select("cluster_id").distinct(), "cluster_id", "left_semi").withColumns({c: X.clean(F.coalesce(F.col(c), F.lit(""))) for c in ("canonical_ar", "canonical_translit", "full_name", "dates", "category")})
    overrides = resolve.baseline_diff(fields.defaults(baseline, ROW_DEFAULTS), rows, list(OVERRIDABLE))
    return pins, authority, overrides, resolve.conflicts(named, "norm", "cluster_id", "ord")


def suggestions(rows: DataFrame, prior: DataFrame, new: DataFrame) -> DataFrame:
    """id, field, proposal of what machines have proposed, accumulated over harvests, for fields that still have a value. They tell of the
    curation and not of the catalogue, so a harvest adds to them and never replaces them."""
    return lexicon.live_suggestions(lexicon.merge_suggestions(prior, new), rows)


def name_groups(clusters: DataFrame, rows: DataFrame, common: tuple[str, ...] = (), given: tuple[str, ...] = (), common_arabic: tuple[str, ...] = ()) -> DataFrame:
    """Ranked candidate groups of clusters with their members' sample titles."""
    shown = F.coalesce(F.nullif("canonical_translit", F.lit("")), "full_name", F.lit(""))
    records = clusters.select(F.col("cluster_id").alias("id"), X.content_tokens(shown).alias("content"), X.ar_tokens(F.col("canonical_ar")).alias("arabic"), "full_name", "user_confirmed", "count")
    keyed = records.select("id", F.explode(candidates.keys(F.col("content"), F.col("arabic"), common, given, common_arabic)).alias("k")).select("id", "k.*")
    spelled = records.select("id", F.array_join("content", " ").alias("s")).where("s <> ''")
    near = candidates.neighbours(spelled, "s")
    pairs = near.join(spelled.select(F.col("id").alias("x"), F.col("s").alias("a")), "a").join(spelled.select(F.col("id").alias("y"), F.col("s").alias("b")), "b")
    spelling = pairs.select(F.explode(F.array("x", "y")).alias("id"), F.concat(F.lit("lev:"), F.least("x", "y"), F.lit("|"), F.greatest("x", "y")).alias("key"), F.lit("≈ spelling").alias("label")).distinct()
    ranked = candidates.rank(candidates.groups(keyed.unionByName(spelling.select("id", "key", "label"))), records)
    titles = resolve.first_k(rows.where("coalesce(title, '') <> '' AND coalesce(author_cluster_id, '') <> ''"), "author_cluster_id", "id", 4, "title")
    sampled = ranked.select(F.concat(F.lit("g"), F.array_join("members", "_")).alias("group_id"), F.explode("members").alias("author_cluster_id")).join(titles, "author_cluster_id", "left").groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct(F.col("author_cluster_id").alias("cluster_id"), F.col("titles").alias("sample_titles")))).alias("samples"))
    return ranked.withColumn("group_id", F.concat(F.lit("g"), F.array_join("members", "_"))).join(sampled, "group_id", "left")


def members(groups: DataFrame, clusters: DataFrame, rows: DataFrame) -> DataFrame:
    """group_id, place and the eleven fields that a group shows of each member (cluster_id, canonical_ar, canonical_translit,
    full_name, dates, count, user_confirmed, category, variants, sample_titles, authorities: their sources), those with
    the highest count first. groups: group_id and members."""
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    none = F.expr("cast(array() as array<string>)")
    titled = rows.where("coalesce(title, '') <> '' AND coalesce(author_cluster_id, '') <> ''")
    titles = resolve.first_k(titled, "author_cluster_id", "id", 4, "title").select(F.col("author_cluster_id").alias("cluster_id"), "titles")
    sources = F.transform(F.coalesce("authorities", F.expr("cast(array() as array<struct<source:string,title:string,url:string>>)")), lambda a: F.coalesce(a["source"], F.lit("")))
    shown = clusters.join(titles, "cluster_id", "left").select(
        "cluster_id", text("canonical_ar"), text("canonical_translit"), text("full_name"), text("dates"), F.coalesce("count", F.lit(0)).cast("long").alias("count"),
        F.coalesce("user_confirmed", F.lit(False)).alias("user_confirmed"), text("category"), F.coalesce("variants", none).alias("variants"), F.coalesce("titles", none).alias("sample_titles"),
        sources.alias("authorities"),
    )
    each = groups.select("group_id", F.explode("members").alias("cluster_id")).join(shown, "cluster_id")
    order = F.row_number().over(Window.partitionBy("group_id").orderBy(F.desc("count"), "cluster_id"))  # a group has few members
    return each.select("group_id", order.alias("place"), *shown.columns)


def audit_all(rows: DataFrame, clusters: DataFrame, merges: DataFrame | None = None) -> dict[str, DataFrame]:
    """The seven audits over rows and clusters outside the modern category. merges (variant): names whose merge was ruled, so the
    first audit doesn't raise them again."""
    modern = clusters.where("category = 'modern'").select(F.col("cluster_id").alias("author_cluster_id"))
    old = rows.join(modern, "author_cluster_id", "left_anti").withColumn("cluster_id", F.nullif("author_cluster_id", F.lit("")))
    kept = clusters.where("coalesce(category, '') <> 'modern'")
    title = X.normalize_ar(F.coalesce("title", F.lit("")))
    author = F.trim(F.coalesce("author", F.lit("")))
    written = old.where((author != "") & F.col("cluster_id").isNotNull()).select("cluster_id", author.alias("form")).distinct().withColumn("norm", X.normalize_ar(F.col("form")))
    settled = merges.select(X.normalize_ar(F.col("variant")).alias("norm")).distinct() if merges is not None else rows.sparkSession.createDataFrame([], "norm string")
    forms = audit.unsettled(written, settled, "norm").join(kept.select("cluster_id", F.coalesce("canonical_ar", F.lit("")).alias("canonical")), "cluster_id")
    rare = audit.rare(audit.token_df(old, F.transform(X.tokens(X.normalize_ar(author)), X.strip_article)))
    return {
        "over_merge": audit.over_merge(forms, rare), "conservation": audit.conservation(old), "under_merge": audit.under_merge(kept),
        "attribution": audit.attribution(old, title, "cluster_id"), "cote_conflict": audit.bundle_conflict(old, "archive", title, "cluster_id"),
        "case_drift": audit.case_drift(old), "title_forms": audit.title_forms(old, "title", X.fold_orthography(title)),
    }


def word_worklist(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Unsettled words of titles to fill, most frequent first, with eight occurrences each."""
    words = X.word_keys(F.coalesce("title", F.lit("")))
    known = lexicon.aligned(rows, words, X.tokens(F.coalesce("title_translit", F.lit("")))).select(F.col("l").alias("word")).unionByName(decisions.select(F.col("key").alias("word"))).distinct()
    known = saved(known)
    todo = rows.where("coalesce(trim(title), '') <> '' AND coalesce(trim(title_translit), '') = ''").where(X.has_arabic(F.col("title")))
    found = lexicon.unlocks(todo, words, known)
    seen = todo.select(F.explode(F.array_distinct(words)).alias("word"), "id").join(known, "word", "left_anti")
    # titles meet the occurrences that are shown, not every word of theirs
    first = saved(resolve.first_k(seen, "word", "id", 8, "id"))
    each = first.select("word", F.posexplode("ids").alias("pos", "id")).join(todo.select("id", F.struct("id", "title", "author").alias("occurrence")), "id")
    shown = each.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("pos", "occurrence"))).alias("xs")).select("word", F.transform("xs", lambda x: x["occurrence"]).alias("occurrences"))
    return found.join(first.select("word", "more"), "word").join(shown, "word").select("word", "titles", "unlocks", "occurrences", "more").orderBy(F.desc("titles"), "word")


def compose_titles(rows: DataFrame, clusters: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with composed transliterations, and (id, status, value) of every row that was to be filled.
    decisions: key, reading, varies."""
    words = X.word_keys(F.coalesce("title", F.lit("")))
    found = saved(lexicon.readings(lexicon.aligned(rows, words, X.tokens(F.coalesce("title_translit", F.lit(""))))))
    modern = clusters.where("category = 'modern'").select(F.col("cluster_id").alias("author_cluster_id"))
    todo = rows.where("coalesce(trim(title), '') <> '' AND coalesce(trim(title_translit), '') = ''").join(modern, "author_cluster_id", "left_anti")
    status = lexicon.compose(todo, words, lexicon.lexicon(found, decisions), found.where("contested"), decisions.where("varies").select("key").distinct())
    filled = rows.join(status.select("id", F.col("value").alias("__v")), "id", "left").withColumn("title_translit", F.coalesce("__v", "title_translit")).drop("__v")
    return filled, status


def composed_suggestions(status: DataFrame) -> DataFrame:
    """id, field, proposal of the titles that compose_titles composed, so that they stay apart from those written by hand."""
    return status.where("status = 'composed'").select("id", F.lit("title_translit").alias("field"), F.col("value").alias("proposal"))


def ingest(rows: DataFrame, decisions: DataFrame, word_decisions: DataFrame, clusters: DataFrame | None = None, scope: DataFrame | None = None) -> dict[str, DataFrame]:
    """What an export's decisions (with their ordinal) do, pass by pass: spelling, witness, attribution, homograph.

    rows and clusters after them; ledger, in which an edit that a later pass has undone is in quarantine; unconserved: those
    edits; suggestions: what was composed; keeps; stale: answers held back because their card changed; contested: keys still open, and varies: those ruled to
    depend on their context; overrides: readings that hold corpus-wide. scope: card, surface, id, if decisions don't list what they
    reach themselves. Each pass is saved, so none is worked out twice.
    """
    live, parked = adjudicate.live(decisions)
    of = lambda s: live.where(F.col("stratum") == s)
    folder, spark = scratch_dir(rows.sparkSession), rows.sparkSession

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    lists = ("rows", "scope.authors", "scope.titles", "scope.clusters")
    listed = [F.col(c) if c.split(".")[0] in decisions.columns else F.lit(None).cast("array<string>") for c in lists]
    more = ["n_titles"] if "n_titles" in decisions.columns else []
    ortho = of("ortho").select("ord", "id", "word", "target", "translit", "confidence", "row_scoped", "translit_source", *(c.alias(name) for c, name in zip(listed, ("rows", "authors", "title_scope", "clusters"), strict=True)), *more)
    ledgers, state, named = [], rows, None
    for stratum, step in (("ortho", lambda state: adjudicate.apply_ortho(state, ortho, scope)), ("witness", lambda state: adjudicate.apply_witness(state, of("witness"))), ("attribution", lambda state: adjudicate.apply_attribution(state, of("attribution")))):
        state, more = step(state)
        state = keep(state, stratum)
        ledgers.append(more)
    if clusters is not None:
        named, more = adjudicate.apply_ortho_names(clusters, ortho, scope)
        ledgers.append(more)
    overrides, settled = adjudicate.gates(adjudicate.reject_ortho(ortho))
    words = X.word_keys(F.coalesce("title", F.lit("")))
    found = lexicon.readings(lexicon.aligned(state, words, X.tokens(F.coalesce("title_translit", F.lit("")))))
    contested, varies = lexicon.states(found, word_decisions, settled)
    state, more = adjudicate.apply_homograph(state, of("homograph"), lexicon.lexicon(found, word_decisions, overrides))
    state = keep(state, "homograph")
    deferred = parked.where("disposition = 'deferred'").select("row", "id", "stratum", F.lit("deferred").alias("status"), F.col("note").alias("reason"), F.lit(False).alias("partial"))
    ledger = more.unionByName(deferred)
    for part in ledgers:
        ledger = ledger.unionByName(part)
    ledger = keep(ledger, "passes")
    faulty = keep(adjudicate.unconserved(state, ledger, ortho), "unconserved")
    ledger = ledger.unionByName(adjudicate.reverted(faulty))
    made = ledger.where("stratum = 'homograph' AND status = 'applied'").select(F.col("row").alias("id")).distinct()
    composed = state.join(made, "id", "left_semi").select("id", F.lit("title_translit").alias("field"), F.col("title_translit").alias("proposal"))
    stale = decisions.where("coalesce(stale, false)").select("id", "stratum") if "stale" in decisions.columns else decisions.select("id", "stratum").limit(0)
    return {"rows": state, "ledger": ledger, "unconserved": faulty, "suggestions": composed, "keeps": adjudicate.keeps(decisions), "stale": stale, "contested": contested, "varies": varies, "overrides": overrides} | ({"clusters": named} if named is not None else {})
