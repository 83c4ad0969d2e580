"""Command line: python -m lamina.cli COMMAND INPUT ...; previews unless --write is given.

INPUT is the corpus document, but for extract (a JSON file with a cell of page, table, row, col, text on each line),
cluster (raw rows, one on each line) and export (the folder that cards were written to).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import textnorm as X
from lamina.operators import fields, lexicon
from lamina.plans import jobs
from lamina.sources import documents as D


def _corpus(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    doc = D.document(spark, path, D.CORPUS)
    return D.items(doc, "rows").drop("ord"), D.items(doc, "clusters").drop("ord")


def _words(spark: SparkSession, path: str | None) -> DataFrame:
    rows = D.entries(D.document(spark, path or "/nowhere", D.WORDS, optional=True), "words", "word")
    return rows.select(X.normalize_ar(F.col("word")).alias("key"), F.when(F.col("decided"), F.col("translit")).alias("reading"), F.coalesce("varies", F.lit(False)).alias("varies"))


def _shown(spark: SparkSession, path: str | None) -> dict[str, str]:
    """A table of names and how they are shown, as long as people write one."""
    return {r["raw"]: r["shown"] for r in D.csv_worklists(spark, path).select("raw", "shown").collect()} if path else {}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("command", choices=("extract", "cluster", "harvest", "audit", "groups", "words", "compose", "cards", "export", "ingest", "provenance"))
    parser.add_argument("corpus")
    parser.add_argument("--decisions", help="word decisions, or for ingest the export")
    parser.add_argument("--words", help="word decisions for ingest")
    parser.add_argument("--task", default="translit-adjudication")
    parser.add_argument("--field", default="title_translit")
    parser.add_argument("--proposals", help="JSON with machine_suggestions, for provenance")
    parser.add_argument("--captions", default="", help="captions of header cells, separated by |, for extract")
    parser.add_argument("--authority", help="authorities of earlier harvests, for cluster")
    parser.add_argument("--baseline", help="the corpus as it was built, for harvest")
    parser.add_argument("--merges", help="CSV of variant, cluster_id, for harvest and audit")
    parser.add_argument("--cities", help="CSV of raw, shown, for cluster")
    parser.add_argument("--libraries", help="CSV of raw, shown, for cluster")
    parser.add_argument("--roles", help="CSV of raw, shown, for cluster")
    parser.add_argument("--curated", help="CSV of name, translit, for cluster")
    parser.add_argument("--hand", help="cards written by hand, a JSON object a line, for cards")
    parser.add_argument("--witnesses", help="corrections of single rows, a JSON object a line, for cards")
    parser.add_argument("--marks", help="marks at which a tail begins, a JSON object a line, for cards")
    parser.add_argument("--answers", help="what annotators answered, a JSON object a line, for export")
    parser.add_argument("--json", action="store_true", help="print JSON lines")
    parser.add_argument("--list", action="store_true", help="provenance of each row too")
    parser.add_argument("--write", metavar="FOLDER")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    bad = 0
    if args.command == "extract":
        found = jobs.extract(spark.read.schema("page int, table int, row int, col int, text string").json(args.corpus), tuple(filter(None, args.captions.split("|"))))
        return _out({"rows": found, "stats": fields.extraction_stats(found)}, args)
    if args.command == "cluster":
        known = D.document(spark, args.authority or "/nowhere", D.AUTHORITIES, optional=True)
        pins = D.entries(known, "variant_to_cluster", "variant").select(X.normalize_ar(F.col("variant")).alias("norm"), F.col("value").alias("cluster_id"))
        overrides = D.entries(known, "row_overrides", "id").select("id", F.col("value").alias("values"))
        curated = D.csv_worklists(spark, args.curated).select("name", "translit") if args.curated else spark.createDataFrame([], "name string, translit string")
        places = (_shown(spark, p) for p in (args.cities, args.libraries, args.roles))
        built = jobs.build(spark.read.schema(D.RAW_ROWS).json(args.corpus), pins, D.entries(known, "clusters", "cluster_id"), overrides, curated, *places)
        return _out(dict(zip(("rows", "clusters", "detached"), built, strict=True)), args)
    if args.command == "export":
        made = D.read_tables(spark, args.corpus, "ortho", "homograph", "witness", "attribution", "scope")
        return _out(jobs.export(made, spark.read.json(args.answers)), args)
    rows, clusters = _corpus(spark, args.corpus)
    given = lexicon.suggestion_entries(D.document(spark, args.corpus, D.CORPUS))
    prior = lexicon.suggestion_entries(D.document(spark, args.authority or "/nowhere", D.AUTHORITIES, optional=True))
    if args.command == "harvest":
        merges = D.csv_worklists(spark, args.merges) if args.merges else spark.createDataFrame([], "variant string, cluster_id string")
        found = jobs.harvest(rows, clusters, _corpus(spark, args.baseline)[0], merges)
        out = dict(zip(("pins", "authority", "overrides", "conflicts"), found, strict=True))
        return _out(out | {"suggestions": jobs.suggestions(rows, prior, given)}, args)
    if args.command == "cards":
        kept = D.entries(D.document(spark, args.decisions or "/nowhere", D.KEEPS, optional=True), "keeps", "id").select("id")
        lines = lambda path, schema: spark.read.schema(schema).json(path) if path else None
        by_hand = (lines(args.hand, jobs.HAND), lines(args.witnesses, jobs.WITNESSES), lines(args.marks, jobs.MARKS))
        return _out(jobs.cards(rows, clusters, kept, _words(spark, args.words), None, *by_hand), args)
    if args.command == "audit":
        out = jobs.audit_all(rows, clusters, D.csv_worklists(spark, args.merges) if args.merges else None)
    elif args.command == "groups":
        groups = jobs.name_groups(clusters, rows)
        out = {"groups": groups, "members": jobs.members(groups, clusters, rows)}
    elif args.command == "words":
        out = {"words": jobs.word_worklist(rows, _words(spark, args.decisions))}
    elif args.command == "compose":
        filled, status = jobs.compose_titles(rows, clusters, _words(spark, args.decisions))
        out = {"rows": filled, "status": status, "suggestions": jobs.suggestions(filled, given, jobs.composed_suggestions(status))}
    elif args.command == "ingest":
        out = jobs.ingest(rows, D.decisions(spark, args.decisions, args.task), _words(spark, args.words), clusters)
        out["suggestions"] = jobs.suggestions(out["rows"], given, out["suggestions"])
        bad = int(not out["ledger"].where("status = 'quarantine'").isEmpty())
    else:
        proposed = D.document(spark, args.proposals, D.AUTHORITIES).select(F.explode("machine_suggestions").alias("id", "values")).select("id", F.try_element_at("values", F.lit(args.field)).alias("proposal"))
        met = rows.join(proposed, "id", "left")
        out = {"provenance": lexicon.provenance(met, args.field, "proposal")}
        if args.list:
            filled = met.where(F.trim(F.coalesce(args.field, F.lit(""))) != "")
            out["rows"] = filled.select("id", lexicon.classify(F.trim(args.field), F.col("proposal")).alias("verdict"), F.trim(args.field).alias("value"), "proposal")
    return _out(out, args, bad)


def _out(found: dict[str, DataFrame], args: argparse.Namespace, bad: int = 0) -> int:
    """Writes the results, prints them as JSON lines, or shows the first of each."""
    for name, df in found.items():
        if args.write:
            D.write_version(df, f"{args.write}/{name}")
        elif args.json:
            for line in df.select(F.to_json(F.struct(F.lit(name).alias("table"), "*")).alias("line")).toLocalIterator():
                print(line["line"])
        else:
            df.show(20, truncate=60)
    return bad


if __name__ == "__main__":
    sys.exit(main())
