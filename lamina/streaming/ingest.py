"""Decisions applied as they come: a keyed, stateful stream that gives what one run over the whole export gives.

The state of a row is the set of all decisions on it, by stratum, ordinal and id, as a streaming aggregate. In each batch the rows that
it reaches meet their decisions so far, and all are folded over the row as it was, spelling first, then witnesses, then attributions, each in the order of
the ordinals. So it doesn't matter how an export is split, in which order its parts come, and how often one is replayed. What is
sent on is the row as it stands, its ledger and how many decisions went into it: of a row's versions the one with the
most holds. The table of rows stays as it was while the stream lives. The homograph pass needs the lexicon of all rows and stays a job.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.operators import adjudicate

FIELDS = ("title", "title_translit", "author", "catalog_note", "discrepancy_note")
LEDGER = "array<struct<id:string,stratum:string,status:string,reason:string,partial:boolean>>"
VERSIONS = f"row string, version bigint, known boolean, {', '.join(f'{c} string' for c in FIELDS)}, ledger {LEDGER}"
STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def placed(decisions: DataFrame) -> DataFrame:
    """row, place and decision (JSON) of each row that a resolved decision of the three strata reaches. Works on tables and streams."""
    live, _ = adjudicate.live(decisions)
    none = F.expr("cast(array() as array<string>)")
    judged = adjudicate.reject_ortho(live.where("stratum = 'ortho'").withColumn("title_scope", F.col("scope.titles"))).where("reason IS NULL AND target <> word")
    one = lambda row, surface: F.struct(row.alias("row"), F.lit(surface).alias("surface"))
    reached = F.concat(F.transform(F.coalesce("rows", none), lambda r: one(r, "title")), F.transform(F.coalesce(F.col("scope.authors"), none), lambda r: one(r, "author")))
    ortho = judged.select("stratum", "ord", "id", F.explode(reached).alias("at"), F.struct("ord", "id", "word", "target", "translit").alias("d"))
    body = F.to_json(F.struct("d.*", F.col("at.surface").alias("surface")))
    ortho = ortho.select(F.col("at.row").alias("row"), "stratum", "ord", "id", F.col("at.surface").alias("surface"), body.alias("decision"))
    own = F.struct("ord", "id", "action", "was", "target", "target_translit", "tail", "tail_translit", "aligned")
    rest = live.where("stratum IN ('witness', 'attribution')").select(F.coalesce("row", "id").alias("row"), "stratum", "ord", "id", F.lit("").alias("surface"), F.to_json(own).alias("decision"))
    both = ortho.unionByName(rest)
    return both.select("row", F.concat_ws("|", "stratum", F.format_string("%012d", "ord"), "id", "surface").alias("place"), "stratum", "decision")


_FOLDS = (("ortho", adjudicate._fold_ortho), ("witness", adjudicate._fold_witness), ("attribution", adjudicate._fold_attribution))
_MISSING = ("action", "was", "target", "target_translit", "tail", "tail_translit", "aligned")


def fold(own: dict, decisions: list[tuple[str, dict]]) -> tuple[dict, list[tuple]]:
    """A row's fields after decisions (place, decision), and the ledger."""
    ledger: list[tuple] = []
    for stratum, over in _FOLDS:
        mine = [d for place, d in sorted(decisions, key=lambda x: x[0]) if place.split("|")[0] == stratum]
        if mine:
            mine = [{c: d.get(c) for c in _MISSING} | d for d in mine]
            fresh, more = over(dict(own), sorted(mine, key=lambda d: d["ord"]))
            own, ledger = own | fresh, ledger + more
    return own, ledger


def _version(row: str, known: bool, own: dict, taken: list[dict]) -> dict:
    """The row as it stands after all decisions taken so far (place and JSON), and their ledger; of different ones for one place the least counts."""
    every = [(place, json.loads(body)) for place, body in {d["place"]: d["decision"] for d in sorted(taken, key=lambda d: d["decision"], reverse=True)}.items()]
    if known:
        own, ledger = fold(own, every)
    else:
        ledger = [(d["id"], place.split("|")[0], "quarantine", "no such row", False) for place, d in sorted(every, key=lambda x: x[0])]
    entries = [dict(zip(("id", "stratum", "status", "reason", "partial"), x, strict=True)) for x in ledger]
    return {"row": row, "version": len(taken), "known": known} | {c: own[c] for c in FIELDS} | {"ledger": entries}


_ENTRY = pa.struct([(c, pa.bool_() if c == "partial" else pa.string()) for c in ("id", "stratum", "status", "reason", "partial")])
_VERSION = pa.schema([("row", pa.string()), ("version", pa.int64()), ("known", pa.bool_()), *((c, pa.string()) for c in FIELDS), ("ledger", pa.list_(_ENTRY))])


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500).to_pylist()
            yield pa.RecordBatch.from_pylist([_version(r["row"], r["known"], {c: r[c] for c in FIELDS}, r["taken"]) for r in part], schema=_VERSION)


def versions(decisions: DataFrame, rows: DataFrame) -> DataFrame:
    """A stream of rows as they stand (VERSIONS) from a stream of decisions and the table of rows. A row that is reached again by what it has
    taken already gives its version again."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in rows.columns else F.lit("")
    own = rows.select(F.col("id").alias("row"), F.lit(True).alias("known"), *(text(c).alias(c) for c in FIELDS))
    taken = placed(decisions).groupBy("row").agg(F.collect_set(F.struct("place", "decision")).alias("taken"))
    met = taken.join(own, "row", "left").select("row", F.coalesce("known", F.lit(False)).alias("known"), *(F.coalesce(c, F.lit("")).alias(c) for c in FIELDS), "taken")
    return met.mapInArrow(_versions, VERSIONS)


def dealt(df: DataFrame, key: str, folder: str, name: str | None = None) -> DataFrame:
    """df saved below the folder by the hash of its key, in as many buckets as shuffles have partitions, and read again: what is grouped by that key or meets
    by it isn't shuffled. name: a table that each call adds to and that the
    caller drops from the catalog."""
    spark = df.sparkSession
    table = name or f"lamina_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.mode("append").bucketBy(buckets, key).option("path", folder).option("compression", "zstd").format("parquet").saveAsTable(table)
    found = spark.table(table)
    if name is None:  # the files stay, and what is read of them
        spark.sql(f"DROP TABLE {table}")
    return found


def current(rows: DataFrame, made: DataFrame, entries: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows after the decisions that have come so far, and their ledger, from all versions that a stream has given. entries: a column of the rows for their
    own ledger, null for none, so that who wants both needs no join of them. Of rows that have a version only what that lacks is read."""
    own = [c for c in FIELDS if c in rows.columns]
    wide = [*own, "ledger"] if entries else own
    known = made.where("known").withColumnRenamed("row", "id")
    last = known.groupBy("id").agg(F.max_by(F.struct(*wide), "version").alias("__v"))
    more = {entries: F.col("__v.ledger")} if entries else {}
    fields = [F.col(f"__v.{c}").alias(c) if c in own else F.col(c) for c in rows.columns]
    touched = rows.select(*(c for c in rows.columns if c not in own)).join(last, "id").select(*fields, *(c.alias(name) for name, c in more.items()))
    rest = rows.join(known.select("id").distinct(), "id", "left_anti").select(*rows.columns, *(F.lit(None).cast(LEDGER).alias(name) for name in more))
    ledger = made.groupBy("row").agg(F.max_by("ledger", "version").alias("ledger"))
    return touched.unionByName(rest), ledger.select("row", F.explode("ledger").alias("l")).select("row", "l.*")
