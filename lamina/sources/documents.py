"""Sources and sinks: JSON documents with explicit schemas, CSV worklists, cells, versioned writes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The fields of the documents.
_AUTHORITY = "array<struct<source:string,title:string,url:string>>"
ROW_COLUMNS = ("id", "page", "city", "library", "shelfmark", "folios", "title", "title_translit", "title_translation", "author", "author_translit", "author_translation", "catalog_note", "archive", "author_cluster_id", "pub_status", "pub_citation", "pub_source", "work_url", "discrepancy_note")
_ROW = ",".join(f"{c}:{'int' if c == 'page' else 'string'}" for c in ROW_COLUMNS)
_CLUSTER = f"cluster_id:string,canonical_ar:string,canonical_translit:string,full_name:string,dates:string,category:string,variants:array<string>,count:bigint,confidence:double,user_confirmed:boolean,authorities:{_AUTHORITY}"
#: Schemas are given, never inferred: an object used as a map would become a struct with a field a key.
CORPUS = f"rows array<struct<{_ROW}>>, clusters array<struct<{_CLUSTER}>>, machine_suggestions map<string,map<string,string>>"
RAW_ROWS = "id string, page int, city string, library string, shelfmark_raw string, title string, author string, archive string"
WORDS = "schema_version int, annotated_date string, source string, counts map<string,int>, words map<string,struct<translit:string,varies:boolean,decided:boolean>>"
KEEPS = "schema_version int, updated string, keeps map<string,struct<stratum:string,word:string,row:string,kept:string,note:string>>"
AUTHORITIES = f"source string, clusters map<string,struct<{_CLUSTER.split(',', 1)[1]}>>, variant_to_cluster map<string,string>, row_overrides map<string,map<string,string>>, machine_suggestions map<string,map<string,string>>"
_DECISION = "id:string,stratum:string,disposition:string,note:string,word:string,target:string,translit:string,translit_source:string,confidence:string,rows:array<string>,row_scoped:boolean,scope:struct<titles:array<string>,authors:array<string>,clusters:array<string>>,row:string,action:string,was:string,tail:string,tail_translit:string,target_translit:string,aligned:boolean,readings:map<string,string>,fp:string,done:boolean,stale:boolean"
DECISIONS = f"task string, annotator string, annotated_date string, decisions array<struct<{_DECISION}>>"


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def document(spark: SparkSession, path: str, schema: str, optional: bool = False) -> DataFrame:
    """A JSON document (or a folder of them) as a row each. A missing one is empty if optional, else an
    error, as is one that isn't JSON."""
    if not _exists(spark, path):
        if optional:
            return spark.createDataFrame([], schema)
        raise FileNotFoundError(path)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def items(doc: DataFrame, field: str) -> DataFrame:
    """The entries of an array of structs with their ordinal."""
    return doc.select(F.posexplode(field).alias("ord", "__x")).select("ord", "__x.*")


def entries(doc: DataFrame, field: str, key: str = "key") -> DataFrame:
    """The entries of a map; struct values become columns."""
    out = doc.select(F.explode(field).alias(key, "value"))
    return out.select(key, "value.*") if out.schema["value"].dataType.typeName() == "struct" else out


def decisions(spark: SparkSession, path: str, task: str) -> DataFrame:
    """An export's decisions with their ordinal; an export for another task is refused."""
    doc = document(spark, path, DECISIONS)
    if other := doc.where(~F.col("task").eqNullSafe(F.lit(task))).select("task").first():
        raise ValueError(f"the export is for {other[0]}, not for {task}")
    return items(doc, "decisions")


def csv_worklists(spark: SparkSession, *paths: str) -> DataFrame:
    """Header CSVs with quoted commas, by name; columns that one lacks are null."""
    out = None
    for path in paths:
        one = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def cells(chars: DataFrame, boxes: DataFrame) -> DataFrame:
    """Text of each cell from placed characters: chars (page, x0, x1, top, bottom, c) whose middle is in
    a box (page, cell, x0, x1, top, bottom, half a unit of slack) in reading order; a jump of over two
    units starts a line, lines are joined by a space. Characters meet boxes of their page in a join on
    page and band of ten units, so it is no cross join."""
    c = chars.select("page", "c", F.col("x0").alias("cx0"), ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("top") + F.col("bottom")) / 2).alias("cy"), F.col("top").alias("ctop")).withColumn("band", F.floor(F.col("cy") / 10))
    b = boxes.select("*", F.explode(F.sequence(F.floor((F.col("top") - 0.5) / 10), F.floor((F.col("bottom") + 0.5) / 10))).alias("band"))
    inside = F.col("cx").between(F.col("x0") - 0.5, F.col("x1") + 0.5) & F.col("cy").between(F.col("top") - 0.5, F.col("bottom") + 0.5)
    met = c.join(b, ["page", "band"]).where(inside)
    w = Window.partitionBy("page", "cell").orderBy(F.round("ctop"), "cx0")
    jump = F.coalesce((F.col("ctop") - F.lag("ctop").over(w) > 2).cast("int"), F.lit(0))
    lined = met.withColumn("__j", jump).withColumn("line", F.sum("__j").over(w))
    lines = lined.groupBy("page", "cell", "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.round("ctop").alias("r"), "cx0", "c"))), lambda x: x["c"]), "").alias("text"))
    return lines.groupBy("page", "cell").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), " ").alias("text"))


def header(cells_: Column, captions: tuple[str, ...], least: int = 3) -> Column:
    return F.size(F.array_intersect(cells_, F.array(*map(F.lit, captions)))) >= least


def table_rows(cells_: DataFrame, columns: tuple[int, ...] = (0, 3, 6, 9, 12, 15), width: int = 16) -> DataFrame:
    """cells (page, table, row, col, text) as rows of their logical columns; narrower rows are skipped."""
    wide = cells_.groupBy("page", "table", "row").agg(F.max("col").alias("last"), *(F.max(F.when(F.col("col") == c, F.col("text"))).alias(f"c{i}") for i, c in enumerate(columns)))
    return wide.where(F.col("last") >= width - 1).drop("last")


def write_version(df: DataFrame, folder: str) -> str:
    """Writes a new version and then points `CURRENT` at it by one rename, so a reader never sees half of one
    or none, and a failed write leaves the last good one; the versions before stay as backups."""
    spark = df.sparkSession
    version = f"v{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{folder}/{version}")
    jvm = spark.sparkContext._jvm
    path = lambda x: jvm.org.apache.hadoop.fs.Path(f"{folder}/{x}")
    fs = path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path(f"CURRENT.{version}"), True)
    out.writeBytes(version)
    out.close()
    # one step, so a reader finds the version before or this one
    overwrite = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    overwrite[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(path(f"CURRENT.{version}"), path("CURRENT"), overwrite)
    return version


def read_version(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    return spark.read.parquet(f"{folder}/{version or spark.read.text(f'{folder}/CURRENT').first()[0]}")


def snapshot(df: DataFrame, folder: str, date: str) -> None:
    """A dated backup; one that is there is left alone."""
    df.write.mode("ignore").parquet(f"{folder}/{date}-pre-adjudication")


def write_json(df: DataFrame, path: str) -> None:
    """A JSON object a line, in files of a folder."""
    df.write.mode("overwrite").json(path)


def read_tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """The current version of each named table below a folder."""
    return {name: read_version(spark, f"{folder}/{name}") for name in names}


def script_safe(payload: Column) -> Column:
    """JSON of a payload that can stand inside a script element."""
    return F.replace(F.to_json(payload), F.lit("</"), F.lit("<\\/"))
