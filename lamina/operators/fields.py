"""Field repair for raw catalogue rows: fill-down, shelfmarks, places, authors, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import textnorm as X
from lamina.operators.graph import scratch_dir

# Patterns of folio marks, extents and shelfmark classes.
_MARK = r"\b(?:fols?|ff?|pp?)\."
_FOLIO = rf"(?iU){_MARK}\s*,?\s*(?=\d)"
_EXTENT = r"(?iU)^\d+\s+(?:folios?|ff?\.?|pages?)\b"
_PAREN = r"\(\s*\d+\s*(?:vols?|tomes?|pages?|folios?|ff?)\b[^)]*\)"
_CLASS = r"(?iuU)^(?:arabe|syriaque|syr|persan|h[eé]breu|turc|copte)\b"


def fill_down(rows: DataFrame, order: str, city: str = "city", library: str = "library", partition: str | None = None) -> DataFrame:
    """Carries the last city and library down; a row that names another city starts without library.

    With a partition (volume, file) each is filled by itself, in one task. Without one, rows are ranged and saved; each
    range is filled by itself, and what the ones before hand on to it is worked out from a row for each range.
    """
    value = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    by, carried = partition, rows.withColumns({"__c": F.lit(None).cast("string"), "__l": F.lit(None).cast("string")})
    if partition is None:
        by, ranged = "__p", _ranged(rows, [order])
        carried = ranged.join(F.broadcast(_handed(ranged, order, value(city), value(library))), "__p")  # a row a range
    w = Window.partitionBy(by).orderBy(order)
    filled = carried.withColumn("__city", F.coalesce(F.last(value(city), True).over(w), "__c"))
    before = F.when(F.row_number().over(w) == 1, F.col("__c")).otherwise(F.lag("__city").over(w))
    turned = F.when(~F.col("__city").eqNullSafe(before), 1).otherwise(0)
    run = filled.withColumn("__turn", turned).withColumn("__run", F.sum("__turn").over(w))
    in_run = Window.partitionBy(by, "__run").orderBy(order)
    lib = F.coalesce(F.last(value(library), True).over(in_run), F.when(F.col("__run") == 0, F.col("__l")), F.lit(""))
    return run.withColumn(library, lib).withColumn(city, F.coalesce("__city", F.lit(""))).select(*rows.columns)


def _handed(ranged: DataFrame, order: str, city: Column, library: Column) -> DataFrame:
    """__p, __c, __l: the city and the library that hold where each range begins."""
    w = Window.partitionBy("__p").orderBy(order)
    local = ranged.select("__p", order, city.alias("named"), library.alias("lib")).withColumn("c", F.last("named", True).over(w))
    runs = local.withColumn("run", F.sum(F.when(~F.col("c").eqNullSafe(F.lag("c").over(w)), 1).otherwise(0)).over(w))
    at = F.struct(order, "lib")
    per = runs.groupBy("__p", "run").agg(F.first("c", True).alias("c"), F.max(F.when(F.col("lib").isNotNull(), at)).alias("lib"))
    ends = per.groupBy("__p").agg(F.min(F.when(F.col("c").isNotNull(), F.col("run"))).alias("first"), F.max("run").alias("last"), F.max_by("c", "run").alias("city"), F.min_by("c", F.when(F.col("c").isNotNull(), F.col("run"))).alias("named"), F.max_by("lib.lib", "run").alias("lib"), F.max(F.when(F.col("c").isNull(), F.col("lib.lib"))).alias("before"))
    out, c, lib = [], None, None
    for r in sorted(ends.collect(), key=lambda r: r["__p"]):  # a row a range
        out.append((r["__p"], c, lib))
        ahead = r["before"] or lib
        if r["first"] is None:
            lib = ahead
        elif r["first"] == r["last"]:
            c, lib = r["city"], r["lib"] or (ahead if r["named"] == c else None)
        else:
            c, lib = r["city"], r["lib"]
    return ranged.sparkSession.createDataFrame(out, "__p int, __c string, __l string")


def clean_shelfmark(c: Column) -> Column:
    s = X.squeeze(F.coalesce(c, F.lit("")))
    s = F.regexp_replace(s, r"(?U),(?=\S)", ", ")
    s = F.regexp_replace(s, r"(?U)(?<=\w)\s*-\s*(?=\w)", "-")
    s = F.regexp_replace(s, r"(?U)([A-Za-zÀ-ÿ]{3,})(\d)", "$1 $2")
    for mark in ("fols", "fol", "ff", "f", "pp", "p"):  # a replacement can't change case
        s = F.regexp_replace(s, rf"(?iU)\b{mark}\.", f"{mark}.")
    return F.trim(F.regexp_replace(s, rf"(?iU)({_MARK})\s*,\s*", "$1"))


def split_shelfmark(c: Column) -> Column:
    """struct<shelfmark, folios>."""
    s = clean_shelfmark(c)
    part = lambda mark, folios: F.struct(mark.alias("shelfmark"), folios.alias("folios"))
    end = lambda x: F.trim(F.regexp_replace(x, "[ ,;]+$", ""))
    before = lambda x, at: F.substr(x, F.lit(1), at - 1)
    tail_at = F.regexp_instr(s, F.lit(rf"(?iU){_PAREN}\s*$"))
    head, extent = end(before(s, tail_at)), F.trim(F.substr(s, tail_at))
    inner, mark = F.regexp_instr(head, F.lit(_FOLIO)), F.regexp_instr(s, F.lit(_FOLIO))
    none = F.lit("")
    return (
        F.when(s == "", part(none, none))
        .when(s.rlike(_EXTENT) | (F.trim(F.regexp_replace(s, rf"(?iU){_PAREN}", "")) == ""), part(none, s))
        .when((tail_at > 0) & (inner > 0), part(end(before(head, inner)), F.concat_ws(" ", F.trim(F.substr(head, inner)), extent)))
        .when(tail_at > 0, part(head, extent))
        .when(mark > 0, part(end(before(s, mark)), F.trim(F.substr(s, mark))))
        .otherwise(part(s, none))
    )


def display(c: Column, table: dict[str, str]) -> Column:
    return X.mapped(c, table)


def unmapped(rows: DataFrame, column: str, table: dict[str, str], known: tuple[str, ...] = ()) -> DataFrame:
    """Distinct values of a place column that no table knows."""
    return rows.select(F.trim(column).alias("place")).where(~F.col("place").isin("", *table, *known)).distinct()


def normalize_rows(rows: DataFrame, cities: dict[str, str], libraries: dict[str, str], class_city: str = "Paris", class_library: str = "Bibliothèque Nationale de France") -> DataFrame:
    """Raw rows with readable places, split shelfmarks and clean titles and authors. A shelfmark class
    decides the library only where that is blank or already the national one."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    author = X.blank_placeholder(X.strip_orphan_marks(text("author")))
    split = split_shelfmark(F.col("shelfmark_raw"))
    held = split["shelfmark"].rlike(_CLASS) & text("library").isin("", "BN")
    return rows.withColumns({
        "shelfmark": split["shelfmark"], "folios": split["folios"],
        "title": X.space_letters_digits(X.strip_orphan_marks(text("title"))),
        "author": F.when((author != "") & ~X.has_arabic(author), X.latin_author(author)).otherwise(author),
        "city": F.when(held, class_city).otherwise(display(F.coalesce("city", F.lit("")), cities)),
        "library": F.when(held, class_library).otherwise(display(F.coalesce("library", F.lit("")), libraries)),
    }).drop("shelfmark_raw")


def defaults(rows: DataFrame, values: dict[str, str]) -> DataFrame:
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in rows.columns else F.lit(v) for c, v in values.items()})


def without_blank(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of which at least one of the columns isn't blank."""
    return rows.where(F.trim(F.concat_ws("", *(F.trim(F.coalesce(F.col(c), F.lit(""))) for c in columns))) != "")


def extraction_stats(rows: DataFrame) -> DataFrame:
    """One row: n_rows, rows without an author, distinct cities and libraries that aren't blank."""
    some = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(some("author").isNull()).alias("n_blank_authors"), F.count_distinct(some("city")).alias("n_cities"), F.count_distinct(some("library")).alias("n_libraries"))


def _ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows ranged over partitions by the order and saved with the number of their range, __p."""
    spark, folder = rows.sparkSession, scratch_dir(rows.sparkSession)
    rows.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()).write.parquet(folder)
    return spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("__p", T.IntegerType())])).parquet(folder)


def number(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Adds 1, 2, ... in the given order without one task that sees all rows. Rows are ranged over
    partitions and saved with their range, since ranges are drawn anew each time they are worked out;
    then counted and numbered within each. Equal rows are numbered in any order."""
    placed = _ranged(rows, order)
    counts = {r["__p"]: r["n"] for r in placed.groupBy("__p").agg(F.count("*").alias("n")).collect()}  # a row a partition
    offset, offsets = 0, []
    for p in sorted(counts):
        offsets += [F.lit(p), F.lit(offset)]
        offset += counts[p]
    w = Window.partitionBy("__p").orderBy(*order)
    base = F.element_at(F.create_map(*offsets), F.col("__p")) if offsets else F.lit(0)
    return placed.withColumn(name, (F.row_number().over(w) + base).cast("long")).drop("__p")


def mint_row_ids(rows: DataFrame, order: list[str]) -> DataFrame:
    return number(rows, "__n", order).withColumn("id", F.format_string("r%04d", F.col("__n"))).drop("__n")
