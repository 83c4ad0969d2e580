"""The read layer: key figures, author index, scholarship, search, facets, place headings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import textnorm as X


def without(rows: DataFrame, clusters: DataFrame, category: str = "modern", cluster: str = "cluster_id") -> DataFrame:
    return rows.join(clusters.where(F.col("category") == category).select(cluster), cluster, "left_anti")


def kpis(rows: DataFrame, library: str, city: str, cluster: str, status: str) -> DataFrame:
    """rows, distinct non-blank libraries and cities, authors with rows, published rows."""
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct(some(library)).alias("n_libraries"), F.count_distinct(some(city)).alias("n_cities"), F.count_distinct(cluster).alias("n_authors"), F.count_if(F.col(status) == "published").alias("n_published"))


def author_index(rows: DataFrame, clusters: DataFrame, query: str = "", with_metadata: bool = False, sort: str = "count", skip: tuple[str, ...] = (), cluster: str = "cluster_id") -> DataFrame:
    """Clusters with rows, searched, filtered and sorted by count, name or death year; blank names and
    unknown years come last. Names are in the order of the Unicode collation: accents and case count only between names that
    are alike without them."""
    counts = rows.groupBy(cluster).agg(F.count("*").alias("n"))
    out = clusters.join(counts, cluster).where((F.coalesce("category", F.lit("")) != "modern") & ~F.col(cluster).isin(*skip, ""))
    name = F.coalesce("full_name", "canonical_translit", F.lit(""))
    if query:
        out = out.where(F.contains(F.lower(F.concat_ws(" ", "canonical_ar", "canonical_translit", "full_name", "dates")), F.lit(query.lower())))
    if with_metadata:
        out = out.where((F.coalesce("full_name", F.lit("")) != "") | (F.coalesce("dates", F.lit("")) != ""))
    order = {"count": [F.desc("n")], "name": [(name == "").cast("int"), F.collate(name, "UNICODE")], "death": [X.death_year(F.col("dates"))]}[sort]
    return out.orderBy(*order, cluster)


def scholarship(rows: DataFrame, clusters: DataFrame, collectors: tuple[str, ...], cluster: str = "cluster_id") -> DataFrame:
    """Rows of modern clusters by whether their author collects."""
    modern = clusters.where("category = 'modern'").select(cluster)
    return rows.join(modern, cluster, "left_semi").groupBy(F.col(cluster).isin(*collectors, "").alias("collector")).agg(F.count("*").alias("n"))


def search(rows: DataFrame, query: str, columns: list[str], filters: dict[str, str] | None = None) -> DataFrame:
    """Rows whose columns, without marks and case, hold the query; filters are equalities."""
    for column, value in (filters or {}).items():
        rows = rows.where(F.col(column) == value)
    plain = lambda c: X.fold(X.strip_diacritics(c))
    return rows.where(F.contains(plain(F.concat_ws(" ", *columns)), plain(F.lit(query)))) if query else rows


def facets(rows: DataFrame, columns: list[str], chosen: dict[str, str]) -> DataFrame:
    """facet, value, n: the values of each column among rows that meet the choices in all others, in
    one pass over the rows."""
    meets = {c: F.col(c) == v for c, v in chosen.items()}

    def others(c: str):
        out = F.lit(True)
        for d, condition in meets.items():
            if d != c:
                out = out & condition
        return out

    each = F.array(*(F.when(others(c), F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))) for c in columns))
    return rows.select(F.explode(F.array_compact(each)).alias("f")).groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


def places(rows: DataFrame, city: str, library: str) -> DataFrame:
    """city, library, n, level (2 a library, 1 a city, 0 all), unknown places last."""
    rolled = rows.rollup(city, library).agg(F.count("*").alias("n"), F.grouping_id().alias("__g"))
    level = F.when(F.col("__g") == 0, 2).when(F.col("__g") == 1, 1).otherwise(0)
    return rolled.withColumn("level", level).drop("__g").orderBy(F.coalesce(F.col(city) == "", F.lit(False)), city, "level", library)


def permalink(clusters: DataFrame, key: str, cluster: str = "cluster_id") -> DataFrame:
    return clusters.where((F.col(cluster) == key) | (F.col("canonical_translit") == key))
