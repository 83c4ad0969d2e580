"""Search over an inverted index of three-letter runs.

build() writes the texts, each row's runs of three characters sorted by run, and how many rows each run has. find()
looks up the query's runs, reads the postings of its rarest ones only (a few files, of which row groups are skipped by the run),
keeps the rows that have all of them, and verifies those on their texts. Queries of under three characters scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import textnorm as X

#: Files that runs and texts are dealt to; the runs of a query whose postings are read.
BUCKETS, RAREST = 64, 6
#: Where each of a query's runs is in more rows, all texts are looked through: that costs less than to bring so many together with theirs.
WIDE = 100_000


def plain(c: Column) -> Column:
    """A text without marks and case, as the search compares it."""
    return X.fold(X.strip_diacritics(c))


def _bucket(c: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key and run, each once a row, of rows (key, text)."""
    from lamina.llm import _common as C

    for batch in C.slices(batches):
        points = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in batch.column(1).to_pylist()]
        sizes = np.array([len(p) for p in points], np.int64)
        point = np.concatenate([*points, np.zeros(2, np.uint32)]).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        at = np.flatnonzero(np.arange(len(row)) + 3 <= np.cumsum(sizes)[row])
        run, known = pd.factorize((point[at] << 42) | (point[at + 1] << 21) | point[at + 2])
        texts = pa.array([chr(c >> 42) + chr(c >> 21 & 0x1FFFFF) + chr(c & 0x1FFFFF) for c in known.tolist()], pa.string())
        each = pd.unique(row[at] * max(1, len(known)) + run)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(each // max(1, len(known)))), texts.take(pa.array(each % max(1, len(known))))], names=["key", "run"])


def build(rows: DataFrame, columns: list[str], path: str, key: str = "id", buckets: int = BUCKETS) -> None:
    """Writes an index of the columns of rows, told apart by a key."""
    texts = rows.select(F.col(key).alias("key"), plain(F.concat_ws(" ", *columns)).alias("text"))
    texts.withColumn("bucket", _bucket("key", buckets)).repartition(buckets, "bucket").sortWithinPartitions("bucket", "key").write.partitionBy("bucket").mode("errorifexists").parquet(f"{path}/texts")
    saved = rows.sparkSession.read.parquet(f"{path}/texts")
    runs = saved.select("key", "text").mapInArrow(_runs, T.StructType([saved.schema["key"], T.StructField("run", T.StringType())]))
    dealt = runs.withColumn("bucket", _bucket("run", buckets)).repartitionByRange("bucket", "run", "key").sortWithinPartitions("bucket", "run", "key")
    dealt.write.partitionBy("bucket").option("parquet.block.size", str(4 << 20)).parquet(f"{path}/runs")
    counted = rows.sparkSession.read.parquet(f"{path}/runs").groupBy("bucket", "run").agg(F.count("*").alias("n"))
    counted.repartition("bucket").sortWithinPartitions("run").write.partitionBy("bucket").parquet(f"{path}/counts")


def _runs_of(spark: SparkSession, query: str, buckets: int) -> list[tuple[str, int]]:
    text = spark.createDataFrame([(query,)], "q string").select(plain(F.col("q")).alias("q")).first()["q"]
    one = spark.createDataFrame([(r,) for r in sorted({text[k : k + 3] for k in range(len(text) - 2)})], "run string")
    return [(r["run"], r["b"]) for r in one.select("run", _bucket("run", buckets).alias("b")).collect()]  # the query's own


def _rarest(spark: SparkSession, path: str, query: str, buckets: int) -> list | None:
    """run, bucket and n of the query's rarest runs, the rarest first; None if it has none, no rows if one of them is in no row."""
    runs = _runs_of(spark, query, buckets)
    if not runs:
        return None
    here = F.col("bucket").isin([b for _, b in runs]) & F.col("run").isin([r for r, _ in runs])
    found = spark.read.parquet(f"{path}/counts").where(here).orderBy("n", "run").collect()  # a row for each run of the query
    return found[:RAREST] if len(found) == len(runs) else []


def _holding(spark: SparkSession, path: str, some: list) -> DataFrame:
    texts = spark.read.parquet(f"{path}/runs")
    if not some:
        return texts.select("key").limit(0)
    read = texts.where(F.col("bucket").isin([r["bucket"] for r in some]) & F.col("run").isin([r["run"] for r in some]))
    return read.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") == len(some)).select("key")


def postings(spark: SparkSession, path: str, query: str, buckets: int = BUCKETS) -> DataFrame | None:
    """key of the rows that have the query's rarest runs; None if it has none, no rows if one of them is in no row."""
    some = _rarest(spark, path, query, buckets)
    return None if some is None else _holding(spark, path, some)


def find(spark: SparkSession, path: str, query: str, buckets: int = BUCKETS) -> DataFrame:
    """key of the rows whose texts hold the query, both without marks and case. A blank query is held by all. No text is shuffled: at most WIDE
    keys are sent to where the texts are, and of more every text is looked through, with the same result."""
    texts = spark.read.parquet(f"{path}/texts")
    some = _rarest(spark, path, query, buckets)
    if some is not None and (not some or some[0]["n"] <= WIDE):
        texts = texts.join(F.broadcast(_holding(spark, path, some).withColumn("bucket", _bucket("key", buckets))), ["bucket", "key"])
    return texts.where(F.contains("text", plain(F.lit(query)))).select("key")
