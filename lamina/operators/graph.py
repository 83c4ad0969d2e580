"""Connected components on saved edge tables, by alternating large and small stars."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or in local mode one of our own where that is unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lamina-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/lamina-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """df written to a folder of its own and read again, so that what reads it several times doesn't work it out anew each time."""
    folder = scratch_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """node and component (the smallest node it reaches, itself included) for the nodes of edges (a, b). Self-loops
    and repeated edges don't matter; no edges give no rows.

    Each round is written to the folder, by default a new one below spark.checkpoint.dir, so plans stay short and a lost executor costs one
    round. No side is broadcast, so the driver holds none of it. Rounds grow with the logarithm of the longest path. Hubs are split by the joins.
    """
    spark = edges.sparkSession
    folder = folder or scratch_dir(spark)
    ordered = lambda df: df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def save(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    now, seen, k = save(ordered(edges), "0"), None, 0
    while (mark := tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())) != seen and mark[0]:
        seen, k = mark, k + 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = save(ordered(both.join(least.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))), f"{k}l")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(least.hint("merge"), "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = save(ordered(star), f"{k}")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
