"""Decision batches as a stream, an extension: each micro-batch is deduplicated and upserted."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lamina.operators.worklist import merge_keeps


def latest(stream: DataFrame, event_time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Each (id, fp) once within the watermark."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["id", "fp"])


def counts(stream: DataFrame, event_time: str = "ts", delay: str = "1 hour", window: str = "10 minutes", by: str = "disposition") -> DataFrame:
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, window).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def versions(spark: SparkSession, store: str) -> list[tuple[int, str, int]]:
    """Number, stream and batch of the versions in a store, in order; one without its success mark is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(store).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(path(store))] if fs.exists(path(store)) else []
    found = [m for n in names if (m := re.fullmatch(r"(\d+)-([0-9a-f]+)-(\d+)", n)) and fs.exists(path(f"{store}/{n}/_SUCCESS"))]
    return sorted((int(m[1]), m[2], int(m[3])) for m in found)


def _place(store: str, version: tuple[int, str, int]) -> str:
    return f"{store}/{version[0]:08d}-{version[1]}-{version[2]}"


def read_keeps(spark: SparkSession, store: str, schema) -> DataFrame:
    """The keeps of the last version."""
    found = versions(spark, store)
    return spark.read.schema(schema).parquet(_place(store, found[-1])) if found else spark.createDataFrame([], schema)


def upsert_keeps(stream: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Merges keeps (id, ...) into a versioned store. A batch that is replayed writes its own version again, from the
    one before it; a stream with a new checkpoint goes on from the last version of the others."""
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = versions(spark, store)
        own = next((v for v in found if v[1:] == (run, batch_id)), None)
        before = [v for v in found if own is None or v < own]
        number = own[0] if own else (found[-1][0] + 1 if found else 0)
        new = batch.dropDuplicates(["id"])
        merged = merge_keeps(spark.read.schema(batch.schema).parquet(_place(store, before[-1])), new) if before else new
        merged.write.mode("overwrite").parquet(_place(store, (number, run, batch_id)))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
