"""Windows over ordered values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.functions import textnorm as X


def islands(rows: DataFrame, value: str, by: list[str]) -> DataFrame:
    """by, first, last, n: runs of consecutive integers of a column within each group."""
    w = Window.partitionBy(*by).orderBy(value)
    runs = rows.select(*by, value).distinct().withColumn("__run", F.col(value) - F.row_number().over(w))
    return runs.groupBy(*by, "__run").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("n")).drop("__run")


def mark_ranges(spark: SparkSession, first: int = 0x600, last: int = 0x6FF) -> DataFrame:
    """The runs of code points in a block that are marks or the tatweel."""
    points = spark.range(first, last + 1).select(F.col("id").alias("cp"), F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE").alias("c"))
    return islands(points.where(X.bare(F.col("c")) == "").select(F.lit(0).alias("g"), "cp"), "cp", ["g"]).drop("g")
