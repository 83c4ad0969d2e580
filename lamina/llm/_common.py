"""What the operators of this subpackage share: table access, scratch tables, Arrow helpers."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from pathlib import Path
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.graph import shared_dir

_ROOT = str(Path(__file__).resolve().parents[2])


#: Arrow batches have at most so many rows, and end with the row that takes them beyond so many bytes.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package, and keeps Arrow batches small, so a worker's memory
    doesn't grow with the table or the number of long texts."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    # idle workers give freed memory back, so those of earlier stages don't add up
    env |= {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "262144", "MALLOC_MMAP_THRESHOLD_": "262144"}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the shared folder to cut lineage: a lost executor costs no recomputation
    of what was written, and each later read is of the same rows."""

    made: ClassVar[list[Scratch]] = []

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.dir = spark, f"{shared_dir(spark)}/lamina-{what}-{uuid.uuid4().hex}"
        Scratch.made.append(self)

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Removes a table that no later step reads."""
        jvm, path = self.spark.sparkContext._jvm, self.path(name) if name else self.dir
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def cleaned():
    """Removes the scratch tables that are made inside, for callers that have saved what they want of them."""
    before = len(Scratch.made)
    try:
        yield
    finally:
        for scratch in Scratch.made[before:]:
            scratch.drop()
        del Scratch.made[before:]


def kept(df: DataFrame, keep: tuple[str, ...], *made: str) -> list[T.StructField]:
    """The fields of the columns to keep; refuses names that the results take, whatever their case."""
    fields = df.select(*keep).schema.fields
    if taken := {f.name.lower() for f in fields} & {m.lower() for m in made}:
        raise ValueError(f"columns to keep clash with the results: {sorted(taken)}")
    return fields


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the n + 1 offsets into them; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """A list column from flat values and n + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """data[s : s + n] for each start and length, put together."""
    total = int(lengths.sum())
    at = np.cumsum(lengths) - lengths
    return data[np.repeat(starts - at, lengths) + np.arange(total)]


def slices(batches, rows: int = BATCH_ROWS):
    """Record batches of at most `rows` rows and some bytes, none of them empty."""
    for batch in batches:
        each = max(1, min(rows, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, each):
            yield batch.slice(at, each)


def runs(data: np.ndarray, ends: np.ndarray, member: np.ndarray):
    """Maximal runs of bytes b with member[b] in each text.

    Returns the runs' starts and ends in the data, the text of each, and a dictionary-encoded
    column with the bytes of each run.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, pa.array([], pa.binary()).dictionary_encode()
    inside = member[data]
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(inside[1:], inside[:-1], out=start[1:])
    begins = ends[:-1][np.diff(ends) > 0]
    start[begins] = True
    cuts = np.flatnonzero(start)
    is_run = inside[cuts]
    stops = np.append(cuts[1:], n)
    pieces = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, n).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    own = pieces.filter(pa.array(is_run)).dictionary_encode()
    cuts, stops = cuts[is_run], stops[is_run]
    return cuts, stops, np.searchsorted(ends, cuts, "right") - 1, own


def members(*ranges: tuple[int, int]) -> np.ndarray:
    """Which bytes are in the ranges, both ends included."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def characters(data: np.ndarray, ends: np.ndarray, at: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The character in its text at which each byte position stands."""
    before = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    return before[at] - before[ends[text]]


#: A side of at most so many rows of a few numbers (some tens of MB) may be broadcast.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `rows` rows, else as it is, to be shuffled. df is a
    saved table of a few short columns, so counting it is cheap."""
    return F.broadcast(df) if df.count() <= rows else df


_K1, _K2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * _K1
    x = (x ^ (x >> np.uint64(33))) * _K2
    return x ^ (x >> np.uint64(33))
