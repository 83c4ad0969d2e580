"""Near-duplicates by SimHash, searched in a space of bit counts.

Fingerprint: A-Z are lower-cased, words are `[^\\x20\\x09-\\x0D]+`, shingles of SHINGLE words joined by
one space, repeats included (the whole sequence where it has fewer words); XXH64 of a shingle with seed
42 votes on 64 bits, and a bit is set if over half the shingles set it.

Search: the 64 bits are cut into segments of WIDTH bits, and a fingerprint is mapped to the number of bits
set in each. The Manhattan distance of two such vectors is at most the Hamming distance of the
fingerprints. The segments form RADIUS + EXTRA blocks. A pair within the radius differs in at most RADIUS
of them, so its vectors lie in the same cell of at least one of the grids, of which there is one for each
choice of EXTRA blocks. Within a cell a pair is first held against the Manhattan distance over all
segments and then against the Hamming distance. Counts are written in unary (a segment's bits, sorted),
so that the Manhattan distance is the number of bits in which two embeddings differ.

Only different fingerprints meet, and no pair of a dense group is written out: the fingerprints of a cell
first meet its smallest one, and then only those of other components, of which each keeps one link for
each component. No side of a join is broadcast, so the driver's memory doesn't grow with the links. EXTRA trades copies of a fingerprint (a row for each grid) for pairs per cell; results are
the same for any.

Null, empty and blank texts have the fingerprint zero, linked like any other. Long texts are hashed
whole, in a task's memory. Rows that share a doc_id are one document with the links of each, and each is a
row of the result; a null doc_id takes part, but is no component_id (null if nothing else is linked).
Columns beyond doc_id and text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import _common as C
from lamina.llm.components import components

BITS, SHINGLE, SEED = 64, 4, 42
RADIUS, WIDTH, EXTRA = 4, 2, 4
WORD = ~C.members((9, 13), (32, 32))
#: So many hashes are unpacked to bits at a time.
VOTES = 1 << 16


def hashes(data: np.ndarray, ends: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each shingle of the texts, and the n + 1 offsets of each text's."""
    data = C.lower_ascii(data)
    inside = WORD[data]
    first = np.zeros(len(data), bool)
    first[ends[:-1][ends[:-1] < len(data)]] = True
    before = np.append(False, inside[:-1]) & ~first if len(data) else inside
    start = np.flatnonzero(inside & ~before)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    after = np.append(inside[1:], False) & ~np.append(first[1:], True)
    length = np.flatnonzero(inside & ~after) + 1 - start
    at = np.cumsum(length + 1) - length - 1  # the words, each followed by one space
    joined = np.full(int(length.sum()) + len(length), 32, np.uint8)
    joined[np.repeat(at - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))] = data[inside]
    bounds = np.searchsorted(start, ends)  # words before each text
    words = np.diff(bounds)
    n = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    offsets = np.append(0, np.cumsum(n))
    low = np.repeat(bounds[:-1] - offsets[:-1], n) + np.arange(offsets[-1])
    high = low + np.repeat(np.minimum(words, size), n) - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    made = (digest(raw[a:b], SEED) for a, b in zip(at[low].tolist(), (at + length)[high].tolist(), strict=True))
    return np.fromiter(made, np.uint64, len(low)), offsets


def majority(votes: np.ndarray) -> int:
    """The bits set in over half the hashes; none of no hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(votes), VOTES):
        ones += np.unpackbits(votes[at : at + VOTES].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(votes)).view(">u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (bigint) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, 500):
            votes, ends = hashes(*C.flat(batch.column(1)), size)
            found = np.array([majority(votes[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, fingerprint bigint")


def embedding(fingerprint: str | Column, width: int = WIDTH) -> Column:
    """The number of bits set in each segment, in unary: bit k of a segment is set if over k of its bits are."""
    x = F.col(fingerprint) if isinstance(fingerprint, str) else fingerprint
    lanes = sum(1 << b for b in range(0, BITS, width))
    signed = lambda v: F.lit(v - (1 << BITS) if v >> (BITS - 1) else v)
    bits = [F.shiftrightunsigned(x, k).bitwiseAND(signed(lanes)) for k in range(width)]
    # an odd-even transposition network sorts the bits of all segments at once
    for turn in range(width):
        for k in range(turn % 2, width - 1, 2):
            bits[k], bits[k + 1] = bits[k].bitwiseOR(bits[k + 1]), bits[k].bitwiseAND(bits[k + 1])
    out = bits[0]
    for k in range(1, width):
        out = out.bitwiseOR(F.shiftleft(bits[k], k))
    return out


def differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def grids(radius: int = RADIUS, width: int = WIDTH, extra: int = EXTRA) -> list[int]:
    """The bits of the embedding that give the cell, for each grid, as signed numbers."""
    segments, blocks = BITS // width, radius + extra
    edges = [segments * k // blocks * width for k in range(blocks + 1)]
    masks = [sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen) for chosen in combinations(range(blocks), extra)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def linked(values: DataFrame, scratch: C.Scratch, more: DataFrame | None = None, radius: int = RADIUS, width: int = WIDTH, extra: int = EXTRA) -> DataFrame:
    """node and label (the smallest fingerprint reachable) of the different fingerprints that are linked with others,
    by steps within the radius or by the further links (a, b)."""
    masks = grids(radius, width, extra)
    keys = F.array(*(F.xxhash64(F.lit(k), F.col("e").bitwiseAND(F.lit(m))) for k, m in enumerate(masks)))
    rows = values.select("fingerprint").distinct().withColumn("e", embedding("fingerprint", width)).select("fingerprint", F.explode(keys).alias("cell"))
    crowded = rows.groupBy("cell").agg(F.min("fingerprint").alias("hub"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    met = scratch.save(rows.join(crowded.hint("merge"), "cell"), "met")
    first = met.where((F.col("fingerprint") > F.col("hub")) & (differing("fingerprint", "hub") <= radius)).select(F.col("fingerprint").alias("a"), F.col("hub").alias("b"))
    links = scratch.save((first.unionByName(more) if more is not None else first).distinct(), "links1")
    labels = scratch.save(components(links, scratch, "first"), "labels1").withColumnRenamed("node", "fingerprint")

    labelled = met.select("cell", "fingerprint").join(labels.hint("merge"), "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    mixed = labelled.groupBy("cell").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("cell")
    apart = scratch.save(labelled.join(mixed.hint("merge"), "cell", "left_semi").withColumn("e", embedding("fingerprint", width)), "apart")
    x, y = apart.alias("x"), apart.alias("y")
    near = (F.col("x.cell") == F.col("y.cell")) & (F.col("x.label") < F.col("y.label")) & (differing("x.e", "y.e") <= radius) & (differing("x.fingerprint", "y.fingerprint") <= radius)
    found = x.join(y.hint("merge"), near).groupBy(F.col("x.fingerprint").alias("a"), F.col("y.label").alias("__l")).agg(F.min("y.fingerprint").alias("b"))
    links = links.unionByName(scratch.save(found.select("a", "b"), "links2"))
    out = scratch.save(components(links, scratch, "last"), "labels2")
    scratch.drop("met")
    scratch.drop("apart")
    return out


def near_duplicates(docs: DataFrame, text: str = "text", size: int = SHINGLE, radius: int = RADIUS, width: int = WIDTH, extra: int = EXTRA) -> DataFrame:
    """doc_id, fingerprint (bigint) and component_id (the smallest doc_id reachable) of each row of docs."""
    spark = C.prepare(docs.sparkSession)
    scratch = C.Scratch(spark, "simhash-dedup")
    marked = scratch.save(fingerprints(docs, text, size), "marked")
    values = scratch.save(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "values")
    twice = marked.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fingerprint").alias("b"), F.max("fingerprint").alias("__hi")).where("b < __hi").select("doc_id", "b")
    same = marked.join(twice.hint("merge"), "doc_id").where("fingerprint > b").select(F.col("fingerprint").alias("a"), "b")  # the texts of one doc_id
    labels = linked(values, scratch, same, radius, width, extra).withColumnRenamed("node", "fingerprint")
    joined = values.join(labels.hint("merge"), "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    parts = scratch.save(joined.join(least.hint("merge"), "label").select("fingerprint", "component_id"), "parts")
    return marked.join(parts.hint("merge"), "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents of which one stays for each component, with their own columns; rows without a doc_id stay."""
    found = near_duplicates(docs, text).where("doc_id > component_id").select("doc_id").distinct()
    dropped = C.Scratch(docs.sparkSession, "dropped").save(found, "dropped")
    return docs.join(C.small(dropped), "doc_id", "left_anti").select(*docs.columns)


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(C.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), BITS // 4, "0")).alias("fingerprint"), "component_id")
