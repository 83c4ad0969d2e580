"""MinHash near-duplicates with sequential Bayesian verification.

A document's set holds its distinct shingles of `shingle` words (the whole sequence where it has
fewer; none without words). Documents with equal sets are one class, stood for by its smallest
doc_id. Signatures of ROWS * BANDS hashes are banded, so that two classes at the threshold miss each
other in every band once in a million times. The classes of a bucket first meet its most central
one, which shares the most buckets with others, so a group of copies costs links in proportion to its
size. Classes of a bucket that are still in different components then all meet, in the first bucket
that a pair shares and by finer signatures, so no pair that could be a link goes unexamined.

A pair's signatures are compared in batches; a pair is dropped as soon as the posterior chance (uniform
prior) that it reaches the threshold is under MISS. The first comparison takes a byte of each of
HASHES hashes, the finer one a bit of each of FINE; the latter is made within the join, so pairs that
share much but not enough, as outliers of a large group of copies do with its members, are not written
out. Survivors are verified on the full sets. Components are found by star contraction on saved tables.

Null, empty and blank texts have empty sets and link with nothing; long ones are hashed whole, in a task's memory. Rows with one doc_id count as one
document with the links of each; a null doc_id links with nothing. Columns beyond doc_id and text
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import _common as C
from lamina.llm.components import components

THRESHOLD = 80  # per cent of the union
ROWS, BANDS = 5, 35
HASHES, STEP, MISS = 128, 32, 1e-6
FINE, FINE_STEPS = 4096, (512, 4096)
WORD = ~C.members((9, 13), (32, 32))
_random = np.random.default_rng(20240229)
_A = _random.integers(0, 2**32, ROWS * BANDS, np.uint32) | np.uint32(1)
_B = _random.integers(0, 2**32, ROWS * BANDS, np.uint32)
_FINE_A = _random.integers(0, 2**32, FINE, np.uint32) | np.uint32(1)
_FINE_B = _random.integers(0, 2**32, FINE, np.uint32)
_P = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: pa.Array, size: int) -> list[np.ndarray]:
    """For each text the ascending 64-bit hashes of its distinct shingles."""
    data, ends = C.flat(texts)
    starts, _, text, own = C.runs(C.lower_ascii(data), ends, WORD)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(texts)
    words = np.array([xxhash.xxh64_intdigest(w) for w in own.dictionary.to_pylist()], np.uint64)[own.indices.to_numpy()]
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    n = len(words)
    whole = np.zeros(max(0, n - size + 1), np.uint64)
    for j in range(size):
        whole = whole * _P + words[j : n - size + 1 + j] if len(whole) else whole
    whole = C.mix(whole)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            x = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    x = x * _P + w
            out.append(C.mix(np.array([~x])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(own: np.ndarray, a: np.ndarray = _A, b: np.ndarray = _B) -> np.ndarray:
    x = (own >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), 2**32 - 1, np.uint32)
    rows = max(1, 200_000 // len(a))
    for i in range(0, len(x), rows):
        np.minimum(low, (x[i : i + rows, None] * a + b).min(axis=0), out=low)
    return low


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A key for each band of each signature; different bands have different keys."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for j in range(ROWS):
        out = C.mix(out * _P + rows[:, :, j])
    return out.view(np.int64)


def sign(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, bands, and a signature of a byte a hash, eight to a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, 500):
            sets = shingles(batch.column(1), size)
            signatures = np.stack([signature(s) for s in sets])
            n = np.array([len(s) for s in sets], np.int64)
            keys = band_keys(signatures).ravel()
            short = np.ascontiguousarray(signatures[:, :HASHES].astype(np.uint8)).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()), C.lists(keys, np.arange(len(sets) + 1) * BANDS), C.lists(short, np.arange(len(sets) + 1) * (HASHES // 8))], names=["doc_id", "n_shingles", "digest", "bands", "signature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, signature array<bigint>")


def least_matches(threshold: float, steps: tuple[int, ...], miss: float = MISS) -> list[tuple[int, int]]:
    """After n of the steps' comparisons, the fewest matches with which a pair's chance of a match may
    still reach the threshold: the posterior chance of that is P(Bin(n + 1, threshold) <= matches)."""
    out = []
    for n in steps:
        total, m = 0.0, 0
        while m <= n:
            total += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(threshold) + (n + 1 - m) * log(1 - threshold))
            if total >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def matches(a: str, b: str, begin: int, end: int) -> str:
    """SQL for the number of equal bytes of the numbers begin to end of two signatures. Every other
    byte of the exclusive or stands in a lane of two; adding 255 carries where it isn't zero."""
    lanes, carry = 0x00FF00FF00FF00FF, 0x0100010001000100
    differ = lambda x: f"bit_count((({x} & {lanes}) + {lanes}) & {carry})"
    each = (f"({a}[{k}] ^ {b}[{k}])" for k in range(begin, end))
    return " + ".join(f"8 - {differ(x)} - {differ(f'shiftrightunsigned({x}, 8)')}" for x in each)


def alive(a: str, b: str, threshold: int) -> str:
    """SQL that tells whether a pair of signatures outlives the sequential test. Bytes that match by
    chance only add to the matches."""
    steps = tuple(range(STEP, HASHES + 1, STEP))
    return " AND ".join(f"({matches(a, b, 0, n // 8)} >= {least})" for n, least in least_matches(threshold / 100, steps))


def finely_alive(a: str, b: str, threshold: int) -> str:
    """The same for fine signatures, of whose bits a pair shares half and half its similarity."""
    return " AND ".join("(" + " + ".join(f"bit_count({a}[{k}] ^ {b}[{k}])" for k in range(n // 64)) + f" <= {n - least})" for n, least in least_matches((1 + threshold / 100) / 2, FINE_STEPS))


def confirm(pairs: DataFrame, size: int, threshold: int) -> DataFrame:
    """Of pairs a, b, ta, tb (texts), those whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, 200):
            x, y = shingles(batch.column(2), size), shingles(batch.column(3), size)
            both = np.array([len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y, strict=True)], np.int64)
            union = np.array([len(p) + len(q) for p, q in zip(x, y, strict=True)], np.int64) - both
            fine = (100 * both >= threshold * union) & (union > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(fine))

    return pairs.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def _fine(docs: DataFrame, size: int) -> DataFrame:
    """rep and its fine signature, 64 bits to a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, 500):
            own = np.stack([signature(s, _FINE_A, _FINE_B) for s in shingles(batch.column(1), size)])
            bits = np.packbits((own * np.uint32(0x9E3779B1)) >> np.uint32(31), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), C.lists(bits.ravel(), np.arange(len(bits) + 1) * (FINE // 64))], names=["rep", "fine"])

    return docs.select("doc_id", "text").mapInArrow(run, "rep bigint, fine array<bigint>")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs."""
    spark = C.prepare(docs.sparkSession)
    scratch = C.Scratch(spark, "minhash")
    signed = scratch.save(sign(docs, size), "signed")
    linkable = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = scratch.save(linkable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n")), "classes")
    stand = scratch.save(linkable.join(classes, "digest").where("doc_id = rep").select("digest", "rep", "n", "bands", "signature").dropDuplicates(["digest"]).drop("digest"), "stand")  # a doc_id with different texts stands once for each
    rows = stand.select(F.explode("bands").alias("band"), "rep", "n")
    crowded = rows.groupBy("band").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count("*").alias("crowd")).where("lo < hi").select("band", "crowd")
    shared = scratch.save(rows.join(crowded, "band").select("band", "rep", "n", "crowd"), "shared")
    central = shared.groupBy("rep").agg(F.sum("crowd").alias("central"))
    placed = scratch.save(shared.select("band", "rep", "n").join(central, "rep"), "placed")
    scratch.drop("shared")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signatures = stand.select("rep", "signature")

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        """Links among pairs (a, b) of representatives that outlived the sequential test."""
        needed = scratch.save(pairs.select(F.col("a").alias("doc_id")).distinct().unionByName(pairs.select(F.col("b").alias("doc_id")).distinct()).distinct(), f"needed{name}")
        held = scratch.save(texts.join(C.small(needed), "doc_id", "left_semi"), f"texts{name}")
        links = scratch.save(confirm(pairs.join(held.toDF("a", "ta"), "a").join(held.toDF("b", "tb"), "b"), size, threshold), f"links{name}")
        scratch.drop(f"texts{name}")
        return links

    def sifted(pairs: DataFrame, name: str) -> DataFrame:
        met = pairs.join(signatures.toDF("a", "sa"), "a").join(signatures.toDF("b", "sb"), "b")
        return scratch.save(met.where(alive("sa", "sb", threshold)).select("a", "b").distinct(), name)

    pair = lambda x, y: (F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    hubs = placed.groupBy("band").agg(F.max_by("rep", "central").alias("hub"))
    tested = scratch.save(placed.join(hubs, "band").where("rep <> hub").select(*pair("rep", "hub")).distinct(), "tested")
    links = verify(sifted(tested, "alive"), "1")
    # the texts of one doc_id are one document
    reps = linkable.select("doc_id", "digest").join(classes, "digest").groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("doc_id", "lo")
    same = linkable.select("doc_id", "digest").join(reps, "doc_id").join(classes, "digest").where("rep > lo").select(F.col("rep").alias("a"), F.col("lo").alias("b"))
    links = links.unionByName(scratch.save(same.distinct(), "same"))
    labels = scratch.save(components(links, scratch, "first"), "labels1")

    # buckets with more than one component
    labelled = placed.select("band", "rep", "n").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = labelled.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("band")
    apart = scratch.save(labelled.join(mixed, "band"), "apart")
    left = scratch.save(apart.select(F.col("rep").alias("doc_id")).distinct(), "left")
    fine = scratch.save(_fine(texts.join(C.small(left), "doc_id", "left_semi"), size).distinct(), "fine")
    apart = apart.join(fine.join(stand.select("rep", "bands"), "rep"), "rep").withColumn("at", F.array_position("bands", F.col("band")).cast("int")).where("at > 0")
    x, y = apart.alias("x"), apart.alias("y")
    ratio = f"100 * least(x.n, y.n) >= {threshold} * greatest(x.n, y.n)"  # else the sets can't reach the threshold
    first = "NOT exists(zip_with(slice(x.bands, 1, x.at - 1), slice(y.bands, 1, x.at - 1), (p, q) -> p = q), same -> same)"
    crossed = x.join(y, F.expr(f"x.band = y.band AND x.label < y.label AND {ratio} AND {finely_alive('x.fine', 'y.fine', threshold)} AND {first}")).select(*pair("x.rep", "y.rep"))
    crossed = scratch.save(crossed.distinct().join(tested, ["a", "b"], "left_anti"), "crossed")
    links = links.unionByName(verify(crossed, "2"))
    labels = scratch.save(components(links, scratch, "last"), "labels2")
    for name in ("stand", "placed", "apart", "left", "fine", "crossed", "tested"):
        scratch.drop(name)
    joined = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("label", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "digest").join(joined, "digest", "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """The documents of which one stays for each group of near-duplicates, with their own columns."""
    found = near_duplicates(docs, size, threshold)
    dropped = C.Scratch(docs.sparkSession, "dropped").save(found.where("NOT kept").select("doc_id").distinct(), "dropped")
    return docs.join(C.small(dropped), "doc_id", "left_anti").select(*docs.columns)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "documents"), size=2)


OP3_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
f AS (SELECT g, count(*) AS df FROM s GROUP BY 1),
p AS (SELECT doc_id, g, n FROM (SELECT doc_id, g, n, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS k FROM s JOIN f USING (g) JOIN n USING (doc_id)) WHERE k <= n - (80 * n + 99) // 100 + 1),
c AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb FROM p x JOIN p y ON x.g = y.g AND x.doc_id < y.doc_id),
l AS (SELECT a, b FROM (SELECT c.a, c.b, c.na, c.nb, count(*) AS i FROM c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b AND y.g = x.g GROUP BY ALL) WHERE 100 * i >= 80 * (na + nb - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
k AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM k LEFT JOIN n USING (doc_id)
"""
