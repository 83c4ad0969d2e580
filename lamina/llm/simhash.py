"""SimHash fingerprints with DataFrame functions only.

Terms are what white space parts, lower-cased. Each occurrence votes on the 64 bits of its hash with
its weight, its number of characters up to MAX_WEIGHT; a bit is one if over half of a text's weight
votes for it. Two bits' votes, 32 places apart, are counted in one 64-bit sum, so a text needs 32 sums
of a shift, a mask and a product; they are exact below 2 ** 31 / MAX_WEIGHT terms a text, more than a
text can hold.

`pairs_within` finds all pairs of fingerprints within a Hamming radius through permuted block tables:
the bits are cut into radius + EXTRA blocks, of which a pair within the radius shares at least EXTRA
whole, and there is a table for each choice of EXTRA blocks. Equal fingerprints meet once.

Null and empty texts, and blank ones, have the fingerprint of no votes, all zeros. All words of a long text vote. Equal texts have
equal fingerprints. Extra columns are ignored. Rows that share a doc_id are each a row of the result;
their order among themselves is open. A row without a doc_id has no next document, nor is it one. An
empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.llm import _common as C

BITS, HALF = 64, 32
MAX_WEIGHT = 8
#: A range of doc_ids that one task puts in order has about so many, while there are RANGES ranges at most.
SPAN, RANGES = 1024, 4096
EXTRA = 2


def fingerprints(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys and fingerprint (bigint), a row for each value of keys. Where df is clustered by some of
    the keys, nothing is shuffled."""
    words = df.select(*keys, F.explode_outer(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+")).alias("__w"))
    votes = words.select(*keys, F.xxhash64("__w").alias("__h"), F.least(F.coalesce(F.length("__w"), F.lit(0)), F.lit(MAX_WEIGHT)).cast("long").alias("__n"))
    two = F.lit((1 << HALF) | 1)
    sums = votes.groupBy(*keys).agg(F.sum("__n").alias("__all"), *(F.sum(F.shiftrightunsigned("__h", b).bitwiseAND(two) * F.col("__n")).alias(f"__s{b}") for b in range(HALF)))
    low, zero = F.lit((1 << HALF) - 1), F.lit(0).cast("long")
    ones = lambda b: F.col(f"__s{b}").bitwiseAND(low) if b < HALF else F.shiftrightunsigned(f"__s{b - HALF}", HALF)
    bits = [F.when(2 * ones(b) > F.col("__all"), F.lit((1 << b) if b < BITS - 1 else -(1 << b))).otherwise(zero) for b in range(BITS)]
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
    return sums.select(*keys, bits[0].alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def shown(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


def _bounds(ids: DataFrame) -> list[int]:
    """Ascending bounds that part the ids (column doc_id) in ranges of about SPAN each, RANGES at most, from a
    quantile sketch of bounded size. However the ids are spread, a range has about as many."""
    n = ids.count()
    parts = max(1, min(RANGES, -(-n // SPAN)))
    if parts == 1:
        return []
    cuts = ids.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10 * parts).alias("cuts")).first()["cuts"]
    return sorted({int(x) for x in cuts})


def _bucket(bounds: list[int]) -> Column:
    """How many bounds are at most doc_id, by bisection."""
    if not bounds:
        return F.lit(0)
    cuts, top = F.array(*map(F.lit, bounds)), len(bounds).bit_length() - 1
    at = lambda lo, k: lo + F.call_function("shiftleft", F.lit(1), F.lit(top) - k)
    step = lambda lo, k: F.when((at(lo, k) <= len(bounds)) & (F.get(cuts, at(lo, k) - 1) <= F.col("doc_id")), at(lo, k)).otherwise(lo)
    return F.aggregate(F.sequence(F.lit(0), F.lit(top)), F.lit(0), step)


def with_next(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """bucket, place, guest, doc_id, text and next_text, clustered by bucket and ordered by place; and the
    same of the rows without a doc_id. Buckets hold ranges of doc_ids, the highest first; a guest repeats the
    head of the next bucket. The texts are shuffled once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    ids = rows.select("doc_id").where("doc_id IS NOT NULL")
    ring = rows.where("doc_id IS NOT NULL").withColumn("bucket", _bucket(_bounds(ids)))
    scratch = C.Scratch(docs.sparkSession, "simhash")
    heads = scratch.save(ring.groupBy("bucket").agg(F.max("doc_id").alias("head")), "heads")
    order = Window.orderBy(F.desc("bucket"))  # RANGES rows at most
    targets = scratch.save(heads.select(F.col("bucket").alias("target"), F.coalesce(F.lead("head").over(order), F.first("head").over(order)).alias("doc_id")), "targets")
    guests = ring.drop("bucket").join(F.broadcast(targets), "doc_id").groupBy("doc_id", "target").agg(F.min("text").alias("text"))  # RANGES rows at most
    guests = guests.select("doc_id", "text", F.col("target").alias("bucket"), F.lit(1).alias("guest"))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("doc_id"))
    all_rows = ring.withColumn("guest", F.lit(0)).unionByName(guests)
    in_ring = all_rows.select("bucket", F.row_number().over(order).alias("place"), "guest", "doc_id", "text", F.lead("text").over(order).alias("next_text"))
    alone = rows.where("doc_id IS NULL").select(F.hash("text").alias("bucket"), (-F.monotonically_increasing_id() - 1).alias("place"), F.lit(0).alias("guest"), "doc_id", "text", F.lit(None).cast("string").alias("next_text"))
    return in_ring, alone


def edited(rows: DataFrame) -> DataFrame:
    """Adds n_chars and edited: the last third of the text's code points replaced by the first as
    many, or all, of the next text's."""
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    return rows.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.left("text", n - third), F.left(F.coalesce("next_text", F.lit("")), third)))


def pairs_within(marked: DataFrame, radius: int = 3) -> DataFrame:
    """fingerprint_a < fingerprint_b (as signed numbers) and distance, for all pairs of different
    values of marked.fingerprint within the radius. Membership is the caller's own column."""
    blocks = radius + EXTRA
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    block = lambda k: F.shiftrightunsigned("fingerprint", edges[k]).bitwiseAND(F.lit((1 << (edges[k + 1] - edges[k])) - 1))
    tables = F.array(*(F.xxhash64(F.lit(i), *map(block, chosen)) for i, chosen in enumerate(combinations(range(blocks), EXTRA))))
    values = marked.select("fingerprint").distinct().select("fingerprint", F.explode(tables).alias("key"))
    x, y = values.alias("x"), values.alias("y")
    distance = F.bit_count(F.col("x.fingerprint").bitwiseXOR(F.col("y.fingerprint")))
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.fingerprint") < F.col("y.fingerprint")) & (distance <= radius))
    return met.select(F.col("x.fingerprint").alias("fingerprint_a"), F.col("y.fingerprint").alias("fingerprint_b"), distance.alias("distance")).distinct()


def near(marked: DataFrame, radius: int = 3) -> DataFrame:
    """fingerprint, class_id (the smallest doc_id with that fingerprint), n_links (how many other values are within
    the radius) and nearest_id (the smallest class_id among those and itself) of each value of marked
    (doc_id, fingerprint). Links are counted as they are met: no pair is written out."""
    classes = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"))
    pairs = pairs_within(classes.select("fingerprint"), radius)
    ends = pairs.select(F.explode(F.array(F.struct(F.col("fingerprint_a").alias("fingerprint"), F.col("fingerprint_b").alias("other")), F.struct(F.col("fingerprint_b").alias("fingerprint"), F.col("fingerprint_a").alias("other")))).alias("e")).select("e.*")
    met = ends.join(classes.select(F.col("fingerprint").alias("other"), F.col("class_id").alias("__id")), "other").groupBy("fingerprint").agg(F.count("*").alias("n_links"), F.min("__id").alias("__least"))
    return classes.join(met, "fingerprint", "left").select("fingerprint", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.least("class_id", "__least").alias("nearest_id"))


def compare(docs: DataFrame) -> DataFrame:
    """For each document its fingerprint, its edited text's, and their and the next one's likeness."""

    def marked(rows: DataFrame) -> DataFrame:
        keys = ["bucket", "place", "guest", "doc_id", "n_chars", "edited_sha256"]
        sides = edited(rows).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
        sides = sides.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))).alias("s")).select(*keys, "s.side", "s.t")
        both = fingerprints(sides, [*keys, "side"], "t")
        side = lambda k: F.max(F.when(F.col("side") == k, F.col("fingerprint")))
        return both.groupBy(*keys).agg(side(0).alias("own"), side(1).alias("changed"))

    ring, alone = map(marked, with_next(docs))
    following = F.lead("own").over(Window.partitionBy("bucket").orderBy("place"))
    found = ring.withColumn("following", following).where("guest = 0").unionByName(alone.withColumn("following", F.lit(None).cast("long")))
    return found.select("doc_id", "n_chars", "edited_sha256", "own", "changed", "following")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = C.Scratch(spark, "op9")
    found = scratch.save(compare(C.table(spark, sf_dir, "documents")), "found")
    close = scratch.save(near(found.select("doc_id", F.col("own").alias("fingerprint"))), "near")
    rows = found.join(C.small(close.withColumnRenamed("fingerprint", "own")), "own")
    own, changed, following = F.col("own"), F.col("changed"), F.col("following")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", shown(own).alias("fingerprint"), shown(changed).alias("edited_fingerprint"), likeness(own, changed).alias("near_edited"), likeness(own, following).alias("near_next"),
        "class_id", "n_links", "nearest_id",
    )
