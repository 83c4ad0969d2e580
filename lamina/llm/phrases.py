"""Phrases whose words go together: collocations of 2 to LONGEST words, by count tries.

A-Z are lower-cased, a text is split into pieces at `[.,;:!?\\x0A-\\x0D]` and a piece into words
`[^\\x20\\x09]+`; everything is counted for each language. A phrase that comes LEAST times or more is a
candidate, and so are all parts of it. Where a candidate of count a is cut in two, of counts l and r,
the cut scores floor(1000 * a * n / (l * r)), with n the words of the language; the lowest cut counts.

Counting takes three passes, so that what is written grows with what is frequent. The first counts words.
The second counts pairs of neighbours that are both frequent, by the first 40 bits of a hash of each pair: a shard's
hashes are sorted and sent as differences, packed by ranges, and each range's are merged. What either
finds frequent is kept as a bit field of fixed size, FIELD bits, whatever the corpus; a bit set by chance
lets a phrase through that the last count then drops, so a full field costs time and no result. In the
third pass each shard (SHARD bytes of text of one language) builds a trie of runs of frequent pairs, at
most LONGEST deep, one sorted level after the other, and writes its nodes, sorted, with their counts. The
shards' tries are merged by ranges of the phrase, so one first word's subtree is split over many tasks.

A walk over the sorted phrases has the phrases that the present one begins with on a stack, and so the
left parts of all its cuts. Where a range begins inside a subtree, the stack begins with the parts that
lie in ranges before: a few for each range. Right parts are found by suffix links, an equi-join
of what is left of a phrase after its first words. Scores are exact: decimals of 38 digits.

Null and empty texts have no words; a null language is `und`. Texts are read whole, however long: each is
at once in memory. Repeated rows count each. Phrases with equal scores and counts are ranked by the bytes of
the phrase. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.llm import _common as C

LONGEST, LEAST, TOP = 5, 100, 2000
BREAK = C.members((10, 13), *((ord(c), ord(c)) for c in ".,;:!?"))
WORD = ~(BREAK | C.members((9, 9), (32, 32)))
#: Bytes of text that are counted together; bits of a field (16 MB).
SHARD, FIELD = 12 << 20, 1 << 27
#: Characters of text whose pairs share a range of hashes; the highest bytes of a hash that are kept.
RANGE_CHARS, KEPT = 2_000_000, 5
SEED = 42
_P = np.uint64(0x9E3779B97F4A7C15)


def shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, pa.Array]]:
    """Languages with texts of about `size` bytes in all."""
    held, total = {}, 0
    for batch in C.slices(batches):
        langs = batch.column(0).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            held.setdefault(lang, []).append(batch.column(1).filter(pc.equal(langs.indices, k)))
        total += batch.nbytes
        if total >= size:
            yield from ((lang, pa.concat_arrays(texts)) for lang, texts in held.items())
            held, total = {}, 0
    yield from ((lang, pa.concat_arrays(texts)) for lang, texts in held.items())


def tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of all texts as places in a sorted dictionary, that dictionary (binary), and whether the next
    word follows in the same piece."""
    data, ends = C.flat(texts)
    data = C.lower_ascii(data)
    starts, _, text, own = C.runs(data, ends, WORD)
    if not len(starts):
        return np.zeros(0, np.int64), pa.array([], pa.binary()), np.zeros(0, bool)
    order = pc.sort_indices(own.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    piece = np.cumsum(BREAK[data])[starts]
    follows = np.append((piece[1:] == piece[:-1]) & (text[1:] == text[:-1]), False)
    return rank[own.indices.to_numpy()], own.dictionary.take(order), follows


def word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    """What Spark's xxhash64(lang, word) gives."""
    seed, digest = xxhash.xxh64_intdigest(lang.encode(), SEED), xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return C.mix(C.mix(first) * _P + second)


class Field:
    """A set of 64-bit hashes as FIELD bits: what was added is always found, other hashes seldom."""

    def __init__(self, spark: SparkSession, keys: DataFrame):
        """keys has a column key; what comes to the driver is one number for each 64 bits, whatever the table."""
        at = F.shiftrightunsigned("key", 65 - FIELD.bit_length())
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
        found = keys.select(F.shiftright(at, 6).alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
        bits = np.zeros(FIELD // 64, np.uint64)
        bits[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
        self.shared = spark.sparkContext.broadcast(bits)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        bits = self.shared.value
        at = keys >> np.uint64(65 - (64 * len(bits)).bit_length())
        return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def count_words(texts: DataFrame) -> DataFrame:
    """lang, phrase (a word) and count of (lang, text)."""
    size = SHARD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, held in shards(batches, size):
            ids, words, _ = tokens(held)
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(words)), words.cast(pa.string()), pa.array(np.bincount(ids, minlength=len(words)))], names=["lang", "phrase", "count"])

    return texts.mapInArrow(run, "lang string, phrase string, count bigint").groupBy("lang", "phrase").agg(F.sum("count").alias("count"))


PACKED = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("steps", pa.binary()), ("counts", pa.binary())])


def _planes(x: np.ndarray, size: int) -> bytes:
    """Numbers as their first bytes, then their second, ...: high bytes that are all zero take no room compressed."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _numbers(raw: bytes, n: int, size: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(size, n).T
    return out.view("<u8").ravel()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[head], np.add.reduceat(counts, head) if len(head) else counts


def _packed(keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Ascending keys of 8 * KEPT bits as rows of PACKED, a row for each range that has some."""
    edges = np.searchsorted(keys, [(k << 8 * KEPT) // buckets for k in range(1, buckets)]).tolist()
    spans = [(k, a, b) for k, (a, b) in enumerate(zip([0, *edges], [*edges, len(keys)], strict=True)) if b > a]
    steps = [_planes(np.diff(keys[a:b], prepend=np.uint64(0)), KEPT) for _, a, b in spans]
    columns = [[k for k, _, _ in spans], [b - a for _, a, b in spans], steps, [_planes(counts[a:b], 4) for _, a, b in spans]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PACKED, strict=True)], schema=PACKED)


def frequent_pairs(texts: DataFrame, words: Field, least: int, chars: int) -> DataFrame:
    """key: the hashes, whose last bytes are zero, of pairs of frequent neighbours that come `least` times or more, and of pairs whose hashes
    begin like theirs. chars: how many there are in all texts."""
    size, buckets = SHARD, max(1, chars // RANGE_CHARS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, held in shards(batches, size):
            ids, dictionary, follows = tokens(held)
            hashed = word_hashes(lang, dictionary)
            known = words.holds(hashed)[ids]
            at = np.flatnonzero(follows[:-1] & known[:-1] & known[1:]) if len(ids) else ids
            pairs, counts = np.unique(ids[at] * len(hashed) + ids[at + 1], return_counts=True)
            first, second = np.divmod(pairs, max(1, len(hashed)))
            keys = pair_hashes(hashed[first], hashed[second]) >> np.uint64(64 - 8 * KEPT)
            yield _packed(*_summed(keys, counts), buckets)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for batch in batches:
            for n, steps, c in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                keys.append(np.cumsum(_numbers(steps, n, KEPT)))
                counts.append(_numbers(c, n, 4))
        own, total = _summed(np.concatenate(keys), np.concatenate(counts))
        yield pa.RecordBatch.from_arrays([pa.array((own[total >= least] << np.uint64(64 - 8 * KEPT)).view(np.int64))], names=["key"])

    packed = texts.mapInArrow(count, "bucket int, n int, steps binary, counts binary")
    return packed.repartition(buckets, "bucket").mapInArrow(merge, "key bigint")


def trie(ids: np.ndarray, goes_on: np.ndarray, words: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The levels of a count trie of runs of words: for level 2, 3 ... the nodes' parents (level 1: words; then places
    in the level before), their words and counts, sorted by parent and word."""
    at, node = np.flatnonzero(goes_on), ids[np.flatnonzero(goes_on)]
    for depth in range(1, longest):
        if not len(at):
            return
        keys, place, count = np.unique(node * words + ids[at + depth], return_inverse=True, return_counts=True)
        yield *np.divmod(keys, words), count
        more = goes_on[at + depth]
        at, node = at[more], place[more]


def count_phrases(texts: DataFrame, words: Field, pairs: Field, longest: int = LONGEST) -> DataFrame:
    """lang, phrase and count: the nodes below the first level of each shard's trie, sorted level by level."""
    size = SHARD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, held in shards(batches, size):
            ids, dictionary, follows = tokens(held)
            if not len(ids):
                continue
            hashed = word_hashes(lang, dictionary)
            known = words.holds(hashed)[ids]
            goes_on = follows.copy()
            goes_on[:-1] &= known[:-1] & known[1:]
            at = np.flatnonzero(goes_on)
            goes_on[at] = pairs.holds(pair_hashes(hashed[ids[at]], hashed[ids[at + 1]]))
            above = dictionary
            for parent, word, count in trie(ids, goes_on, len(hashed), longest):
                above = pc.binary_join_element_wise(above.take(pa.array(parent)), dictionary.take(pa.array(word)), b" ")
                for k in range(0, len(above), 1 << 18):
                    part = above.slice(k, 1 << 18)
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(part)), part.cast(pa.string()), pa.array(count[k : k + (1 << 18)])], names=["lang", "phrase", "count"])

    return texts.mapInArrow(run, "lang string, phrase string, count bigint")


def left_parts(phrases: DataFrame, scratch: C.Scratch) -> DataFrame:
    """lang, phrase, a, and for each cut k (words before it), l and rest, of all phrases of two words or more.
    phrases: lang, phrase, count, all parts of each among them."""
    ranged = phrases.repartitionByRange("lang", "phrase").select("lang", "phrase", "count", F.spark_partition_id().alias("part"))
    ranged = scratch.save(ranged, "ranged")
    # what a range's first phrase begins with lies in ranges before; a character up to the space comes next there, since
    # words may hold such characters: few phrases for each range
    first = ranged.groupBy("part").agg(F.min(F.struct("lang", "phrase")).alias("f")).select("part", "f.*").collect()  # a row for each range
    begun = [(r["part"], r["lang"], r["phrase"][:k]) for r in first for k, c in enumerate(r["phrase"]) if k and c <= " "]
    begun = phrases.sparkSession.createDataFrame(begun, "part int, lang string, phrase string")
    opened = {}
    for r in begun.join(phrases, ["lang", "phrase"]).collect():
        opened.setdefault(r["part"], []).append((r["lang"], r["phrase"], r["count"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stack = None, []
        for batch in C.slices(batches, 10_000):
            out = []
            for part, lang, phrase, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now:
                    now, stack = part, sorted(opened.get(part, []), key=lambda x: x[1].encode())
                while stack and (stack[-1][0] != lang or not phrase.startswith(stack[-1][1])):
                    stack.pop()
                parts = {p: n for _, p, n in stack}
                stack.append((lang, phrase, count))
                cut, k = phrase.find(" "), 1
                while cut >= 0:
                    out.append((lang, phrase, count, k, parts[phrase[:cut]], phrase[cut + 1 :]))
                    cut, k = phrase.find(" ", cut + 1), k + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, CUTS.types, strict=True)], schema=CUTS)

    walked = ranged.select("part", "lang", "phrase", "count").repartition("part").sortWithinPartitions("part", "lang", "phrase")
    return walked.mapInArrow(run, "lang string, phrase string, a bigint, k int, l bigint, rest string")


CUTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()), ("k", pa.int32()), ("l", pa.int64()), ("rest", pa.string())])


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, words (how many), a, l, r, n and score of every candidate that no longer one makes needless: one that
    holds its words side by side and comes as often."""
    spark = C.prepare(docs.sparkSession)
    scratch = C.Scratch(spark, "phrases")
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    words = scratch.save(count_words(texts), "words")
    totals = scratch.save(words.groupBy("lang").agg(F.sum("count").alias("n")), "totals")
    often = words.where(F.col("count") >= least)
    known = Field(spark, often.select(F.xxhash64("lang", "phrase").alias("key")))
    chars = texts.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()[0]
    pairs = Field(spark, frequent_pairs(texts, known, least, chars))
    tries = scratch.save(count_phrases(texts, known, pairs, longest), "tries")
    merged = tries.repartitionByRange("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("count").alias("count")).where(F.col("count") >= least)
    phrases = scratch.save(often.select("lang", "phrase", "count").unionByName(merged), "phrases")
    scratch.drop("tries")

    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("count").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    scored = left_parts(phrases, scratch).join(right, ["lang", "rest"]).join(totals, "lang").withColumns({"__top": 1000 * wide("a") * wide("n"), "__by": wide("l") * wide("r")})
    scored = scored.withColumn("score", F.expr("__top DIV __by"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("s"), (F.count("*") + 1).alias("words"))
    found = scratch.save(lowest.select("lang", "phrase", "words", "s.a", "s.l", "s.r", "s.n", "s.score"), "found")
    # a longer phrase that comes as often holds one by one word longer that does
    ends = F.array(F.expr("left(phrase, length(phrase) - length(substring_index(phrase, ' ', -1)) - 1)"), F.expr("substr(phrase, instr(phrase, ' ') + 1)"))
    longer = found.where("words > 2").select("lang", F.explode(ends).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("__a"))
    return found.join(longer, ["lang", "phrase"], "left").where("__a IS NULL OR __a < a").drop("__a")


def top(found: DataFrame, k: int = TOP) -> DataFrame:
    """The first k of each language, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(collocations(C.table(spark, sf_dir, "documents"))).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d)),
g AS (SELECT lang, w[i:i + k - 1] AS g, k, count(*) AS f FROM p, unnest(range(1, len(w) + 1)) AS a(i), unnest(range(1, 6)) AS b(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY 1),
c AS (SELECT * FROM g WHERE f >= 100),
s AS (SELECT x.lang, x.g, x.k, x.f AS a, j, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * x.f * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM c x CROSS JOIN unnest(range(1, 5)) AS cut(j) JOIN n ON n.lang = x.lang JOIN c l ON l.lang = x.lang AND l.g = x.g[1:j] JOIN c r ON r.lang = x.lang AND r.g = x.g[j + 1:x.k] WHERE j < x.k),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
o AS (SELECT lang, g, max(f) AS f FROM (SELECT lang, unnest([g[1:k - 1], g[2:k]]) AS g, f FROM c WHERE k > 2) GROUP BY 1, 2)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT m.lang, row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, a DESC, encode(array_to_string(m.g, ' '))) AS rank, array_to_string(m.g, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
  FROM m LEFT JOIN o ON o.lang = m.lang AND o.g = m.g WHERE o.f IS NULL OR o.f < a) WHERE rank <= 2000
"""
