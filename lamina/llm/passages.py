"""Substring dedup: shared k-mer seeds chained collinearly, and chains aligned to fuzzy passages.

Words are what white space parts, A-Z lower-cased, as 16 bits of their hashes from the first pass on: two
different words are taken for one once in 65,536 times. Rows with equal texts are one class, stood for by
its smallest doc_id. Seeds are shingles of K words of which the first or the last has the least hash,
a third of all shingles; which they are depends on no other words, so two texts that share a shingle
share the seed, and any 2 K - 2 equal words hold one.

Seeds are packed by ranges of their hash, so one shuffle of numbers finds those that two classes
hold; a seed that repeats within what a task has packed is sent on once. At first a class's k-th occurrence of a
seed meets k-th ones only, and of more than FEW the smallest and the largest holder only, so a passage
in m documents costs links in proportion to m. The matches of two classes are united to
segments (one diagonal, skips up to REACH words) and the segments chained: a chain gains a point for each
word its seeds cover and pays GAP for each word that either side skips; the best predecessor of a
segment is a prefix maximum in a Fenwick tree over the ends in the partner. A chain is cut where a
skip is over REACH words and aligned: segments word by word, skips by edit distance, ends by
extension in a band around the diagonal up to a drop, so that words may be inserted and deleted there too; where a single segment falls short by that, the longest stretch of LEAST words around it
with the identity is taken. What aligns over PIECE words or more with an identity of IDENTITY is a piece.
A class's pieces that overlap or touch are united; stretches of `least` words or more are passages,
and those that pieces link, directly or through others, have one passage_id.

Seeds whose holders are then still in different passages, or in none, are looked at again. Those whose occurrences haven't all met
are put in the order of the words that follow them, and in that of the words before them: of all occurrences of a seed
the one that shares the most words with another there is beside it. So each is aligned with its neighbours, whoever else
holds the seed and however often; where all who hold a seed hold the next one too, that one is enough. And windows
of `least` words that hold such a seed, and none that only one class holds, are grouped by the words themselves. So two documents
with `least` equal words in a row always end in one passage_id, whoever else holds their seeds. Fuzzy passages have
no such guarantee: one is missed where no run of 2 K - 2 words is equal, or where at each of its common seeds
others share more words on either side. What repeats within one document only is no
passage.

Null and empty texts have no words and no passages; of long ones all words count, in a task's memory. Rows with one doc_id and different texts are each
a row of the result with passages of its own; rows without a doc_id are compared with nothing.
Columns beyond doc_id and text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import _common as C
from lamina.llm.components import components

K = 6
FEW = 8
GAP, REACH = 0.1, 40
PIECE, LEAST, IDENTITY = 20, 50, 0.8
DROP = 8
#: Seeds that a task packs together; characters of text whose seeds share a range of hashes.
PACK, RANGE_CHARS = 1_000_000, 2_000_000
WORD = ~C.members((9, 13), (32, 32))
_P = np.uint64(0x9E3779B97F4A7C15)


def words(texts: pa.Array):
    """Hash, first byte and end of each word, the bounds of each text's words, data and ends."""
    data, ends = C.flat(texts)
    starts, stops, text, own = C.runs(C.lower_ascii(data), ends, WORD)
    unique = np.array([xxhash.xxh64_intdigest(w) for w in own.dictionary.to_pylist()], np.uint64)
    hashes = unique[own.indices.to_numpy()] if len(starts) else np.zeros(0, np.uint64)
    return hashes, starts, stops, np.searchsorted(text, np.arange(len(texts) + 1)), data, ends


def _words(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """16-bit hashes of words, as numbers of 64 bits, and the bounds of each text's words."""
    data, ends = C.flat(packed)
    return np.ascontiguousarray(data).view(np.uint16).astype(np.uint64), ends // 2


def seeds(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and place of each seed of the texts whose words lie between the bounds."""
    n = len(hashes) - K + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    rank = C.mix(hashes + np.uint64(1))
    low = rank[1 : n + 1].copy()  # of the words between a shingle's ends
    for j in range(2, K - 1):
        np.minimum(low, rank[j : n + j], out=low)
    at = np.flatnonzero(np.minimum(rank[:n], rank[K - 1 :]) <= low)
    text = np.searchsorted(bounds, at, "right") - 1
    whole = at + K <= bounds[text + 1]
    at, text = at[whole], text[whole]
    own = np.zeros(len(at), np.uint64)
    for j in range(K):
        own = own * _P + hashes[at + j]
    return C.mix(own), text, at - bounds[text]


PACKED = "bucket int, known boolean, n int, seeds binary, docs binary, places binary"
#: Bytes of a seed that are sent; the range that it lies in stands for more.
SENT = 6


def _planes(x: np.ndarray, size: int) -> bytes:
    """Numbers as their first bytes, then their second, ...: high bytes that are all zero take no room compressed."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1)[:, :size].T).tobytes()


def _numbers(raw: bytes, n: int, size: int, kind: type) -> np.ndarray:
    out = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(size, n).T
    return out.view(kind).ravel()


def _packs(own: np.ndarray, docs: np.ndarray, places: np.ndarray, buckets: int, turn: int) -> Iterator[tuple]:
    """Rows of PACKED. Seeds that several documents of the pack hold are known to be shared: they go
    to one bucket in turn, and one occurrence, without its place, to the bucket of their hash."""
    order = np.lexsort((places, docs, own))
    own, docs, places = own[order], docs[order], places[order]
    head = np.append(True, own[1:] != own[:-1])
    group = np.cumsum(head) - 1
    several = (np.bincount(group, np.append(False, docs[1:] != docs[:-1]) & ~head) > 0)[group]
    row = lambda bucket, known, x: (bucket, known, len(docs[x]), _planes(own[x], 8 if known else SENT), _planes(docs[x], 8), _planes(places[x], 4))
    if several.any():
        yield row(turn % buckets, True, several)
    places = np.where(several, -1, places).astype(np.int32)
    once = np.flatnonzero(head | ~several)
    bucket = _bucket(own[once], buckets)
    order = np.argsort(bucket, kind="stable")
    once, bucket = once[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if b > a:
            yield row(k, False, once[a:b])


def _bucket(own: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a seed, from its two highest bytes, which aren't sent, and others."""
    return ((own >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in PACKED.split(", ")])


def seed(reps: DataFrame, buckets: int) -> DataFrame:
    """Packed seeds of the classes (key, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, turn = [], 0, None
        for batch in C.slices(batches):
            hashes, bounds = _words(batch.column(1))
            own, text, places = seeds(hashes, bounds)
            keys = batch.column(0).to_numpy()
            turn = int(keys[0]) if turn is None else turn
            held.append((own, keys[text], places.astype(np.int32)))
            size += len(own)
            if size >= PACK:
                yield _batch(list(_packs(*map(np.concatenate, zip(*held, strict=True)), buckets, turn)))
                held, size, turn = [], 0, turn + 1
        if size:
            yield _batch(list(_packs(*map(np.concatenate, zip(*held, strict=True)), buckets, turn)))

    return reps.select("key", "words").mapInArrow(run, PACKED)


def shared_seeds(packed: DataFrame, buckets: int) -> DataFrame:
    """seed, doc, place and turn (0 for a document's first one) of each occurrence of a seed that several
    documents hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []

        def out(own: np.ndarray, docs: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
            head = np.append(True, (own[1:] != own[:-1]) | (docs[1:] != docs[:-1]))[: len(own)]
            turn = np.arange(len(own)) - np.flatnonzero(head)[np.cumsum(head) - 1] if len(own) else own
            return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(docs), pa.array(places), pa.array(turn.astype(np.int32))], names=["seed", "doc", "place", "turn"])

        for batch in batches:
            for bucket, known, n, own, docs, places in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                part = _numbers(own, n, 8 if known else SENT, np.uint64), _numbers(docs, n, 8, np.int64), _numbers(places, n, 4, np.int32)
                if known:
                    # what stands for a seed elsewhere is the same part of it
                    yield out(_short(part[0], buckets), *part[1:])
                else:
                    parts.append((_in_bucket(part[0], bucket), *part[1:]))
        if not parts:
            return
        own, docs, places = map(np.concatenate, zip(*parts, strict=True))
        order = np.lexsort((places, docs, own))
        own, docs, places = own[order], docs[order], places[order]
        head = np.append(True, own[1:] != own[:-1])
        group = np.cumsum(head) - 1
        several = np.bincount(group, (np.append(False, docs[1:] != docs[:-1]) & ~head) | (places < 0)) > 0
        take = several[group] & (places >= 0)
        yield out(own[take], docs[take], places[take])

    return packed.repartition(buckets, "bucket").mapInArrow(run, "seed bigint, doc bigint, place int, turn int")


def _in_bucket(own: np.ndarray, bucket: int) -> np.ndarray:
    return own | np.uint64(bucket) << np.uint64(8 * SENT) if bucket < 1 << 16 else C.mix(own + np.uint64(bucket) * _P)


def _short(own: np.ndarray, buckets: int) -> np.ndarray:
    bucket = _bucket(own, buckets).astype(np.uint64)
    low = own & np.uint64((1 << 8 * SENT) - 1)
    return np.where(bucket < np.uint64(1 << 16), low | bucket << np.uint64(8 * SENT), C.mix(low + bucket * _P))


# -- chains -----------------------------------------------------------------------------------------
def segments(row: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, starts in both texts, length and words covered of the matches (row, a, b) united along
    diagonals, ordered by row and start."""
    order = np.lexsort((a, a - b, row))
    row, a, b = row[order], a[order], b[order]
    fresh = np.append(True, (row[1:] != row[:-1]) | (a[1:] - b[1:] != a[:-1] - b[:-1]) | (a[1:] - a[:-1] > REACH + K))
    gain = np.where(fresh, K, np.minimum(np.append(0, np.diff(a)), K))
    head = np.flatnonzero(fresh)
    last = np.append(head[1:], len(a)) - 1
    out = row[head], a[head], b[head], a[last] + K - a[head], np.add.reduceat(gain, head)
    order = np.lexsort((out[2], out[1], out[0]))
    return tuple(x[order] for x in out)


def chains(parts: list[tuple[int, int, int, int]]) -> list[list[int]]:
    """Collinear chains of segments (own start, partner's start, length, gain), as their places in
    `parts`, which is ordered by own start. Each is in one chain; neighbours overlap by K - 1 words at most."""
    if len(parts) == 1:
        return [[0]]
    ends = sorted({b + n for _, b, n, _ in parts})
    tree: list[tuple[float, int]] = [(float("-inf"), -1)] * (len(ends) + 1)
    score, before = [0.0] * len(parts), [-1] * len(parts)
    by_end = sorted(range(len(parts)), key=lambda i: parts[i][0] + parts[i][2])
    waiting = 0
    for i, (a, b, _, gain) in enumerate(parts):
        while waiting < len(by_end) and parts[j := by_end[waiting]][0] + parts[j][2] < a + K:  # those that end before it enter the tree
            x, y, n, _ = parts[j]
            k, value = bisect_right(ends, y + n), (score[j] + GAP * (x + y + 2 * n), j)
            while k <= len(ends):
                tree[k] = max(tree[k], value)
                k += k & -k
            waiting += 1
        k, best = bisect_right(ends, b + K - 1), (float("-inf"), -1)
        while k:
            best = max(best, tree[k])
            k -= k & -k
        more = best[0] - GAP * (a + b)
        score[i], before[i] = (gain + more, best[1]) if more > 0 else (float(gain), -1)
    out, used = [], [False] * len(parts)
    for i in sorted(range(len(parts)), key=lambda i: -score[i]):
        chain: list[int] = []
        while i >= 0 and not used[i]:
            used[i] = True
            if chain and max(parts[chain[-1]][0] - parts[i][0] - parts[i][2], parts[chain[-1]][1] - parts[i][1] - parts[i][2]) > REACH:
                out.append(chain[::-1])
                chain = []
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def edits(x: list[int], y: list[int]) -> int:
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


#: How far apart the words of an extension may lie from its diagonal, and what a path is worth less by for each edit.
BAND, _ONE = 8, 1 << 10


def extend(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of x and y (words; what lies beyond a text equals nothing) how many words from the first on run alike
    in either, and the edits among them. The best score counts, one for an equal word and -2 for each edit;
    nothing beyond a fall of DROP does, nor what lies over BAND words from the diagonal."""
    n, size = x.shape
    width, floor = 2 * BAND + 1, np.int32(-(1 << 28))
    step = np.arange(width, dtype=np.int32) * (2 * _ONE + 1)
    beyond = np.zeros((n, BAND), y.dtype)
    there = np.zeros((n, size + 2 * BAND), bool)
    there[:, BAND : BAND + size] = True
    y = np.concatenate([beyond, y, beyond], axis=1)
    # scores times _ONE, less the edits; at first only words of y are left out
    value = np.where(np.arange(width) >= BAND, -(np.arange(width, dtype=np.int32) - BAND) * np.int32(2 * _ONE + 1), floor)[None].repeat(n, 0)
    best, at_x, at_y = (np.zeros(n, np.int32) for _ in range(3))
    rows = np.arange(n)
    for i in range(size):
        alike = (y[:, i : i + width] == x[:, i : i + 1]) & there[: len(rows), i : i + width]
        down = np.concatenate([value[:, 1:], np.full((len(rows), 1), floor)], axis=1) - np.int32(2 * _ONE + 1)
        value = np.maximum(value + np.where(alike, np.int32(_ONE), np.int32(-2 * _ONE - 1)), down)
        value = np.maximum.accumulate(value + step, axis=1) - step
        top = value.argmax(axis=1)
        high = value[np.arange(len(rows)), top]
        more = high > best[rows]
        best[rows[more]], at_x[rows[more]], at_y[rows[more]] = high[more], i + 1, i + 1 + top[more] - BAND
        value[value < (best[rows] - DROP * _ONE)[:, None]] = floor
        if i % 4 == 3:
            alive = value.max(axis=1) > floor // 2
            if not alive.any():
                break
            if not alive.all():
                rows, value, x, y = rows[alive], value[alive], x[alive], y[alive]
    return at_x, at_y, (-best) % _ONE


def _beside(data: np.ndarray, low: np.ndarray, at: np.ndarray, high: np.ndarray, step: int, absent: int) -> np.ndarray:
    """REACH words from each place on (step 1) or before it, backwards (-1); `absent` beyond the bounds."""
    place = at[:, None] + (np.arange(REACH) if step > 0 else -1 - np.arange(REACH))
    inside = (place >= low[:, None]) & (place < high[:, None])
    return np.where(inside, data[np.clip(place, 0, max(0, len(data) - 1))].astype(np.int32) if len(data) else 0, absent)


def unlike(x: np.ndarray, y: np.ndarray) -> int:
    """The edits between two stretches of one length that are alike on their diagonal for the most part. Where words that differ stand
    close together, an insert and a delete may have shifted those between them, so they are aligned."""
    differ = np.flatnonzero(x != y)
    if len(differ) < 4:
        return len(differ)
    total = 0
    for part in np.split(differ, np.flatnonzero(np.diff(differ) > K) + 1):
        low, high = int(part[0]), int(part[-1]) + 1
        near = 4 <= len(part) and high - low <= 2 * REACH
        total += min(len(part), edits(x[low:high].tolist(), y[low:high].tolist())) if near else len(part)
    return total


def core(x: np.ndarray, y: np.ndarray, chain: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The ends in x and y of a chain of segments (starts, length), and the edits between its begin and them."""
    a, b, n = chain[0]
    end_a, end_b = a + n, b + n
    wrong = unlike(x[a:end_a], y[b:end_b])
    for c, d, n in chain[1:]:
        if (cut := max(end_a - c, end_b - d, 0)) >= n:
            continue
        c, d, n = c + cut, d + cut, n - cut
        wrong += edits(x[end_a:c].tolist(), y[end_b:d].tolist()) if c > end_a and d > end_b else c - end_a + d - end_b
        wrong += unlike(x[c : c + n], y[d : d + n])
        end_a, end_b = c + n, d + n
    return end_a, end_b, wrong


Side = tuple[np.ndarray, np.ndarray, np.ndarray]  # the words of all, and where each one's begin and end


#: So many chains or pairs are extended at once: some 2 kB each.
AT_ONCE = 2000


def _extended(x: Side, y: Side, every: list[list[tuple[int, int, int]]]) -> list[tuple[int, int, int, int, float]]:
    """For each chain the stretches that it spans with its ends extended, and the identity over them."""
    if len(every) > AT_ONCE:
        part = lambda side, k: (side[0], side[1][k : k + AT_ONCE], side[2][k : k + AT_ONCE])
        return [found for k in range(0, len(every), AT_ONCE) for found in _extended(part(x, k), part(y, k), every[k : k + AT_ONCE])]
    begins = np.array([c[0][:2] for c in every], np.int64).reshape(-1, 2)
    cores = [core(x[0][x[1][k] : x[2][k]], y[0][y[1][k] : y[2][k]], c) for k, c in enumerate(every)]
    ends = np.array([c[:2] for c in cores], np.int64).reshape(-1, 2)
    beside = lambda at, step: [_beside(d, low, low + at[:, k], high, step, -1 - k) for k, (d, low, high) in enumerate((x, y))]
    left_x, left_y, missed = extend(*beside(begins, -1))
    right_x, right_y, missing = extend(*beside(ends, 1))
    wrong = np.array([c[2] for c in cores], np.int64) + missed + missing
    i, j, m, n = begins[:, 0] - left_x, ends[:, 0] + right_x, begins[:, 1] - left_y, ends[:, 1] + right_y
    return list(zip(i.tolist(), j.tolist(), m.tolist(), n.tolist(), (1 - wrong / np.maximum(j - i, n - m)).tolist(), strict=True))


def _stands(found: tuple[int, int, int, int, float]) -> bool:
    """Whether a stretch is long enough for a passage, and alike enough."""
    i, j, m, n, identity = found
    return max(j - i, n - m) >= LEAST and identity >= IDENTITY


def align(x: Side, y: Side, every: list[list[tuple[int, int, int]]]) -> list[tuple[int, int, int, int, int, float]]:
    """For each chain of segments (starts, length) its place in `every`, the stretches that it spans, and the identity over them. Where
    those of several segments fall short, each segment is extended by itself too, for what they cover together may be
    enough; where a single one does, the longest stretch on its diagonal is taken."""
    whole = _extended(x, y, every)
    out = [(k, *found) for k, found in enumerate(whole)]
    short = [(k, [part]) for k, chain in enumerate(every) if len(chain) > 1 and not _stands(whole[k]) for part in chain]
    if short:
        which = np.array([k for k, _ in short])
        of = lambda side: (side[0], side[1][which], side[2][which])
        out += [(k, *found) for (k, _), found in zip(short, _extended(of(x), of(y), [c for _, c in short]), strict=True)]
    for k, chain in enumerate(every):
        if len(chain) == 1 and not _stands(whole[k]) and (found := longest(x[0][x[1][k] : x[2][k]], y[0][y[1][k] : y[2][k]], *chain[0])):
            out[k] = (k, *found, IDENTITY)
    return out


def longest(x: np.ndarray, y: np.ndarray, a: int, b: int, n: int) -> tuple[int, int, int, int] | None:
    """The longest stretch of LEAST words or more on the diagonal of a segment (starts, length) that overlaps it, begins and
    ends with equal words, and has the identity asked for; where ends by score fall short of one."""
    low, high = -min(a, b), min(len(x) - a, len(y) - b)
    same = x[a + low : a + high] == y[b + low : b + high]
    if same.sum() < IDENTITY * LEAST:
        return None
    # a stretch has the identity if the sum of (equal - IDENTITY) over it isn't negative
    total = np.append(0, np.cumsum(same - IDENTITY))
    at = np.flatnonzero(same)
    begins, ends = at[at < n - low], at + 1
    if not len(begins):
        return None
    highest = np.maximum.accumulate(total[ends][::-1])  # of the ends from each on, the last first
    last = len(ends) - 1 - np.searchsorted(highest, total[begins] - 1e-9)  # the farthest end of each begin
    reach = ends[np.maximum(last, 0)]
    size = np.where((last >= 0) & (reach > -low), reach - begins, 0)
    best = size.argmax()
    if size[best] < LEAST:
        return None
    i, j = int(begins[best]) + low, int(reach[best]) + low
    return a + i, a + j, b + i, b + j


CHAINS = "a bigint, b bigint, a_from int, a_to int, b_from int, b_to int, starts array<int>, others array<int>, sizes array<int>"
PIECES = "doc bigint, first int, stop int, partner bigint, other int, other_stop int"
PIECE_NAMES = [x.split()[0] for x in PIECES.split(", ")]


def _matched(shared: DataFrame, scratch: C.Scratch) -> DataFrame:
    """Matches a < b, at, other of the occurrences of seeds; the k-th one in a document meets k-th ones."""
    key = ["seed", "turn"]
    own = F.struct("doc", "place")
    ends = shared.groupBy(*key).agg(F.min(own).alias("lo"), F.max(own).alias("hi"), F.count("*").alias("n")).where("n > 1")
    # joined and saved before they are grouped: only so can the join split a frequent seed
    met = scratch.save(shared.join(ends, key).select(F.xxhash64(*key).alias("key"), "doc", "place", "n", "lo", "hi"), "met")
    few = met.where(F.col("n") <= FEW).groupBy("key").agg(F.collect_list(own).alias("xs"))  # at most FEW
    few = few.select(F.explode(F.expr("flatten(transform(xs, x -> transform(filter(xs, y -> y.doc > x.doc), y -> struct(x.doc AS a, y.doc AS b, x.place AS at, y.place AS other))))")).alias("m")).select("m.*")
    side = lambda a, b, at, other: F.struct(F.col(a).alias("a"), F.col(b).alias("b"), F.col(at).alias("at"), F.col(other).alias("other"))
    many = met.where(F.col("n") > FEW).select(F.explode(F.array(side("lo.doc", "doc", "lo.place", "place"), side("doc", "hi.doc", "place", "hi.place"))).alias("m")).select("m.*").where("a <> b")
    return few.unionByName(many)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of each row a, b, matches."""
    for batch in C.slices(batches, 1000):
        column = batch.column(2)
        flat = column.flatten()
        row = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
        own, x, y, n, gain = segments(row, *(flat.field(k).to_numpy().astype(np.int64) for k in (0, 1)))
        bounds = np.searchsorted(own, np.arange(batch.num_rows + 1)).tolist()
        parts = list(zip(x.tolist(), y.tolist(), n.tolist(), gain.tolist(), strict=True))
        which, out = [], []
        for i in range(batch.num_rows):
            mine = parts[bounds[i] : bounds[i + 1]]
            for chain in chains(mine):
                which.append(i)
                out.append([mine[k] for k in chain])
        edge = lambda k, chain, end: max(0, chain[0][k] - REACH) if not end else chain[-1][k] + chain[-1][2] + REACH
        numbers = [pa.array([edge(k, c, end) for c in out], pa.int32()) for k in (0, 1) for end in (0, 1)]
        lists = [pa.array([[p[k] for p in c] for c in out], pa.list_(pa.int32())) for k in range(3)]
        kept = pa.array(which, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept), *numbers, *lists], names=[x.split()[0] for x in CHAINS.split(", ")])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of chains with both sides' words, a row for each side."""
    for batch in C.slices(batches, 1000):
        a, b, f, g, starts, others, sizes = (batch.column(i).to_pylist() for i in range(7))
        chains = [[(p - x, q - y, n) for p, q, n in zip(*c, strict=True)] for x, y, *c in zip(f, g, starts, others, sizes, strict=True)]
        sides = []
        for i in (7, 8):
            data, ends = C.flat(batch.column(i))
            sides.append((np.ascontiguousarray(data).view(np.uint16), ends[:-1] // 2, ends[1:] // 2))
        out = []
        for r, i, j, k, m, identity in align(*sides, chains):
            if min(j - i, m - k) >= PIECE and identity >= IDENTITY:
                out += [(a[r], f[r] + i, f[r] + j, b[r], g[r] + k, g[r] + m), (b[r], g[r] + k, g[r] + m, a[r], f[r] + i, f[r] + j)]
        yield _piece_batch(out)


def _piece_batch(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int32() if i % 3 else pa.int64()) for i in range(6)], names=PIECE_NAMES)


def _pieces(shared: DataFrame, reps: DataFrame, scratch: C.Scratch) -> DataFrame:
    grouped = _matched(shared, scratch).groupBy("a", "b").agg(F.collect_list(F.struct("at", "other")).alias("matches"))  # no more than the two documents' seeds
    found = scratch.save(grouped.mapInArrow(_chained, CHAINS), "chains")
    scratch.drop("met")
    held = reps.select("key", "words")
    cut = lambda side: F.expr(f"substring(words, 2 * {side}_from + 1, 2 * ({side}_to - {side}_from))")
    names = [x.split()[0] for x in CHAINS.split(", ")]
    one = found.join(held.withColumnRenamed("key", "a"), "a").select(*names, cut("a").alias("x"))
    both = one.join(held.withColumnRenamed("key", "b"), "b").select("a", "b", "a_from", "b_from", "starts", "others", "sizes", "x", cut("b").alias("y"))
    out = scratch.save(both.mapInArrow(_aligned, PIECES), "pieces")
    scratch.drop("chains")
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, digest, n_words and words, 16 bits of each word's hash, of rows doc_id, digest, text."""
    for batch in C.slices(batches):
        hashes, _, _, bounds, _, _ = words(batch.column(2))
        small, at = hashes.astype(np.uint16).view(np.uint8), (2 * bounds).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(bounds)), pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(at), pa.py_buffer(small)])], names=["doc_id", "digest", "n_words", "words"])


# -- passages ---------------------------------------------------------------------------------------
def _united(pieces: DataFrame, least: int) -> DataFrame:
    """node, doc, first, stop and firsts (of its pieces) of each stretch of `least` words or more that a
    document's overlapping or touching pieces make up."""
    longest = pieces.groupBy("doc", "first").agg(F.max("stop").alias("stop"))  # at most one for each word of the document
    grouped = longest.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("first", "stop"))).alias("xs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches):
            column = batch.column(1)
            flat, n = column.flatten(), column.value_lengths().to_numpy()
            first, stop = (flat.field(k).to_numpy().astype(np.int64) for k in (0, 1))
            row = np.repeat(np.arange(batch.num_rows), n)
            far = row << 33  # each document lies beyond the one before
            reach = np.maximum.accumulate(stop + far) if len(stop) else stop
            fresh = np.append(True, first[1:] + far[1:] > reach[:-1])
            head = np.flatnonzero(fresh[: len(first)])
            tail = np.append(head[1:], len(first)) - 1
            begin, end = first[head], reach[tail] - far[tail] if len(head) else head
            long = end - begin >= least
            sizes = np.where(long, tail - head + 1, 0)
            taken = np.repeat(long, tail - head + 1)
            firsts = C.lists(first[taken].astype(np.int32), np.append(0, np.cumsum(sizes[long])))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[head][long])), pa.array(begin[long].astype(np.int32)), pa.array(end[long].astype(np.int32)), firsts], names=["doc", "first", "stop", "firsts"])

    return grouped.mapInArrow(run, "doc bigint, first int, stop int, firsts array<int>").withColumn("node", F.monotonically_increasing_id())


def _labelled(pieces: DataFrame, scratch: C.Scratch, least: int, name: str) -> DataFrame:
    """node, doc, first, stop and label of the united stretches; equal labels are linked by pieces."""
    nodes = scratch.save(_united(pieces, least), f"nodes{name}")
    begins = scratch.save(nodes.select("doc", "node", F.explode("firsts").alias("first")), f"begins{name}")
    linked = pieces.where("doc < partner").select("doc", "first", "partner", "other").distinct()
    edges = linked.join(begins.withColumnRenamed("node", "a"), ["doc", "first"]).join(begins.select(F.col("doc").alias("partner"), F.col("first").alias("other"), F.col("node").alias("b")), ["partner", "other"]).select("a", "b")
    labels = components(edges, scratch, f"passage{name}")
    out = scratch.save(nodes.select("node", "doc", "first", "stop").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), f"labels{name}")
    scratch.drop(f"begins{name}")
    return out


def _windows(again: DataFrame, reps: DataFrame, scratch: C.Scratch, least: int) -> DataFrame:
    """Pieces of the windows of `least` words all of whose seeds are shared, and one of them to be looked at
    again, that several documents hold: each with the smallest of them, and its windows with the largest."""
    held = reps.select("key", "words").join(again.where(F.size("held") >= least // (2 * K - 2)), "key").select("key", "held", "words", "again")  # a window holds as many at least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, 200):
            hashes, bounds = _words(batch.column(2))
            _, text, place = seeds(hashes, bounds)
            column = batch.column(1)
            which = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            spare = np.zeros(len(hashes) + 1, np.int64)
            spare[bounds[text] + place + 1] = 1
            spare[bounds[which] + column.flatten().to_numpy() + 1] = 0
            spare = np.cumsum(spare)  # seeds before each word that no other document holds
            fresh = np.zeros(len(hashes) + 1, np.int64)
            column = batch.column(3)
            fresh[bounds[np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())] + column.flatten().field(0).to_numpy() + 1] = 1
            fresh = np.cumsum(fresh)
            n = max(0, len(hashes) - least + 1)
            of = np.searchsorted(bounds, np.arange(n), "right") - 1
            fine = (np.arange(n) + least <= bounds[of + 1]) & (spare[least - K + 1 : least - K + 1 + n] == spare[:n]) & (fresh[least - K + 1 : least - K + 1 + n] > fresh[:n])
            at = np.flatnonzero(fine)
            key = np.zeros(len(at), np.uint64)
            for j in range(least):
                key = key * _P + hashes[at + j] + np.uint64(1)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of[at])), pa.array(C.mix(key).view(np.int64)), pa.array((at - bounds[of[at]]).astype(np.int32))], names=["doc", "window", "first"])

    found = scratch.save(held.mapInArrow(run, "doc bigint, window bigint, first int"), "windows")
    own = F.struct("doc", "first")
    ends = scratch.save(found.groupBy("window").agg(F.min(own).alias("lo"), F.max(own).alias("hi")).where("lo.doc < hi.doc"), "window_ends")
    met = found.join(ends, "window").select(own.alias("x"), F.when(F.col("doc") == F.col("lo.doc"), F.col("hi")).otherwise(F.col("lo")).alias("y"))
    row = lambda x, y: F.struct(F.col(f"{x}.doc").alias("doc"), F.col(f"{x}.first").alias("first"), (F.col(f"{x}.first") + least).alias("stop"), F.col(f"{y}.doc").alias("partner"), F.col(f"{y}.first").alias("other"), (F.col(f"{y}.first") + least).alias("other_stop"))
    out = scratch.save(met.select(F.explode(F.array(row("x", "y"), row("y", "x"))).alias("r")).select("r.*").distinct(), "exact")
    for name in ("windows", "window_ends"):
        scratch.drop(name)
    return out


def _apart(shared: DataFrame, labelled: DataFrame, scratch: C.Scratch) -> DataFrame:
    """key, held and again: places of a document's shared seeds, and place and label of those of them whose holders aren't
    all in one passage, for documents with one of the latter. What is in no passage has a label of its document. unmet
    tells that not all of the seed's occurrences have met each other, holders is a mark of who holds it."""
    per_doc = C.small(scratch.save(labelled.groupBy("doc").agg(F.collect_list(F.struct("first", "stop", "label")).alias("nodes")), "per_doc"))  # bounded by the document's length
    own = F.expr(f"try_element_at(filter(nodes, x -> x.first <= place AND place + {K} <= x.stop), 1).label")
    placed = scratch.save(shared.join(per_doc, "doc", "left").select("seed", "doc", "place", "turn", F.coalesce(own, -1 - F.col("doc")).alias("label")), "placed")
    mixed = placed.groupBy("seed").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"), F.max("turn").alias("turn"), F.min("doc").alias("a"), F.max("doc").alias("b")).where("lo < hi")
    mixed = scratch.save(mixed.select("seed", ((F.col("n") > FEW) | (F.col("turn") > 0)).alias("unmet"), F.xxhash64("n", "a", "b", F.when(F.col("turn") > 0, F.col("seed"))).alias("holders")), "mixed")  # what repeats in a document isn't told by who holds it
    flagged = placed.join(C.small(mixed).withColumn("mixed", F.lit(True)), "seed", "left")
    per_doc = flagged.groupBy(F.col("doc").alias("key")).agg(F.collect_set("place").alias("held"), F.collect_set(F.when(F.col("mixed"), F.struct("place", "label", "unmet", "holders"))).alias("again"))  # bounded by the document's length
    out = scratch.save(per_doc.where(F.size("again") > 0), "again")
    for name in ("per_doc", "placed", "mixed"):
        scratch.drop(name)
    return out


CONTEXT = "seed bigint, doc bigint, place int, label bigint, after binary, before binary"
#: Whether an occurrence is looked at by what follows it, and by what is before it.
ENDS = "last boolean, first boolean"


def _contexts(again: DataFrame, reps: DataFrame) -> DataFrame:
    """Each occurrence of a seed that is looked at again and whose occurrences haven't all met, with REACH words after it and before it (backwards), as big-endian
    numbers, so that their bytes are in the order of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, 200):
            hashes, bounds = _words(batch.column(1))
            column = batch.column(2)
            row = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            place, label, unmet, holders = (column.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(4))
            order = np.lexsort((place, row))
            order = order[unmet[order].astype(bool)]
            # where those who hold a seed hold the next one too, they are told apart there
            differs = (row[order][1:] != row[order][:-1]) | (holders[order][1:] != holders[order][:-1])
            ends = np.append(differs, True)[: len(order)], np.append(True, differs)[: len(order)]
            some = ends[0] | ends[1]
            row, place, label = (x[order][some] for x in (row, place, label))
            last, first = (pa.array(e[some]) for e in ends)
            at = bounds[row] + place
            place, label = pa.array(place), pa.array(label)
            own = np.zeros(len(at), np.uint64)
            for j in range(K):
                own = own * _P + hashes[at + j]
            for k in range(0, len(at), 10_000):
                part = slice(k, k + 10_000)
                low, high = bounds[row[part]], bounds[row[part] + 1]
                sides = [_beside(hashes, low, at[part] + K * (step > 0), high, step, 0) for step in (1, -1)]
                # lengths tell how many of them there are
                known = [np.clip(high - at[part] - K, 0, REACH), np.clip(at[part] - low, 0, REACH)]
                packed = [pa.array([w[: 2 * n] for w, n in zip(map(bytes, side.astype(">u2")), count.tolist(), strict=True)], pa.binary()) for side, count in zip(sides, known, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(C.mix(own[part]).view(np.int64)), batch.column(0).take(pa.array(row[part])), place.slice(k, 10_000), label.slice(k, 10_000), *packed, last.slice(k, 10_000), first.slice(k, 10_000)], names=[x.split()[0] for x in f"{CONTEXT}, {ENDS}".split(", ")])

    return again.join(reps.select("key", "words"), "key").select("key", "words", "again").mapInArrow(run, f"{CONTEXT}, {ENDS}")


def _neighbours(seed: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of ordered occurrences of one seed in two documents: of each two runs of one document that
    follow each other, the last of the one with all of the other, and the first of the other with all of the one."""
    head = np.flatnonzero(np.append(True, (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])))
    run = np.zeros(len(seed), np.int64)
    run[head[1:]] = 1
    run = np.cumsum(run)
    tail = np.append(head[1:], len(seed)) - 1
    i = np.arange(len(seed))
    later = i[run > 0]  # with the last of the run before
    earlier = i[(run < len(head) - 1) & (i != tail[run])]  # with the first of the run after; its last has met it
    a, b = np.append(tail[run[later] - 1], earlier), np.append(later, head[run[earlier] + 1])
    same = seed[a] == seed[b]
    return a[same], b[same]


def _met(rows: tuple[np.ndarray, ...], texts: tuple[pa.Array, pa.Array], a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """The pieces around the seeds of pairs of occurrences that have different labels."""
    _, doc, place, label = rows
    apart = label[a] != label[b]
    a, b = a[apart], b[apart]
    reach = []
    for column in texts:
        data, ends = C.flat(column)
        data, ends = np.ascontiguousarray(data).view(">u2").astype(np.int32), ends // 2
        reach.append(extend(*(_beside(data, ends[x], ends[x], ends[x + 1], 1, absent) for x, absent in ((a, -1), (b, -2)))))
    (right_a, right_b, wrong), (left_a, left_b, missed) = reach
    i, j, m, n = place[a] - left_a, place[a] + K + right_a, place[b] - left_b, place[b] + K + right_b
    span = np.maximum(j - i, n - m)
    fine = (np.minimum(j - i, n - m) >= PIECE) & (span - (wrong + missed) >= IDENTITY * span)
    out = [x[fine] for x in (doc[a], i, j, doc[b], m, n)]
    both = [np.append(x, y) for x, y in zip(out, out[3:] + out[:3], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64 if k % 3 == 0 else np.int32)) for k, x in enumerate(both)], names=PIECE_NAMES)


def _beside_each_other(contexts: DataFrame, scratch: C.Scratch) -> DataFrame:
    """Pieces of occurrences that are neighbours when the occurrences of a seed are put in the order of the words after
    it, and in that of the words before it: of all occurrences, neighbours share the most words there."""
    names = [x.split()[0] for x in CONTEXT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, ended = None, None, False
        batches = iter(C.slices(batches, AT_ONCE))
        while not ended:
            batch = next(batches, None)
            ended = batch is None
            if batch is not None:
                held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            if held is None or not len(held):
                return
            columns = [held.column(k).chunk(0) for k in range(6)]
            rows = tuple(c.to_numpy() for c in columns[:4])
            first = held.slice(0, 1) if first is None else first
            a, b = _neighbours(*rows[:2])
            head = np.flatnonzero(np.append(True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])))
            last = len(rows[0]) if ended else head[-1]  # the last run may go on
            fresh = (a < last) & (b < last)
            a, b = a[fresh], b[fresh]
            for k in range(0, len(a), AT_ONCE):
                yield _edged(_met(rows, (columns[4], columns[5]), a[k : k + AT_ONCE], b[k : k + AT_ONCE]), None)
            keep = head[-2] if len(head) > 1 else 0
            if ended:
                edge = pa.concat_tables([first, held.slice(len(held) - 1, 1)])
                yield _edged(_piece_batch([]), edge.combine_chunks())
            held = held.slice(keep)

    def _edged(pieces: pa.RecordBatch, edge: pa.Table | None) -> pa.RecordBatch:
        n = pieces.num_rows + (2 if edge is not None else 0)
        of = lambda k, kind: pa.concat_arrays([pieces.column(k), pa.nulls(n - pieces.num_rows, kind)])
        kinds = [pa.int64(), pa.int32(), pa.int32()] * 2
        more = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        edges = [pa.concat_arrays([pa.nulls(pieces.num_rows, kind), edge.column(k).chunk(0).cast(kind)]) if edge is not None else pa.nulls(n, kind) for k, kind in enumerate(more)]
        return pa.RecordBatch.from_arrays([*(of(k, kind) for k, kind in enumerate(kinds)), *edges], names=[*PIECE_NAMES, *(f"edge_{x}" for x in names)])

    out = None
    for side, end in (("after", "last"), ("before", "first")):
        order = ["seed", side, "doc", "place"]
        sorted_ = contexts.where(end).select(*names).repartitionByRange(*order).sortWithinPartitions(*order)
        schema = f"{PIECES}, " + ", ".join(f"edge_{x}" for x in CONTEXT.split(", "))
        found = sorted_.mapInArrow(run, schema).withColumn("part", F.spark_partition_id())
        found = scratch.save(found, f"beside_{side}")
        # the last occurrence of a range meets the first of the next: two rows for each range
        edges = found.where("edge_seed IS NOT NULL").select("part", *(F.col(f"edge_{x}").alias(x) for x in names)).toArrow().to_pandas().sort_values("part", kind="stable")
        ends = pa.Table.from_pandas(edges[names].reset_index(drop=True), schema=pa.schema([("seed", pa.int64()), ("doc", pa.int64()), ("place", pa.int32()), ("label", pa.int64()), ("after", pa.binary()), ("before", pa.binary())]), preserve_index=False).combine_chunks()
        across = np.arange(1, len(edges) - 1, 2)
        pieces = found.where("doc IS NOT NULL").select(*PIECE_NAMES)
        if len(across):
            columns = [ends.column(k).chunk(0) for k in range(6)]
            rows = tuple(c.to_numpy() for c in columns[:4])
            fits = (rows[0][across] == rows[0][across + 1]) & (rows[1][across] != rows[1][across + 1])
            met = _met(rows, (columns[4], columns[5]), across[fits], across[fits] + 1)
            pieces = pieces.unionByName(contexts.sparkSession.createDataFrame(pa.Table.from_batches([met]), PIECES)) if met.num_rows else pieces
        out = pieces if out is None else out.unionByName(pieces)
    return out


def _spans(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """node, start and end, in characters, of stretches of words."""
    per_doc = nodes.groupBy(F.col("doc").alias("key")).agg(F.collect_list(F.struct("node", "first", "stop")).alias("xs"))  # bounded by the document's length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, 200):
            _, starts, stops, bounds, data, ends = words(batch.column(1))
            column = batch.column(0)
            text = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            flat = column.flatten()
            node, first, stop = (flat.field(k) for k in range(3))
            at = bounds[text]
            yield pa.RecordBatch.from_arrays([node, *(pa.array(C.characters(data, ends, x, text).astype(np.int64)) for x in (starts[at + first.to_numpy()], stops[at + stop.to_numpy() - 1]))], names=["node", "start", "end"])

    return per_doc.join(texts, "key").select("xs", "text").mapInArrow(run, "node bigint, start bigint, end bigint")


def find(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """A row for each row of docs: doc_id, class_id (the smallest doc_id with the same text), n_words,
    n_repeated (words in passages), spans array<struct<start,end>> in characters, partners
    array<bigint> (some documents that hold one of its passages: for each, the least and the largest of those
    it was aligned with), passages array<struct<start,end,passage_id,n_holders>>: what else holds one is
    each row that names the same passage_id, and n_holders is the number of rows of docs that do. All
    rows of a class_id share a whole text; that is in no passage_id unless another class shares it."""
    spark = C.prepare(docs.sparkSession)
    scratch = C.Scratch(spark, "passages")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    digest = F.unhex(F.md5(F.col("text").cast("binary")))
    noted = scratch.save(rows.select("doc_id", digest.alias("digest"), F.length("text").cast("long").alias("n_chars")), "noted")
    # one row a text: its words as 16-bit hashes, and who holds it
    hashed = rows.withColumn("digest", digest).select("doc_id", "digest", "text").mapInArrow(_hashed, "doc_id bigint, digest binary, n_words bigint, words binary")
    reps = hashed.groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.max("doc_id").alias("last"), F.count("doc_id").alias("n"), F.max("n_words").alias("n_words"), F.max("words").alias("words"))
    reps = scratch.save(reps, "plain")
    # different texts of one doc_id are told apart by other keys than the doc_id
    heads = reps.groupBy("class_id").agg(F.min("digest").alias("head"), F.count("*").alias("same"))
    if heads.where("same > 1 AND class_id IS NOT NULL").limit(1).count():
        key = F.when(F.col("digest") == F.col("head"), F.col("class_id")).otherwise(F.xxhash64("class_id", "digest"))
        reps = scratch.save(reps.join(heads.where("class_id IS NOT NULL"), "class_id", "left").select("digest", "class_id", "last", "n", "n_words", "words", key.alias("key")), "keyed")
    else:
        reps = reps.withColumn("key", F.col("class_id"))
    classes = reps.where("class_id IS NOT NULL").select("digest", "class_id", "last", "n", "key")
    words_of = reps.select("digest", "n_words")
    reps = reps.where((F.col("n_words") >= PIECE) & F.col("class_id").isNotNull())
    size = noted.agg(F.coalesce(F.sum("n_chars"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, size // RANGE_CHARS)
    shared = scratch.save(shared_seeds(seed(reps, buckets), buckets), "shared")
    pieces = _pieces(shared, reps, scratch)
    again = _apart(shared, _labelled(pieces, scratch, least, "1"), scratch)
    scratch.drop("shared")
    contexts = scratch.save(_contexts(again, reps), "contexts")
    pieces = scratch.save(pieces.unionByName(_beside_each_other(contexts, scratch)).unionByName(_windows(again, reps, scratch, least)), "all")
    for name in ("contexts", "beside_after", "beside_before"):
        scratch.drop(name)
    named = _labelled(pieces, scratch, least, "2")
    copies = classes.select(F.col("key").alias("doc"), "n", "class_id")
    held = named.select("label", "doc").distinct().join(copies, "doc").groupBy("label").agg(F.sum("n").alias("n_holders"))
    holders = C.small(scratch.save(named.select("doc").distinct().join(classes.select(F.col("key").alias("doc"), "digest", F.col("class_id").alias("doc_id")), "doc"), "holders"))
    texts = rows.withColumn("digest", digest).join(holders, ["digest", "doc_id"]).groupBy(F.col("doc").alias("key")).agg(F.first("text").alias("text"))  # a text each
    spans = scratch.save(_spans(named, texts), "spans")
    placed = named.join(spans, "node")
    first = placed.groupBy("label").agg(F.min(F.struct("doc", "start")).alias("head"))
    names = first.join(held, "label").select("label", F.concat_ws(":", "head.doc", "head.start").alias("passage_id"), "n_holders")
    # partners of a stretch: its pieces lie between its ends
    met = pieces.groupBy("doc", "first").agg(F.min("partner").alias("p"), F.max("partner").alias("q")).groupBy("doc").agg(F.collect_list(F.struct("first", "p", "q")).alias("met"))
    inside = F.expr("filter(met, x -> x.first >= first AND x.first < stop)")
    known = named.join(met, "doc").select("node", F.explode(F.array(F.array_min(F.transform(inside, lambda x: x["p"])), F.array_max(F.transform(inside, lambda x: x["q"])))).alias("doc"))
    known = known.join(copies.select("doc", "class_id"), "doc").groupBy("node").agg(F.collect_set("class_id").alias("partners"))
    per_doc = placed.join(names, "label").join(known, "node").groupBy("doc").agg(
        F.sum(F.col("stop") - F.col("first")).alias("n_repeated"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("partners")))).alias("partners"), F.array_sort(F.collect_list(F.struct("start", "end", "passage_id", "n_holders"))).alias("passages")
    )
    per_class = words_of.join(classes.join(per_doc.withColumnRenamed("doc", "key"), "key", "left"), "digest", "left")
    out = noted.join(scratch.save(per_class, "per_class"), "digest", "left").withColumns({c: F.when(F.col("doc_id").isNotNull(), F.col(c)) for c in ("class_id", "last", "n_repeated", "partners", "passages")})
    copied = F.coalesce((F.col("last") > F.col("class_id")) & (F.col("n_words") >= least), F.lit(False))
    none = F.expr("cast(array() as array<bigint>)")
    no_passage = F.expr("cast(array() as array<struct<start:bigint,end:bigint,passage_id:string,n_holders:bigint>>)")
    found = F.coalesce("passages", no_passage)
    twin = F.when(F.col("doc_id") == F.col("class_id"), F.col("last")).otherwise(F.col("class_id"))
    known = F.coalesce(F.col("partners"), none)
    return out.select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_repeated", F.lit(0))).cast("long").alias("n_repeated"),
        F.when(copied, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_chars").alias("end")))).otherwise(F.transform(found, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))).alias("spans"),
        F.when(copied, F.array_sort(F.array_union(known, F.array(twin)))).otherwise(known).alias("partners"),
        found.alias("passages"),
    )


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(C.table(spark, sf_dir, "documents"))
    shown = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", "class_id", "n_words", "n_repeated", shown.alias("spans"), "partners", "passages")
