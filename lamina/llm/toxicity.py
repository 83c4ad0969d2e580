"""Toxicity: a linear-chain conditional random field tags toxic words; the forward-backward
marginals add up to a document's score and give the offending offsets.

Labels are of documents, so the words they are learned from are labelled first: in a toxic document,
a word is toxic if it, or a prefix of it, stands out in the toxic training documents by
document-frequency log-odds; every other word isn't. The field has two states, weights on a word's
identity and its prefixes of 4 to 7 characters, and transitions; it maximises the labels' conditional
likelihood. A logistic layer on (log expected number, highest marginal, log expected share), fitted on
training documents that the field hasn't seen and weighted to the labelled base rate, makes the score.

Training reads at most SAMPLE labelled documents of each class, those with the lowest hash of their
doc_id, of at most SAMPLE_CHARS characters each; it is the one bounded sample here. Scoring reads
every word of every text. Labels, lang, source and doc_id are no inputs of a score.

Null and empty texts have no words and the score of a text without toxic words. Long texts are tagged whole, in a task's memory. Rows are scored one
by one: ties, repeated rows and extra columns don't matter; `keep` refuses the names of the results. An
empty table gives no rows. With fewer than eight labelled documents, or none of one
class, nothing can be learned and every score is UNLEARNED.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm import _common as C

SAMPLE, SAMPLE_CHARS = 700, 20_000
THRESHOLD = 0.3
#: The score of every text where nothing can be learned: under the threshold, so nothing is rejected.
UNLEARNED = 0.1
PREFIXES = (4, 5, 6, 7)
WORD = C.members((48, 57), (97, 122), (128, 255))
BLOCK = 64
#: Words that share a prefix, and the log of how many times as common they are, for the prefix to count.
VARIED, RATE = 12, 2.5


def features(word: bytes) -> list[str]:
    own = word.decode(errors="replace")
    return ["=" + own] + [own[:n] for n in PREFIXES if len(own) > n]


def chain(scores: np.ndarray, first: np.ndarray, transition: np.ndarray, start: np.ndarray):
    """Marginals of state 1 and, for words that aren't the first of their text, of pairs of states.

    scores: log weight of state 1 against state 0 for each word; first: whether a word begins a
    text. A text's first word has the same matrix row for either state before it, so what lies
    before is forgotten and all texts of a batch make one chain. It is cut into blocks that advance
    together; only the product of each block is passed on one by one.
    """
    n = len(scores)
    count = -(-n // BLOCK)
    one = np.zeros(count * BLOCK)
    one[:n] = np.clip(scores, -30, 30)
    one = 1 / (1 + np.exp(-one))
    fresh = np.ones(count * BLOCK, bool)
    fresh[:n] = first
    by_block = lambda x: np.ascontiguousarray(x.reshape(count, BLOCK).T)
    entries = [by_block(np.where(fresh, start[j], transition[i, j]) * (one if j else 1 - one)) for i in (0, 1) for j in (0, 1)]
    steps = list(zip(*entries, strict=True))  # for each place in a block, the four entries of every block's matrix
    p, q, r, s = np.ones(count), np.zeros(count), np.zeros(count), np.ones(count)
    for a, b, c, d in steps:
        p, q, r, s = p * a + q * c, p * b + q * d, r * a + s * c, r * b + s * d
        total = p + q + r + s
        p, q, r, s = p / total, q / total, r / total, s / total
    whole = list(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True))
    into, outof = np.empty((2, count)), np.empty((2, count))
    x, y = 0.5, 0.5
    for k, (a, b, c, d) in enumerate(whole):
        into[:, k] = x, y
        x, y = x * a + y * c, x * b + y * d
        x, y = x / (x + y), y / (x + y)
    x, y = 0.5, 0.5
    for k in range(count - 1, -1, -1):
        a, b, c, d = whole[k]
        outof[:, k] = x, y
        x, y = a * x + b * y, c * x + d * y
        x, y = x / (x + y), y / (x + y)
    forward, backward = np.empty((BLOCK, 2, count)), np.empty((BLOCK, 2, count))
    x, y = into
    for i, (a, b, c, d) in enumerate(steps):
        x, y = x * a + y * c, x * b + y * d
        total = x + y
        x, y = x / total, y / total
        forward[i] = x, y
    x, y = outof
    for i in range(BLOCK - 1, -1, -1):
        a, b, c, d = steps[i]
        backward[i] = x, y
        x, y = a * x + b * y, c * x + d * y
        total = x + y
        x, y = x / total, y / total
    (f0, f1), (b0, b1) = ([z[:, j].T.ravel()[:n] for j in (0, 1)] for z in (forward, backward))
    marginal = f1 * b1 / (f0 * b0 + f1 * b1)
    later = np.flatnonzero(~fresh[:n])
    later = later[later > 0]
    pairs = np.stack([f[later - 1] * entries[2 * i + j].T.ravel()[later] * g[later] for i, f in enumerate((f0, f1)) for j, g in enumerate((b0, b1))], axis=1)
    return marginal, (pairs / pairs.sum(axis=1, keepdims=True)).reshape(-1, 2, 2), later


def words_of(texts: pa.Array):
    """Starts, ends, text of each word, the distinct words and each word's number among them."""
    data, ends = C.flat(texts)
    starts, stops, text, own = C.runs(C.lower_ascii(data), ends, WORD)
    return data, ends, starts, stops, text, own.dictionary.to_pylist(), own.indices.to_numpy()


class Tagger:
    """Weights of the field and of the layer that makes the score; small, and sent to the workers."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.bias, self.transition, self.start = -10.0, np.full((2, 2), 0.5), np.full(2, 0.5)
        self.layer, self.center = np.zeros(3), float(np.log(UNLEARNED / (1 - UNLEARNED)))

    def emissions(self, words: list[bytes]) -> np.ndarray:
        get = self.weights.get
        return np.array([self.bias + sum(get(f, 0.0) for f in features(w)) for w in words])

    def tag(self, texts: pa.Array):
        data, ends, starts, stops, text, words, which = words_of(texts)
        if not len(starts):
            return np.zeros((len(texts), 3)), data, ends, starts, stops, text, np.zeros(0)
        first = np.append(True, text[1:] != text[:-1])
        marginal, _, _ = chain(self.emissions(words)[which], first, self.transition, self.start)
        n = len(texts)
        expected, count = np.bincount(text, marginal, n), np.maximum(np.bincount(text, minlength=n), 1)
        highest = np.zeros(n)
        np.maximum.at(highest, text, marginal)
        return np.stack([np.log1p(expected), highest, np.log1p(100 * expected / count)], axis=1), data, ends, starts, stops, text, marginal

    def score(self, summary: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary @ self.layer + self.center, -30, 30)))


def fit(texts: list[str], labels: np.ndarray, base_rate: float, rounds: int = 30) -> Tagger:
    """Trains on three of four sampled documents and fits the score's layer on the fourth."""
    own = Tagger()
    labels = np.asarray(labels, np.int64)
    if len(labels) < 8 or labels.min() == labels.max():
        return own
    learn = np.arange(len(labels)) % 4 != 3
    _, _, _, _, text, words, which = words_of(pa.array([t for t, x in zip(texts, learn, strict=True) if x]))
    toxic = labels[learn] == 1
    number: dict[str, int] = {}
    flat, begin = array("i"), array("i", [0])
    for w in words:
        flat.extend(number.setdefault(f, len(number)) for f in features(w))
        begin.append(len(flat))
    flat, begin = np.array(flat, np.int64), np.array(begin, np.int64)
    of = np.repeat(np.arange(len(words)), np.diff(begin))
    # in how many documents of each class is a feature?
    pair = np.unique(text.astype(np.int64) * len(words) + which)
    doc, word = pair // len(words), pair % len(words)
    counts = np.diff(begin)[word]
    seen = np.unique(np.repeat(doc, counts) * len(number) + C.gather(flat, begin[word], counts))
    by_toxic = [np.bincount((seen % len(number))[toxic[seen // len(number)] == c], minlength=len(number)) for c in (False, True)]
    odds = np.log((by_toxic[1] + 0.5) / (toxic.sum() + 1)) - np.log((by_toxic[0] + 0.5) / ((~toxic).sum() + 1))
    # words that only copies of a few documents share are no evidence
    used = by_toxic[1] + by_toxic[0] >= max(4, 0.01 * len(toxic))
    # twenty times as common where toxic, by documents, or by words if several words share the prefix in
    # several documents: a few documents that are copies of each other share few words of any prefix
    often = (odds > 3) & (by_toxic[1] >= max(4, 0.06 * toxic.sum(), min(15, 0.15 * toxic.sum())))
    in_class = [np.bincount(which[toxic[text] == c], minlength=len(words)) for c in (False, True)]
    by_words = [np.bincount(flat, c[of], len(number)) + 0.5 for c in in_class]
    rates = np.log(by_words[1] / in_class[1].sum()) - np.log(by_words[0] / in_class[0].sum())
    varied = np.bincount(flat, (in_class[1] > 0)[of], len(number)) >= VARIED
    marked = often | (varied & (rates > RATE) & (by_toxic[1] >= max(4, 0.01 * toxic.sum())))
    word_marked = np.zeros(len(words), bool)
    np.logical_or.at(word_marked, of, marked[flat])
    gold = word_marked[which] & toxic[text]
    keep = used[flat]
    of, flat = of[keep], (np.cumsum(used) - 1)[flat[keep]]
    names = [f for f, i in number.items() if used[i]]
    n_words = len(words)
    del number, words, seen, pair, doc, word, counts, begin, odds, by_toxic
    first = np.append(True, text[1:] != text[:-1])
    weights, grads = np.zeros(len(names)), np.full(len(names), 1e-8)
    bias, bias_grad = -3.0, 1e-8
    table, start = np.log(np.array([[0.95, 0.05], [0.7, 0.3]])), np.log(np.array([0.95, 0.05]))
    gold_words = np.bincount(which, gold, n_words)
    is_toxic = gold.astype(np.int64)
    for _ in range(rounds):
        emission = bias + np.bincount(of, weights[flat], n_words)
        marginal, pairs, later = chain(emission[which], first, np.exp(table), np.exp(start))
        off = np.bincount(which, marginal, n_words) - gold_words
        gradient = np.bincount(flat, off[of], len(names)) + 0.5 * weights
        grads += gradient**2
        weights -= 1.0 * gradient / np.sqrt(grads)
        bias_grad += off.sum() ** 2
        bias -= off.sum() / np.sqrt(bias_grad)
        # transitions: expected counts against observed ones, each row a distribution again
        observed = np.bincount(is_toxic[later - 1] * 2 + is_toxic[later], minlength=4).reshape(2, 2) + 1.0
        expected = pairs.sum(axis=0) + 1.0
        table += 0.5 * np.log(observed / expected)
        table -= np.log(np.exp(table).sum(axis=1, keepdims=True))
    begin_share = (is_toxic[first].sum() + 1) / (first.sum() + 2)
    own.weights = {f: float(w) for f, w in zip(names, weights, strict=True) if abs(w) > 1e-3}
    own.bias, own.transition, own.start = float(bias), np.exp(table), np.array([1 - begin_share, begin_share])
    rest = [t for t, x in zip(texts, learn, strict=True) if not x]
    summary = own.tag(pa.array(rest, pa.string()))[0]
    own.layer, own.center = _logistic(summary, labels[~learn], base_rate)
    return own


def _logistic(x: np.ndarray, y: np.ndarray, base_rate: float) -> tuple[np.ndarray, float]:
    """Newton's method, a small ridge, the classes weighted to the base rate; slopes not negative."""
    weight = np.where(y == 1, base_rate / max(1, (y == 1).sum()), (1 - base_rate) / max(1, (y == 0).sum())) * len(y)
    free, w = np.ones(x.shape[1], bool), None
    while True:
        z = np.column_stack([x * free, np.ones(len(x))])
        w = np.zeros(z.shape[1])
        w[-1] = np.log(base_rate / (1 - base_rate))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            ridge = np.append(np.full(x.shape[1], 0.1), 1e-3)
            step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (weight * (p - y)) + ridge * w)
            w = w - np.clip(step, -3, 3)
        wrong = free & (w[:-1] < 0)
        if not wrong.any():
            return w[:-1] * free, float(w[-1])
        free &= ~wrong


def held_out(key: str = "doc_id"):
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Tagger:
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__toxic"))
    counts = {r["__toxic"]: r["count"] for r in known.groupBy("__toxic").count().collect()}
    rate = min(0.99, max(0.01, counts.get(1, 0) / sum(counts.values()))) if counts else 0.5
    chosen = None
    for label in (0, 1):
        own = known.where(F.col("__toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = own if chosen is None else chosen.unionByName(own)
    # at most 2 * sample rows of 12 bytes
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS)).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "__toxic").agg(F.min("text").alias("text")).toPandas().sort_values("doc_id")
    order = np.argsort(((rows["doc_id"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)), kind="stable") if len(rows) else []
    rows = rows.iloc[order]
    return fit(rows["text"].tolist(), rows["__toxic"].to_numpy(), rate)


def tag(docs: DataFrame, tagger: Tagger, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns of `keep`, score double and spans array<struct<start,end>>: the stretches of words
    that are likelier toxic than not, in characters."""
    spark = C.prepare(docs.sparkSession)
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*C.kept(docs, keep, "score", "spans"), T.StructField("score", T.DoubleType()), T.StructField("spans", span)])
    part = spark.sparkContext.broadcast(tagger)  # of bounded size: it grows with the sample only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = part.value
        for batch in C.slices(batches):
            summary, data, ends, starts, stops, of, marginal = own.tag(batch.column(batch.num_columns - 1))
            where = np.flatnonzero(marginal > 0.5)
            apart = (np.diff(where) != 1) | (of[where[1:]] != of[where[:-1]])
            edge = np.ones(min(1, len(where)), bool)
            head, tail = where[np.concatenate([edge, apart])], where[np.concatenate([apart, edge])]
            spans = pa.StructArray.from_arrays([pa.array(C.characters(data, ends, x, of[head]).astype(np.int32)) for x in (starts[head], stops[tail])], names=["start", "end"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(own.score(summary)), pa.ListArray.from_arrays(pa.array(np.searchsorted(of[head], np.arange(batch.num_rows + 1)).astype(np.int32)), spans)], names=schema.names)

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def reject(docs: DataFrame, tagger: Tagger, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col("text"))
    return tag(rows, tagger, keep=("__row",)).where(F.col("score") < threshold).select("__row.*")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    docs = C.table(spark, sf_dir, "documents")
    found = tag(docs, train(docs, C.table(spark, sf_dir, "labels")))
    shown = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.array_join(shown, ",").alias("spans"))
