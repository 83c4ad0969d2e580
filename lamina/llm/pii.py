"""Personal data: base patterns, and a skip-chain conditional random field for what they leave out.

The nodes of a document's field are its units: address-like words, dotted quads and number groups of
seven digits or more, each labelled none, email, ip, card or phone. Neighbouring units share a chain
potential. Units that repeat (the same letters and digits, the same last ten digits) or nearly do
(one digit or the domain differs) share a skip potential, however far apart: each is linked to the first
unit with its key, so a document with many of them has as many edges and what is known of one reaches all
others in two steps. Sum-product messages pass over all edges of a batch at once, half of each message
kept, until they settle or ROUNDS times; units that a base span covers are
observed. A unit likelier of a kind than none adds its span.

Weights: those of a unit's shape and both kinds of potential are fitted together, by the gradient of the field's
pseudo-likelihood (each unit's label given its neighbours'), on the units of at most SAMPLE documents (those with
the lowest hash of doc_id among those of at most SAMPLE_CHARS characters; of rows that share a doc_id, the least text), labelled by
the base spans. A unit that no base span covers may yet be of a kind, so it counts half, and not at all if it
repeats one that a span covers: what such a pair's labels are is for the field to say. Before any data, repeats share a
label by odds of AGREE. That sample is the only bounded one; every text is scanned whole.

Null and empty texts have no spans; long ones are scanned whole, in a task's memory. Rows are independent; ties, repeated rows and extra columns don't
matter, and an empty table gives no rows; `keep` refuses the names of the results. Positions are code
points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm import _common as C

KINDS = ("email", "ip", "card", "phone")
SAMPLE, SAMPLE_CHARS = 4_000, 20_000
FEATURES, ROUNDS, SETTLED = 1 << 12, 50, 1e-3
N_FEATURES = 11  # of a unit
#: Log odds, before any data, that repeats have one label.
AGREE = 4.0
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
UNIT = re.compile(r"[A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+|[0-9]+(?:\.[0-9]+){3}|[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}")
NOT_DIGIT = re.compile(r"[^0-9]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    own = [ord(c) - 48 for c in reversed(digits)]
    return (sum(own[::2]) + sum(_DOUBLED[d] for d in own[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """An address can only begin in the run of local characters before an at sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at + 1)):
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(unit: str, before: str) -> list[int]:
    digits = NOT_DIGIT.sub("", unit)
    size = len(digits)
    parts = unit.split(".")
    named = [f"n{min(size, 20)}", f"at{'@' in unit}", f"dot{'.' in unit.partition('@')[2]}", f"plus{unit[0] == '+'}", f"paren{'(' in unit}", f"luhn{13 < size < 20 and luhn(digits)}", f"four{len(parts) == 4 and '@' not in unit}", f"small{len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)}", f"sep{''.join(sorted({c for c in unit if not c.isalnum()}))}", f"w{before.lower()}", "bias"]
    return [xxhash.xxh32_intdigest(x) % FEATURES for x in named]


def keys(unit: str) -> list[tuple]:
    """Units that share a key are linked."""
    if "@" in unit:
        return [("@", unit.lower()), ("@", unit.lower().partition("@")[0])]
    digits = NOT_DIGIT.sub("", unit)
    if unit.count(".") == 3:
        return [("ip", unit), *(("ip", i, unit[:i] + unit[i + 1 :]) for i in range(len(unit)))]
    out: list[tuple] = [("d", digits[-10:])]
    return out + [("x", i, digits[:i] + digits[i + 1 :]) for i in range(len(digits))] if len(digits) <= 24 else out


def graph(texts: list[str]):
    """Units (text, start, end), their observed label (0 none or unknown, else 1 + kind), whether it
    is observed, their features, and chain and skip edges between units."""
    units, labels, features, chain, skip, base = [], [], [], set(), set(), []
    for k, text in enumerate(texts):
        own = base_spans(text)
        base.append(own)
        seen: dict[tuple, int] = {}
        first = len(units)
        reach = list(accumulate((e for _, _, e in own), max))
        for m in UNIT.finditer(text):
            i = len(units)
            a, b = m.span()
            i_own = bisect_right(reach, a)  # the first base span that ends behind a
            cover = own[i_own][1] + 1 if i_own < len(own) and own[i_own][0] < b else 0
            units.append((k, a, b))
            labels.append(cover)
            features.append(shape(m[0], text[max(0, a - 24) : a].split()[-1:][0] if text[max(0, a - 24) : a].split() else ""))
            if i > first:
                chain.add((i - 1, i))
            for key in keys(m[0]):
                if (j := seen.setdefault(key, i)) != i:
                    skip.add((j, i))
    both = [np.array(sorted(x), np.int64).reshape(-1, 2) for x in (chain, skip)]
    return units, np.array(labels, np.int64), np.array(features, np.int64).reshape(len(units), N_FEATURES), both[0], both[1], base


class Field:
    """Weights of the softmax layer and log potentials of the two kinds of edge."""

    def __init__(self):
        n = len(KINDS) + 1
        self.weights = np.zeros((FEATURES, n))
        self.chain, self.skip = np.zeros((n, n)), AGREE * np.eye(n)

    def fit(self, labels: np.ndarray, features: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int = 150) -> Field:
        """Ascends the pseudo-likelihood, with a ridge towards where the field stands."""
        if not len(labels):
            return self
        n = len(KINDS) + 1
        # a unit that no base span covers but that repeats one that a span does is of unknown label: left out
        hidden = np.zeros(len(labels), bool)
        for a, b in ((0, 1), (1, 0)):
            hidden[skip[labels[skip[:, b]] > 0, a]] = True
        hidden &= labels == 0
        gold = np.eye(n)[labels] * ~hidden[:, None]
        weight = np.where(hidden, 0.0, np.where(labels == 0, 0.5, 1.0))[:, None]
        start = {name: getattr(self, name).copy() for name in ("weights", "chain", "skip")}
        sums = {name: np.full_like(x, 1e-8) for name, x in start.items()}

        def around(edges: np.ndarray) -> np.ndarray:
            """How many neighbours of each label each unit has."""
            out = np.zeros((len(labels), n))
            for a, b in ((0, 1), (1, 0)):
                np.add.at(out, edges[:, a], gold[edges[:, b]])
            return out

        near = {"chain": around(chain), "skip": around(skip)}
        for _ in range(rounds):
            score = self.weights[features].sum(axis=1) + sum(x @ getattr(self, name) for name, x in near.items())
            off = weight * (_softmax(score) - gold)
            gradients = {name: (x.T @ off + off.T @ x) / 2 for name, x in near.items()}
            gradients["weights"] = np.zeros_like(self.weights)
            np.add.at(gradients["weights"], features.ravel(), np.repeat(off, features.shape[1], axis=0))
            for name, gradient in gradients.items():
                gradient += 0.05 * (getattr(self, name) - start[name])
                sums[name] += gradient**2
                setattr(self, name, getattr(self, name) - 0.3 * gradient / np.sqrt(sums[name]))
        return self

    def marginals(self, labels: np.ndarray, features: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Loopy sum-product in logs over all edges at once."""
        n = len(KINDS) + 1
        # an unexplained unit's own evidence is what its shape says, tempered: its label was a guess
        unary = 0.5 * self.weights[features].sum(axis=1)
        observed = labels > 0
        unary[observed] = -20.0
        unary[observed, labels[observed]] = 20.0
        edges = np.concatenate([chain, skip])
        if not len(edges):
            return _softmax(unary)
        potential = np.concatenate([np.broadcast_to(self.chain, (len(chain), n, n)), np.broadcast_to(self.skip, (len(skip), n, n))])
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        potential = np.concatenate([potential, potential.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((len(source), n))
        for _ in range(ROUNDS):
            before = message
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = (belief[source] - message[back])[:, :, None] + potential
            top = out.max(axis=1)
            fresh = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            message = 0.5 * message + 0.5 * (fresh - fresh.max(axis=1, keepdims=True))
            if np.abs(message - before).max() < SETTLED:
                break
        belief = unary.copy()
        np.add.at(belief, target, message)
        return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def find(texts: list[str], field: Field) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Base spans, and those that the field adds, of each text."""
    units, labels, features, chain, skip, base = graph(texts)
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if units:
        likely = field.marginals(labels, features, chain, skip)
        for i in np.flatnonzero((labels == 0) & (likely[:, 1:].max(axis=1) > 0.5)):
            k, a, b = units[i]
            added[k].append((a, int(likely[i, 1:].argmax()), b))
    return list(zip(base, added, strict=True))


def train(docs: DataFrame, sample: int = SAMPLE) -> Field:
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike("@|[0-9]{2}"))
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = [r["text"] for r in rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").toLocalIterator()]  # a text for each document of the sample
    _, labels, features, chain, skip, _ = graph(texts)
    return Field().fit(labels, features, chain, skip)


def scan(docs: DataFrame, field: Field, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns of `keep`, base and added: array<struct<start,kind,end>>, kind a place in KINDS."""
    spark = C.prepare(docs.sparkSession)
    part = spark.sparkContext.broadcast(field)  # 160 kB
    kind = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "kind", "end")]))
    schema = T.StructType([*C.kept(docs, keep, "base", "added"), T.StructField("base", kind), T.StructField("added", kind)])
    span = pa.list_(pa.struct([(c, pa.int32()) for c in ("start", "kind", "end")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = part.value
        for batch in C.slices(batches):
            texts = batch.column(batch.num_columns - 1)
            chosen = pc.fill_null(pc.or_(pc.match_substring(texts, "@"), pc.match_substring_regex(texts, "[0-9]{2}|[0-9][. (+)-][0-9. ()-]")), False)
            where = np.flatnonzero(chosen.to_numpy(zero_copy_only=False))
            found = dict(zip(where.tolist(), find(texts.filter(chosen).to_pylist(), own), strict=True))
            columns = [pa.array([[dict(zip(("start", "kind", "end"), s, strict=True)) for s in found[i][j]] if i in found else [] for i in range(batch.num_rows)], span) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    found = scan(docs, train(docs))
    names = F.array(*map(F.lit, KINDS))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)), F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.array_sort(F.concat("base", "added"))).alias("spans"))
