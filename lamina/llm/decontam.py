"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, met by every
window of the documents' words.

Words are runs of characters other than ASCII signs, A-Z lower-cased. A window is `window`
consecutive words of an item, or all its words where it has fewer but some. The windows of at most
BLOCK_CHARS characters of benchmark are broadcast at a time; a larger benchmark is met block by
block and the hits are united, so nothing is dropped and no broadcast outgrows the bound. Windows
are found by a rolling hash and each hit is verified on the words themselves.

Null or empty texts have no words and no hits, and long ones are scanned whole, in a task's memory; items without words have no windows. Items
without an id count for hits and spans, but are in no list of items. Repeated items,
repeated rows and columns beyond those named don't matter; `keep` refuses the names of the results.
Rows are independent of each other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm import _common as C

#: Characters of benchmark text whose windows are broadcast at once.
BLOCK_CHARS = 2_000_000
WORD = C.members((48, 57), (97, 122), (128, 255))
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class Windows:
    """The windows of a block of items: for each length a sorted array of hashes, the word numbers
    of each window, and the items that hold it."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        self.words: dict[bytes, int] = {}
        held: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            data = C.lower_ascii(np.frombuffer((text or "").encode(), np.uint8))
            _, _, _, own = C.runs(data, np.array([0, len(data)]), WORD)
            ids = [self.words.setdefault(w, len(self.words)) for w in own.to_pylist()]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                held.setdefault(tuple(ids[i : i + size]), set()).update(() if item is None else (item,))
        self.sizes: dict[int, tuple[int, np.ndarray, np.ndarray, list[list[int]]]] = {}
        for size in sorted({len(w) for w in held}):
            own = [w for w in held if len(w) == size]
            ids = np.array(own, np.uint64)
            for mix in _MIX:  # one under which no two windows share a hash
                hashes = rolling(ids.ravel(), np.arange(len(own)) * size, size, mix)
                if len(np.unique(hashes)) == len(own):
                    break
            else:
                raise ValueError("no hash tells the windows apart")
            order = np.argsort(hashes)
            self.sizes[size] = mix, hashes[order], ids[order], [sorted(held[own[i]]) for i in order]

    def hits(self, ids: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids: the number of each word, -1 if no item has it. For each occurrence of a window and
        each item that holds it: the first word, the end, the item and whether it has an id."""
        n, found = len(ids), []
        broken = np.append(0, np.cumsum(ids < 0))
        numbers = ids.astype(np.uint64)
        for size, (mix, hashes, words, items) in self.sizes.items():
            if n < size:
                continue
            at = np.flatnonzero((broken[size:] == broken[:-size]) & (texts[size - 1 :] == texts[: n - size + 1]))
            if not len(at):
                continue
            own = rolling(numbers, at, size, mix)
            place = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            same = hashes[place] == own
            at, place = at[same], place[same]
            same = (numbers[at[:, None] + np.arange(size)] == words[place]).all(axis=1)
            found += [(a, a + size, item or 0, item is not None) for a, p in zip(at[same].tolist(), place[same].tolist(), strict=True) for item in items[p] or [None]]
        return tuple(np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4


def rolling(ids: np.ndarray, at: np.ndarray, size: int, mix: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        out = out * np.uint64(mix) + ids[at + j] + np.uint64(1)
    return out


def scan(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 10, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The columns of `keep`, n_words long, n_hit long, items array<bigint> (distinct, ascending) and
    spans array<struct<start,end>>, the stretches of hit words in characters."""
    spark = C.prepare(docs.sparkSession)
    size = benchmark.agg(F.coalesce(F.sum(F.length(item_text)), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_chars))
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    C.kept(docs, keep, "n_words", "n_hit", "items", "spans", "__text")
    found = {"n_words": "bigint", "n_hit": "bigint", "items": "array<bigint>", "spans": span}
    state = docs.select(*keep, *(F.lit(None).cast(kind).alias(c) for c, kind in found.items()), F.col(text).cast("string").alias("__text"))
    scratch = C.Scratch(spark, "decontam")
    for k in range(blocks):
        own = benchmark.where(F.pmod(F.xxhash64(F.coalesce(F.col(item), F.xxhash64(item_text))), F.lit(blocks)) == k) if blocks > 1 else benchmark
        rows = own.select(F.col(item).cast("long"), F.col(item_text).cast("string")).collect()  # bounded by block_chars
        state = state.mapInArrow(_meet(spark.sparkContext.broadcast(Windows([tuple(r) for r in rows], window)), state.columns, first=not k), state.schema)
        if k + 1 < blocks:  # one block at a time is in memory
            state = scratch.save(state, f"block{k}")
    return state.drop("__text")


def _meet(part, names: list[str], first: bool):
    """Adds what one block of the benchmark hits to what those before it have hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = part.value
        get = windows.words.get
        for batch in C.slices(batches):
            n = batch.num_rows
            data, ends = C.flat(batch.column(batch.num_columns - 1))
            starts, stops, texts, own = C.runs(C.lower_ascii(data), ends, WORD)
            ids = np.array([get(w, -1) for w in own.dictionary.to_pylist()], np.int64)[own.indices.to_numpy()] if len(starts) else starts
            a, b, items, named = windows.hits(ids, texts)
            hit = np.zeros(len(starts) + 1, np.int64)
            np.add.at(hit, a, 1)
            np.add.at(hit, b, -1)
            hit = np.cumsum(hit)[:-1] > 0
            pairs = np.stack([texts[a], items], axis=1)[named > 0]
            if not first:
                old_items, old_spans = batch.column(batch.num_columns - 3), batch.column(batch.num_columns - 2)
                pairs = np.concatenate([pairs, np.stack([np.repeat(np.arange(n), old_items.value_lengths().to_numpy()), old_items.flatten().to_numpy()], axis=1)])
                ends_of = np.append(0, np.cumsum((data & 0xC0) != 0x80))[ends[:-1]]
                where = np.repeat(np.arange(n), old_spans.value_lengths().to_numpy())
                covered = np.zeros(int(((data & 0xC0) != 0x80).sum()) + 1, np.int64)
                old = old_spans.flatten()
                np.add.at(covered, old.field(0).to_numpy() + ends_of[where], 1)
                np.add.at(covered, old.field(1).to_numpy() + ends_of[where], -1)
                hit |= np.cumsum(covered)[np.cumsum((data & 0xC0) != 0x80)[starts] - 1] > 0 if len(starts) else hit
            pairs = np.unique(pairs, axis=0)
            item_ends = np.searchsorted(pairs[:, 0], np.arange(n + 1))
            where = np.flatnonzero(hit)
            apart = (np.diff(where) != 1) | (texts[where[1:]] != texts[where[:-1]])
            edge = np.ones(min(1, len(where)), bool)
            head, tail = where[np.concatenate([edge, apart])], where[np.concatenate([apart, edge])]
            spans = pa.StructArray.from_arrays([pa.array(C.characters(data, ends, x, texts[head]).astype(np.int32)) for x in (starts[head], stops[tail])], names=["start", "end"])
            span_ends = pa.array(np.searchsorted(texts[head], np.arange(n + 1)).astype(np.int32))
            counts = [pa.array(np.bincount(x, minlength=n).astype(np.int64)) for x in (texts, texts[hit])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-5], *counts, C.lists(pairs[:, 1], item_ends), pa.ListArray.from_arrays(span_ends, spans), batch.column(batch.num_columns - 1)], names=names)

    return run


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with their own columns."""
    own = docs.columns
    found = scan(docs.select(F.struct(*own).alias("__row"), F.col(options.pop("text", "text")).alias("text")), benchmark, keep=("__row",), **options)
    return found.where("n_hit = 0").select("__row.*")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP10_SQL = r"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
        FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, n, item_id FROM g JOIN win USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
