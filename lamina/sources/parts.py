"""One large JSON document read in parallel.

A document is one object whose fields hold arrays of objects. It is one file, or lies in several that follow each other by their names, each of
which ends with a `}`, so that no task need write or read it whole. It is read as text, cut at `}`, so Spark splits the files as
it splits any text file. Whether a split begins inside a string, and how deep, isn't known to the task that reads it: a first
pass gives, for either case, how it ends and by how much the depth changes, and these few numbers for each
split are put together in order. With its beginning known, each split then gives the elements that lie in it, and the parts of
those that it cuts, which are joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.operators.graph import saved

_TOKEN = re.compile(r'("[^"\\]*(?:\\.[^"\\]*)*")|("[^"\\]*(?:\\.[^"\\]*)*\Z)|[{}\[\]:]', re.S)
_REST = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)


def _tokens(text: str, inside: bool) -> Iterator[tuple[int, int, str]]:
    """Begin, end and kind of what counts in a text that may begin inside a string: brackets, colons, `"` for a string, and `'` for one
    that is not yet over at the end. A string that the text begins in is no token."""
    at = 0
    if inside:
        m = _REST.match(text)
        if m is None:
            yield 0, len(text), "'"
            return
        at = m.end()
    for m in _TOKEN.finditer(text, at):
        yield m.start(), m.end(), m[0] if m.lastindex is None else '"' if m.lastindex == 1 else "'"


def _depths(text: str, inside: bool) -> tuple[bool, int]:
    """Whether the text ends inside a string, and by how much the depth changes in it."""
    depth, over = 0, False
    for _, _, kind in _tokens(text, inside):
        depth += (kind in "{[") - (kind in "}]")
        over = kind == "'"
    return over, depth


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """block and value: texts up to a closing brace (without it), in order within each block of a file. Blocks are named so that the order of
    their names is that of the document."""
    block = F.format_string("%s:%019d", F.col("_metadata.file_name"), F.col("_metadata.file_block_start"))
    return spark.read.option("lineSep", "}").text(path).select(block.alias("block"), "value", F.col("_metadata.file_size").alias("size"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)


def _ends(pieces: DataFrame) -> dict[str, tuple[bool, int]]:
    """Whether each block begins inside a string, and how deep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {}
        for batch in batches:
            for block, text, size, length in zip(*(batch.column(i).to_pylist() for i in range(3)), pc.binary_length(batch.column(1)).to_pylist(), strict=True):
                own = found.setdefault(block, [[False, 0], [True, 0], size, 0])
                own[3] += length + 1
                for state in own[:2]:
                    state[0], change = _depths(text + "}", state[0])
                    state[1] += change
        rows = [(b, *x, *y, *sizes) for b, (x, y, *sizes) in found.items()]
        kinds = (pa.string(), pa.bool_(), pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["block", "a", "i", "b", "j", "size", "n"])

    inside, depth, out, files = False, 0, {}, {}
    for r in sorted(pieces.mapInArrow(run, "block string, a boolean, i int, b boolean, j int, size bigint, n bigint").collect()):  # a row for each split of a file
        file = r["block"].rpartition(":")[0]
        files[file] = files.get(file, r["size"]) - r["n"]
        out[r["block"]] = (inside, depth)
        inside, depth = (r["b"], depth + r["j"]) if inside else (r["a"], depth + r["i"])
    if loose := [file for file, left in list(files.items())[:-1] if left]:  # what follows their last brace would be taken to end with another one
        raise ValueError(f"files of a document, but for the last, end with a closing brace: {loose[:3]}")
    return out


PARTS = "block string, n int, field string, begins boolean, ends boolean, value string"


def _elements(pieces: DataFrame, begin: dict[str, tuple[bool, int]]) -> DataFrame:
    """The elements of the arrays, or the parts of them that lie in a block. n counts those of a block; field is null where the block
    begins inside the array."""

    def walk(rows: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        now, held = None, []
        for block, text in rows:
            if block != now:
                if held:
                    yield (now, n, field, begins, False, "".join(held))
                now, n, field, said, begins = block, 0, None, None, False
                inside, depth = begin[block]
                held = []
            text, at = text + "}", 0
            known = depth > 2  # within an element
            over = False
            for a, b, kind in _tokens(text, inside):
                over = kind == "'"
                if kind == '"' and depth == 1:
                    said = text[a + 1 : b - 1]
                elif kind == ":" and depth == 1:
                    field = said
                elif kind in "{[":
                    depth += 1
                    if depth == 3 and not known:
                        at, known, begins = a, True, True
                elif kind in "}]":
                    depth -= 1
                    if depth == 2 and known:
                        held.append(text[at:b])
                        yield (block, n, field, begins, True, "".join(held))
                        held, known, begins, n = [], False, False, n + 1
            inside = over
            if known:
                held.append(text[at:])
        if held:
            yield (now, n, field, begins, False, "".join(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.string())
        held, size = [], 0
        for row in walk(_blocks(batches)):
            held.append(row)
            size += len(row[-1])
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in PARTS.split(", ")])
                held, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in PARTS.split(", ")])

    return pieces.select("block", "value").mapInArrow(run, PARTS)


def items(spark: SparkSession, path: str, field: str, element: str) -> DataFrame:
    """ord and the columns of the objects (schema `element`) in the array that a field of the document at `path`, one file or a folder of files in order of their names, holds, in
    order. The parts of an element that splits cut are at most one for each end of a split."""
    pieces = _pieces(spark, path)
    parts = saved(_elements(pieces, _ends(pieces)))  # read several times below
    # two rows for each split at most, but for the counts
    of_block = parts.groupBy("block").agg(F.count_if("begins").alias("n"), F.max_by("field", "n").alias("last")).collect()
    offsets, fields, seen, last = {}, {}, 0, None
    for r in sorted(of_block):
        offsets[r["block"]], fields[r["block"]] = seen, last
        seen, last = seen + r["n"], r["last"] or last
    if not offsets:
        return spark.createDataFrame([], f"ord bigint, {element}")
    mapped = lambda values: F.element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), F.col("block"))
    first = {b: f if f is not None else "" for b, f in fields.items()}
    parts = parts.withColumn("field", F.coalesce("field", mapped(first))).withColumn("place", F.struct("block", "n"))
    whole = parts.where("begins AND ends").select("place", "field", "value")
    cut = parts.where("NOT (begins AND ends)").withColumn("__g", F.sum(F.col("begins").cast("int")).over(Window.orderBy("place")))
    joined = cut.groupBy("__g").agg(F.min_by("field", "place").alias("field"), F.min("place").alias("place"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]), "").alias("value"))
    both = whole.unionByName(joined.select("place", "field", "value")).where(F.col("field") == field)
    # an element's number: those that begin in earlier blocks, and those of its own before it that begin there
    opening = parts.where("NOT begins").select(F.col("block").alias("__b")).distinct()
    placed = both.select("place.*", "value").join(F.broadcast(opening), F.col("block") == F.col("__b"), "left")  # a row for each split at most
    order = mapped(offsets) + F.col("n") - F.when(F.col("__b").isNotNull(), 1).otherwise(0)
    numbered = placed.withColumn("__o", order.cast("long"))
    least = numbered.agg(F.min("__o")).first()[0] or 0
    return numbered.select((F.col("__o") - least).alias("ord"), F.from_json("value", element, {"mode": "FAILFAST"}).alias("x")).select("ord", "x.*")
