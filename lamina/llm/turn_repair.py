"""Repair of the turn order of conversations by cost layers over a grammar of roles.

The initials of a repaired conversation's roles read `(s?(ua)+)?`. Rows are taken by turn (nulls first; ties
by role, then text). A row's first fault counts: blank (no character but white space), duplicate (role and
text seen earlier in the conversation), truncated (the last such character isn't `.`, `!` or `?`). Edits of a
row: Keep (0), Rerole to user or assistant (3), Delete (4, a must for blank and duplicate rows); anywhere an
Insert of an empty user or assistant row (3). A truncated row that isn't deleted adds 3.

A layer holds, for each place between the rows, the set of grammar states (a bitset) from which the rest can
be repaired at exactly that cost. Layers are made for rising cost, each from those 3, 4 and 6 below it, until
the first in which the start state stands before the first row: its number is the least cost. The
trace goes forwards from there: whichever edits lead to a state that the layer of the cost left holds are
cheapest, and the least in ASCII is taken (Delete, Insert, Keep, Rerole). An edit's initial fixes the next state, so
the trace gives the least audit.

Long conversations are cut. A chunk of CHUNK rows has a table of the least cost from each state before it to
each behind it, by the same layers; tables compose, so the costs behind each chunk are known before it
is traced, and work grows with the rows. A conversation of more than LONG rows is moreover parted over tasks,
by ranges of turns: what earlier ranges hold of its texts is found by an aggregate, ranges' tables and traces
are made apart, and only those of a conversation (16 numbers a range) meet. A digest of all its text is
a sequence by nature: it is made in one task, which streams the rows.

Null roles and texts count as one space, so they are blank. Turns that are null count for no gap. A null
conv_id is a conversation. Columns beyond the four are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm import _common as C

INSERT, REROLE, DELETE, CUT = 3, 3, 4, 3
CHUNK, LONG = 32, 10_000
#: A conversation's range is cut into parts of at most 2 ** PART rows.
PART = 16
SPACE, END = " \t\n\x0b\x0c\r", (".", "!", "?")
NONE = 1 << 60  # no way
#: Grammar states, as bits: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = 1, 2, 4, 8
STATES = (START, SYSTEM, USER, ASSISTANT)
NEXT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
MADE = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # what an insert or a rerole gives
ROLE = {"u": "user", "a": "assistant"}
#: Cost from each state behind the last row: after u an assistant is inserted, after s both.
LAST = (0, 2 * INSERT, INSERT, 0)
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def _before(initials: str) -> list[int]:
    """For each set of states, those from which one of the initials leads into it."""
    return [sum({q for (x, q), after in NEXT.items() if x in initials and after & held}) for held in range(16)]


def _any() -> list[int]:
    """The same for a row of whatever role is wanted."""
    return [sum(q for q in STATES if NEXT[MADE[q], q] & held) for held in range(16)]


#: A row's code: its initial (or -) if it's sound, in upper case if it's truncated, x if it must go.
KEPT = {c: _before(c.lower()) if c.lower() in "sua" else [0] * 16 for c in "suaSUA-_x"}
ANY = _any()


def code(initial: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "x"
    known = initial if initial in ("s", "u", "a") else "-"
    return known if fault != "truncated" else "_" if known == "-" else known.upper()


def _extra(c: str) -> int:
    return CUT if c.isupper() or c == "_" else 0


def layers(codes: str, behind: tuple[int, ...], done: Callable[[list[list[int]]], bool]) -> list[list[int]]:
    """Layer by layer, for each place in the codes, the states from which what follows costs exactly the layer's number;
    behind has the costs of the states behind the last row. Stops when done says so."""
    n, made = len(codes), []
    seeds = {}
    for q, cost in zip(STATES, behind, strict=True):
        seeds[cost] = seeds.get(cost, 0) | q
    nothing = [0] * (n + 1)
    below = lambda by: made[-by] if len(made) >= by else nothing
    while not made or not done(made):
        now = [0] * n + [seeds.get(len(made), 0)]
        less, least, lesser = below(INSERT), below(DELETE), below(REROLE + CUT)
        for i in range(n - 1, -1, -1):
            c = codes[i]
            held = least[i + 1] | ANY[less[i]]  # Delete, Insert
            if c != "x":
                cut = _extra(c)
                held |= KEPT[c][(less if cut else now)[i + 1]] | ANY[(lesser if cut else less)[i + 1]]
            now[i] = held
        made.append(now)
    return made


@lru_cache(1 << 14)
def bridge(codes: str) -> tuple[tuple[int, ...], ...]:
    """The least cost from each state before the codes (one at least) to each state behind them, if there is a way."""
    out = []
    for end in STATES:
        reach = START if end == START else SYSTEM | (START if "s" in codes.lower() else 0) if end == SYSTEM else 15
        seen = [0]

        def found(made: list[list[int]], seen: list[int] = seen, reach: int = reach) -> bool:
            seen[0] |= made[-1][0]
            return seen[0] & reach == reach

        made = layers(codes, tuple(0 if q == end else NONE for q in STATES), found)
        out.append([next((k for k, x in enumerate(made) if x[0] & q), NONE) for q in STATES])
    return tuple(zip(*out, strict=True))


def ahead(table: Iterable[Iterable[int]], behind: tuple[int, ...]) -> tuple[int, ...]:
    """The costs from each state before a part, by its table and the costs behind it."""
    return tuple(min(NONE, *(a + b for a, b in zip(row, behind, strict=True))) for row in table)


@lru_cache(1 << 14)
def trace(codes: str, behind: tuple[int, ...], state: int) -> tuple[int, str, int]:
    """The least cost from the state, the least of the cheapest audits, and the state behind. behind: costs, the smallest 0."""
    made = layers(codes, behind, lambda m: m[-1][0] & state)
    left, i, audit = len(made) - 1, 0, []
    cost = left
    while i < len(codes):
        c, made_role = codes[i], MADE[state]
        holds = lambda cost, place, q: cost >= 0 and bool(made[cost][place] & q)
        cut = _extra(c)
        kept = NEXT.get((c.lower(), state), 0) if c != "x" else 0
        if holds(left - DELETE, i + 1, state):
            audit.append("D")
            left, i = left - DELETE, i + 1
        elif holds(left - INSERT, i, NEXT[made_role, state]):
            audit.append("I")
            left, state = left - INSERT, NEXT[made_role, state]
        elif kept and holds(left - cut, i + 1, kept):
            audit.append("K")
            left, i, state = left - cut, i + 1, kept
        else:
            audit.append("R")
            left, i, state = left - REROLE - cut, i + 1, NEXT[made_role, state]
    return cost, "".join(audit), state


def chunks(codes: str) -> list[str]:
    return [codes[k : k + CHUNK] for k in range(0, len(codes), CHUNK)]


def behinds(parts: list[str], last: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The costs behind each part, and before the first, from those behind the last."""
    out = [last]
    for part in reversed(parts[1:]):
        out.append(ahead(bridge(part), out[-1]))
    return out[::-1]


def follow(codes: str, last: tuple[int, ...], state: int) -> tuple[int, str, int]:
    """trace() over any length, chunk by chunk. The cost includes that behind."""
    parts = chunks(codes)
    if not parts:
        return last[STATES.index(state)], "", state
    cost, audit, every = None, [], behinds(parts, last)
    for part, behind in zip(parts, every, strict=True):
        low = min(behind)
        found, piece, state = trace(part, tuple(min(b - low, NONE) for b in behind), state)
        cost = found + low if cost is None else cost
        audit.append(piece)
    return cost, "".join(audit), state


def table(codes: str) -> list[list[int]]:
    """bridge() over any length."""
    out = [[0 if p == q else NONE for q in range(4)] for p in range(4)]
    for part in chunks(codes):
        step = bridge(part)
        out = [[min(NONE, *(row[m] + step[m][q] for m in range(4))) for q in range(4)] for row in out]
    return out


def solve(codes: str) -> tuple[int, str]:
    """The least cost of a whole conversation, and the least of its cheapest audits."""
    cost, audit, state = follow(codes, LAST, START)
    return cost, audit + TAIL[state]


def applied(audit: str, rows: Iterable[tuple[str, str]], state: int = START) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) for each edit, of (role, text) rows; deleted rows have their own role and text."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit in "IR":
            role = ROLE[MADE[state]]
        yield edit, role, text
        if edit != "D":
            state = NEXT[role[0], state]


def fault(text: str) -> str:
    """blank, truncated or nothing; duplicates are found among rows."""
    body = text.rstrip(SPACE)
    return "blank" if not body else "" if body.endswith(END) else "truncated"


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LEGAL = {"su", "ua", "au"}
FOUND = T.StructType([T.StructField("conv_id", T.LongType()), *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("audit", T.StringType())])
ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=20).digest()


def _grouped(batches: Iterator[pa.RecordBatch], keys: int, rows: int = 2000) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows one after the other, as (key, the rest), from batches in order."""
    for batch in C.slices(batches, rows):
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield row[:keys], row[keys:]


class Conversation:
    """The rows of one conversation as they come: counts, codes, and the rows themselves if they are wanted."""

    def __init__(self, key):
        self.key, self.codes, self.rows, self.seen = key, [], [], set()
        self.turns, self.low, self.high, self.last, self.first = 0, None, None, None, None
        self.counts = dict.fromkeys(COUNTS, 0)

    def add(self, turn: int | None, role: str, text: str, again: bool | None = None) -> None:
        """again: whether role and text were seen earlier, if that is known from elsewhere; turns rise."""
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        found = fault(text)
        if again is None:
            mark = _digest(role, text)
            again = mark in self.seen
            self.seen.add(mark)
        if found != "blank" and again:
            found = "duplicate"
        if found:
            self.counts[found] += 1
        initial = role[:1]
        if self.first is None:
            self.first = initial
        else:
            self.counts["illegal"] += self.last + initial not in LEGAL
        self.last = initial
        self.codes.append(code(initial, found))

    def result(self) -> tuple:
        cost, audit = solve("".join(self.codes))
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return (self.key, gaps, *(self.counts[c] for c in COUNTS[1:-1]), cost, audit)


def _plain(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and there (false: the row only stands for its conversation)."""
    there = F.col("there") if "there" in turns.columns else F.lit(True)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), there.alias("there"))


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(arrow), arrow.types, strict=True)], schema=arrow)


def _flushed(rows: Iterator[tuple], schema: T.StructType, many: int = 2000, size: int = C.BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= many or total >= size:
            yield _batch(held, schema)
            held, total = [], 0
    yield _batch(held, schema)


def _short(rows: DataFrame, repaired: bool) -> DataFrame:
    """Conversations that a task holds one at a time: what is found, and with `repaired` the edits of each."""
    schema = T.StructType([*FOUND.fields, T.StructField("repaired_sha256", T.StringType())]) if not repaired else ROWS

    def results(c: Conversation) -> Iterator[tuple]:
        found = c.result()
        edits = applied(found[-1], c.rows)
        if repaired:
            yield from ((c.key, k, *e) for k, e in enumerate(edits))
        else:
            yield (*found, hashlib.sha256("\n".join(f"{role}:{text}" for edit, role, text in edits if edit != "D").encode()).hexdigest())

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for (key,), (turn, role, text, there, _) in _grouped(batches, 1):
            if now is None or key != now.key:
                if now is not None:
                    yield from results(now)
                now = Conversation(key)
            if there:
                now.add(turn, role, text)
                now.rows.append((role, text))
        if now is not None:
            yield from results(now)

    ordered = rows.select("conv_id", "turn", "role", "text", "there", "key").repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.mapInArrow(lambda batches: _flushed(every(batches), schema), schema)


def _digested(rows: DataFrame) -> DataFrame:
    """key and repaired_sha256 of repaired rows (key, place, edit, role, text), streamed in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            now, digest = None, None
            for (key,), (_, role, text) in _grouped(batches, 1):
                if key != now:
                    if now is not None:
                        yield now, digest.hexdigest()
                    now, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if now is not None:
                yield now, digest.hexdigest()

        yield from _flushed(each(), DIGEST)

    return rows.where("edit <> 'D'").select("key", "place", "role", "text").repartition("key").sortWithinPartitions("key", "place").mapInArrow(run, DIGEST)


DIGEST = T.StructType([T.StructField("key", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def _coded(rows: DataFrame) -> DataFrame:
    """The codes of each part of a conversation, its table of costs, and its illegal neighbours. rows: key, seg, place, initial, fault."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            now, codes, initials = None, [], []
            row = lambda: (*now, "".join(codes), [x for r in table("".join(codes)) for x in r], initials[0], initials[-1], sum(p + q not in LEGAL for p, q in zip(initials, initials[1:])))  # noqa: B023, B905, E731
            for key, (_, initial, found) in _grouped(batches, 2):
                if key != now:
                    if now is not None:
                        yield row()
                    now, codes, initials = key, [], []
                codes.append(code(initial, found))
                initials.append(initial)
            if now is not None:
                yield row()

        yield from _flushed(each(), CODED, 20)

    return rows.select("key", "seg", "place", "initial", "fault").repartition("key", "seg").sortWithinPartitions("key", "seg", "place").mapInArrow(run, CODED)


def _long(rows: DataFrame, scratch: C.Scratch) -> tuple[DataFrame, DataFrame]:
    """For conversations of any length: what is found (key, counts, audit), and repaired rows (key, conv_id, place, edit,
    role, text). rows: key, conv_id, turn, role, text."""
    body = F.rtrim("text", F.lit(SPACE))
    plain = F.when(body == "", "blank").when(~F.right(body, F.lit(1)).isin(*END), "truncated").otherwise("")
    order = (F.asc_nulls_first("turn"), "role", "text")
    place = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange("key", order[0]).sortWithinPartitions("key", *order).withColumn("place", place).withColumn("seg", F.shiftright("place", PART))
    ranged = ranged.withColumns({"initial": F.left("role", F.lit(1)), "plain": plain, "digest": F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)})
    turns = scratch.save(ranged, "turns")
    first = turns.groupBy("key", "digest").agg(F.min("place").alias("first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    again = scratch.save(turns.select("key", "digest", "place").join(first, ["key", "digest"]).where("place > first").select("place", F.lit(True).alias("again")), "again")
    marked = turns.select("key", "turn", "seg", "place", "initial", "plain").join(again, "place", "left")
    marked = scratch.save(marked.withColumn("fault", F.when((F.col("plain") != "blank") & F.col("again"), "duplicate").otherwise(F.col("plain"))), "marked")
    coded = scratch.save(_coded(marked), "coded")

    def backwards(parts: pd.DataFrame) -> pd.DataFrame:
        parts, costs, out = parts.sort_values("seg"), LAST, []
        for row in parts[::-1].itertuples():
            out.append((row.key, row.seg, list(costs)))
            costs = ahead([row.ways[k : k + 4] for k in (0, 4, 8, 12)], costs)
        return pd.DataFrame(out, columns=["key", "seg", "behind"])

    behind = coded.select("key", "seg", "ways").groupBy("key").applyInPandas(backwards, "key string, seg bigint, behind array<bigint>")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for (key, seg), (codes, costs) in _grouped(batches, 2, 20):
                ways = [follow(codes, tuple(costs), q) for q in STATES]
                yield key, seg, [w[0] for w in ways], [w[1] for w in ways], [w[2] for w in ways]

        yield from _flushed(each(), TRACED, 20)

    traces = scratch.save(coded.select("key", "seg", "codes").join(behind, ["key", "seg"]).mapInArrow(traced, TRACED), "traces")

    def forwards(parts: pd.DataFrame) -> pd.DataFrame:
        parts, state, out = parts.sort_values("seg"), START, []
        for k, row in enumerate(parts.itertuples(), 1):
            entry, state = state, int(row.exits[STATES.index(state)])
            out.append((row.key, row.seg, entry, TAIL[state] if k == len(parts) else ""))
        return pd.DataFrame(out, columns=["key", "seg", "entry", "tail"])

    entries = traces.select("key", "seg", "exits").groupBy("key").applyInPandas(forwards, "key string, seg bigint, entry int, tail string")
    index = F.array_position(F.array(*map(F.lit, STATES)), F.col("entry")).cast("int")
    audits = F.concat(F.element_at("audits", index), "tail")
    pieces = scratch.save(traces.join(entries, ["key", "seg"]).select("key", "seg", "entry", audits.alias("audit"), F.element_at("costs", index).alias("cost")), "pieces")

    def replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            edits, state, k, now = "", START, 0, None

            def inserted() -> Iterator[tuple]:
                """The inserts before the next row, or the last ones."""
                nonlocal state, k
                while k < len(edits) and edits[k] == "I":
                    made = MADE[state]
                    state, k = NEXT[made, state], k + 1
                    yield (*now, k, "I", ROLE[made], "")

            for (key, seg, place), (conv, role, text, entry) in _grouped(batches, 3):
                if place < 0:  # the part's audit, before its rows
                    if now is not None:
                        yield from inserted()
                    edits, state, k, now = text, entry, 0, (key, conv, seg)
                    continue
                now = (key, conv, seg)
                yield from inserted()
                edit, k = edits[k], k + 1
                if edit == "R":
                    role = ROLE[MADE[state]]
                if edit != "D":
                    state = NEXT[role[0], state]
                yield (*now, k, edit, role, text)
            if now is not None:
                yield from inserted()

        yield from _flushed(((key, conv, (seg << 20) + k, *rest) for key, conv, seg, k, *rest in each()), REPLAYED)

    headed = turns.select("key", "seg", "place", "conv_id", "role", "text", F.lit(None).cast("int").alias("entry"))
    headers = pieces.select("key", "seg", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("long").alias("conv_id"), F.lit("").alias("role"), F.col("audit").alias("text"), "entry")
    repaired = headed.unionByName(headers).repartition("key", "seg").sortWithinPartitions("key", "seg", "place").mapInArrow(replayed, REPLAYED)

    kinds = [F.count_if(F.col("fault") == c).alias(c) for c in ("blank", "duplicate", "truncated")]
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    counts = marked.groupBy("key").agg(gaps, *kinds)

    def seams(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("seg")
        across = sum(p + q not in LEGAL for p, q in zip(parts["last"][:-1], parts["first"][1:], strict=True))
        return pd.DataFrame([(parts["key"].iloc[0], int(parts["illegal"].sum()) + across)], columns=["key", "illegal"])

    illegal = coded.select("key", "seg", "first", "last", "illegal").groupBy("key").applyInPandas(seams, "key string, illegal bigint")
    audit = pieces.groupBy("key").agg(F.min_by("cost", "seg").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    found = counts.join(illegal, "key").join(audit, "key")
    return found, repaired


CODED = T.StructType([T.StructField("key", T.StringType()), T.StructField("seg", T.LongType()), T.StructField("codes", T.StringType()), T.StructField("ways", T.ArrayType(T.LongType())), T.StructField("first", T.StringType()), T.StructField("last", T.StringType()), T.StructField("illegal", T.LongType())])
TRACED = T.StructType([T.StructField("key", T.StringType()), T.StructField("seg", T.LongType()), T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType())), T.StructField("exits", T.ArrayType(T.IntegerType()))])
REPLAYED = T.StructType([T.StructField("key", T.StringType()), *ROWS.fields])


def _split(turns: DataFrame, long: int) -> tuple[DataFrame, DataFrame, DataFrame | None, C.Scratch]:
    """Rows with a key that is never null; those of short conversations; the keys of the long ones, if there are any."""
    spark = C.prepare(turns.sparkSession)
    scratch = C.Scratch(spark, "turn-repair")
    rows = _plain(turns).withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    many = scratch.save(rows.groupBy("key").agg(F.count("*").alias("n"), F.first("conv_id", True).alias("conv_id")).where(F.col("n") > long).drop("n"), "many")  # a row for each `long` rows at most
    if many.isEmpty():
        return rows, rows, None, scratch
    return rows, rows.join(C.small(many), "key", "left_anti"), many, scratch


def _parted(rows: DataFrame, many: DataFrame, scratch: C.Scratch) -> tuple[DataFrame, DataFrame]:
    return _long(rows.where("there").join(C.small(many.select("key")), "key", "left_semi").select("key", "conv_id", "turn", "role", "text"), scratch)


def repair(turns: DataFrame, long: int = LONG) -> DataFrame:
    """conv_id, place, edit, role, text: the edits of each conversation in order, rows as they are afterwards (deleted ones as they were)
    for rows conv_id, turn, role, text."""
    rows, short, many, scratch = _split(turns, long)
    out = _short(short, True)
    if many is not None:
        _, repaired = _parted(rows, many, scratch)
        out = out.unionByName(repaired.drop("key"))
    return out


def inspect(turns: DataFrame, long: int = LONG) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation. A column `there`
    that is false marks rows that only stand for their conversation."""
    rows, short, many, scratch = _split(turns, long)
    out = _short(short, False)
    if many is not None:
        found, repaired = _parted(rows, many, scratch)
        all_of = many.join(found, "key", "left").join(_digested(repaired), "key", "left")
        none = F.lit(hashlib.sha256().hexdigest())
        out = out.unionByName(all_of.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256")))
    return out


def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by crc32(conv_id:turn) % 20 (nulls: one space): 0 drops a row (`there` is false), 1 empties its text, 2 takes
    `[.!?]` from it, 3 repeats it, 4 makes its role user."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("there"), F.explode(copies).alias("__copy")).drop("__copy")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspect(damaged(C.table(spark, sf_dir, "conversations")))
