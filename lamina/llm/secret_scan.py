"""Secret scans with DataFrame functions only: patterns, and a randomness test battery for the rest.

Base spans are the leftmost non-overlapping matches of three patterns, kept where long enough. The
battery then looks at every run of 16 or more characters of [A-Za-z0-9+/_-] with a digit and a
letter. The smallest encoding that covers a run is inferred (hexadecimal, base 32, and letters with
digits, each of either case, letters of both cases with digits, base 64); against it three statistics are taken:
chi-squared uniformity of the symbols, runs above and below the middle of the alphabet, and serial
correlation at lag 1. The sum of their squared normal scores (of uniformity only an excess counts) has
the battery's p-value b, how seldom random symbols of that encoding fare worse, by a bound on the tail of chi-squared
with 3 degrees of freedom. How unlike ordinary text a run is gives its p-value: under LETTERS, 1 in x runs
has a likelihood ratio of x or more of a density against letters. The density is that of uniform
symbols times b ** POWER, so a run that fails the battery loses weight against random ones; p = ENCODINGS / ratio,
which shrinks with length. The p-values of all runs of the table are held to a false-discovery rate of
`rate` by the Benjamini-Hochberg rule within each length class, over counts of at most a few thousand
bins, whatever the table's size.

Null and empty texts have no spans; long ones are scanned whole, in time that grows with their length. Rows are independent but for the false-discovery bounds; ties,
repeated rows and extra columns don't matter, and an empty table gives no rows; `keep` refuses the names of the results. Positions are code
points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import _common as C

#: kind: (pattern, group whose length counts, least length). Fixed values.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # a longer run always matches whole, a shorter one would be dropped
}
#: What a text must hold, in lower case, to hold a match; these are far cheaper to look for.
HINTS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("akia",)}
KINDS = (*BASE, "random")
RUN = r"(?<![A-Za-z0-9+/_-])(?=[0-9+/_-]*[A-Za-z])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}"
_LOW, _UP, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = (_DIGITS + "abcdef", _DIGITS + "ABCDEF", _LOW + "234567", _UP + "234567", _DIGITS + _LOW, _DIGITS + _UP, _DIGITS + _UP + _LOW, _DIGITS + _UP + _LOW + "+/-_")
ENCODINGS = len(ALPHABETS)
#: Per cent of each letter from a to z in ordinary Latin-script text, in alphabetical order.
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.2, 0.8, 4.0, 2.4, 6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 1.0, 2.4, 0.2, 2.0, 0.1)
#: Shares of lower-case letters, upper-case letters, digits and the signs + / - _ in ordinary words.
SHARES = (0.88, 0.05, 0.05, 0.02)
POWER = 3
LENGTHS = (24, 40, 80)
TOP_BIN = 3000


def hinted(text: Column, kind: str) -> Column:
    """Whether a text may hold a match of the kind."""
    if kind == "random":
        return text.rlike("[A-Za-z0-9+/_-]{16}")
    out = F.lit(kind not in HINTS)
    for hint in HINTS.get(kind, ()):
        out = out | F.contains(F.lower(text), F.lit(hint))
    return out


def places(text: Column, pattern: str, group: int = 0, least: int = 0, ready: Column | None = None) -> Column:
    """array<struct<start,end>> of the leftmost non-overlapping matches whose group is long enough, in texts
    that are ready to be searched."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    size = lambda c: F.coalesce(F.length(c), F.lit(0))  # noqa: E731  the last gap has no match
    sized = F.transform(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value")), lambda x: F.struct(size(x["gap"]).alias("gap"), size(x["hit"]).alias("hit"), F.length(x["value"]).alias("value")))
    before = lambda xs: running(F.transform(xs, lambda x: x["gap"] + x["hit"]), lambda a, x: a + x)
    spans = lambda xs: F.zip_with(xs, before(xs), lambda x, at: F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + x["hit"]).alias("end"), (F.coalesce(x["value"], F.lit(-1)) >= max(0, least)).alias("fine")))
    found = _let(sized, lambda xs: F.transform(F.filter(spans(xs), lambda s: s["fine"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    return F.when((F.lit(True) if ready is None else ready) & text.rlike(pattern), found).otherwise(none)


def _let(x: Column, f) -> Column:
    """f(x), x worked out once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def running(xs: Column, step, block: int = 256) -> Column:
    """What step(state, x) makes, from 0, of all that is before each of an array's integers. Blocks are worked
    out apart, so the work grows with the array's length and not with its square."""

    def along(ys: Column) -> Column:
        state = F.expr("named_struct('at', 0, 'out', cast(array() as array<int>))")
        return F.aggregate(ys, state, lambda s, y: F.struct(step(s["at"], y).cast("int").alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))

    starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size(xs) - 1) / block).cast("int"), F.lit(0)))
    blocks = F.transform(starts, lambda b: along(F.slice(xs, b * block + 1, F.lit(block))))
    ahead = lambda bs: along(F.transform(bs, lambda b: b["at"]))["out"]
    return _let(blocks, lambda bs: F.flatten(F.zip_with(bs, ahead(bs), lambda b, at: F.transform(b["out"], lambda x: step(at, x).cast("int")))))


def _log_ordinary() -> Column:
    """A literal map from each symbol to the log of its share of ordinary text."""
    share = {c: SHARES[0] * p / sum(LETTERS) for c, p in zip(_LOW, LETTERS, strict=True)}
    share |= {c.upper(): SHARES[1] * share[c] / SHARES[0] for c in _LOW}
    share |= {c: SHARES[2] / 10 for c in _DIGITS} | {c: SHARES[3] / 4 for c in "+/-_"}
    return F.create_map(*(F.lit(x) for c, p in share.items() for x in (c, math.log(p))))


def judge(run: Column) -> Column:
    """struct<size, bin>: a run's length and floor(-10 log10 p)."""
    kind = F.when(run.rlike("^[0-9a-f]+$"), 0).when(run.rlike("^[0-9A-F]+$"), 1).when(run.rlike("^[a-z2-7]+$"), 2).when(run.rlike("^[A-Z2-7]+$"), 3).when(run.rlike("^[0-9a-z]+$"), 4).when(run.rlike("^[0-9A-Z]+$"), 5).when(run.rlike("^[0-9A-Za-z]+$"), 6).otherwise(7)
    let = _let
    total = lambda xs, f: F.aggregate(xs, F.lit(0.0), lambda a, x: a + f(x))
    n = F.length(run).cast("double")

    def battery(alphabet: Column, symbols: Column, ranks: Column, mean: Column) -> Column:
        size = F.length(alphabet).cast("double")
        counts = F.transform(F.array_distinct(symbols), lambda c: F.pow(n - F.length(F.replace(run, c, F.lit(""))), 2))
        chi = total(counts, lambda x: x) * size / n - n
        uniform = F.greatest((chi - (size - 1)) / F.sqrt(2 * (size - 1)), F.lit(0.0))
        high = F.transform(ranks, lambda r: F.when(r >= size / 2, 1.0).otherwise(0.0))
        # the pair beyond the end is null and counts as nothing
        changes = total(F.zip_with(F.slice(high, 2, F.length(run)), high, lambda a, b: F.abs(a - b)), lambda x: F.coalesce(x, F.lit(0.0)))
        expected = let(total(high, lambda x: x), lambda above: 2 * above * (n - above) / n + 1)
        runs = let(expected, lambda e: (changes + 1 - e) / F.sqrt(F.greatest((e - 1) * (e - 2) / (n - 1), F.lit(1e-9))))
        variance = F.greatest(total(ranks, lambda x: F.pow(x - mean, 2)), F.lit(1e-9))
        lagged = total(F.zip_with(F.slice(ranks, 2, F.length(run)), ranks, lambda a, b: (a - mean) * (b - mean)), lambda x: F.coalesce(x, F.lit(0.0)))
        return F.pow(uniform, 2) + F.pow(runs, 2) + F.pow(lagged / variance * F.sqrt(n), 2)

    def log_p(alphabet: Column, symbols: Column) -> Column:
        ranks = F.transform(symbols, lambda c: F.call_function("locate", c, alphabet).cast("double") - 1)
        sums = let(ranks, lambda r: let(total(r, lambda x: x) / n, lambda mean: battery(alphabet, symbols, r, mean)))
        tail = let(sums, lambda x: F.least(F.log(1 + F.sqrt(2 * x / math.pi)) - x / 2, F.lit(0.0)))
        log_ratio = -n * F.log(F.length(alphabet).cast("double")) - total(symbols, lambda c: F.element_at(_log_ordinary(), c))
        return F.least(F.lit(float(math.log(ENCODINGS))) - log_ratio - POWER * tail, F.lit(0.0))

    p = let(F.element_at(F.array(*map(F.lit, ALPHABETS)), kind + 1), lambda alphabet: let(F.split(run, ""), lambda symbols: log_p(alphabet, symbols)))
    bin_ = F.least(F.floor(-10 * p / F.log(F.lit(10.0))), F.lit(TOP_BIN)).cast("int")
    return F.struct(F.length(run).alias("size"), bin_.alias("bin"))


def length_class(size: Column) -> Column:
    out = F.lit(len(LENGTHS))
    for k, end in reversed(list(enumerate(LENGTHS))):
        out = F.when(size < end, k).otherwise(out)
    return out


def bounds(judged: DataFrame, rate: float) -> DataFrame:
    """One row with a map from length class to the least bin that is a discovery.

    judged: class and bin of each run. With m runs of a class, of which k have a bin of b or more, b
    is a discovery if 10 ** (-b / 10) <= rate * k / m; the rule takes the least such b.
    """
    counts = judged.groupBy("class", "bin").agg(F.count("*").alias("n"))
    per_class = counts.groupBy("class").agg(F.collect_list(F.struct("bin", "n")).alias("bins"), F.sum("n").alias("m"))  # at most TOP_BIN + 1 bins

    def beyond(b: Column) -> Column:
        return F.aggregate("bins", F.lit(0).cast("long"), lambda a, x: a + F.when(x["bin"] >= b, x["n"]).otherwise(0))

    fine = F.filter("bins", lambda x: F.pow(F.lit(10.0), -x["bin"] / 10.0) <= rate * beyond(x["bin"]) / F.col("m"))
    least = per_class.select("class", F.array_min(F.transform(fine, lambda x: x["bin"])).alias("least")).where("least IS NOT NULL")
    return least.agg(F.map_from_entries(F.collect_list(F.struct("class", "least"))).alias("__least"))


def uncovered(base: Column, runs: Column) -> Column:
    """The runs (start, end) that overlap none of the base spans, ascending by end. Both are put in one order, in which the farthest end of
    the spans that begin before a run's end tells, so the work grows with their number and not with its square."""
    event = lambda at, own, reach, s: F.struct(at.cast("int").alias("at"), F.lit(own).alias("own"), reach.cast("int").alias("reach"), s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"))
    both = F.array_sort(F.concat(F.transform(base, lambda s: event(s["start"], 1, s["end"], s)), F.transform(runs, lambda r: event(r["end"], 0, F.lit(0), r))))

    def free(events: Column) -> Column:
        reached = F.zip_with(events, running(F.transform(events, lambda e: e["reach"]), F.greatest), lambda e, far: F.struct(e.alias("e"), far.alias("far")))
        return F.transform(F.filter(reached, lambda x: (x["e"]["own"] == 0) & (x["far"] <= x["e"]["start"])), lambda x: F.struct(x["e"]["start"].alias("start"), x["e"]["end"].alias("end")))

    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    return F.when(F.size(runs) > 0, _let(both, free)).otherwise(none)


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", rate: float = 0.01) -> DataFrame:
    """The columns of `keep` and spans array<struct<start,kind,end>> by start and kind, where kind is
    a place in KINDS. A random run that overlaps a base span adds none."""
    C.kept(docs, keep, "spans", "__base", "__runs", "__least")
    scratch = C.Scratch(docs.sparkSession, "secrets")
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    of_kind = lambda k: lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"))
    base = F.concat(*(F.transform(places(own, *BASE[kind], hinted(own, kind)), of_kind(k)) for k, kind in enumerate(BASE)))
    judged = F.transform(places(own, RUN, ready=hinted(own, "random")), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), judge(F.substr(own, s["start"] + 1, s["end"] - s["start"])).alias("is")))
    found = scratch.save(docs.select(*keep, base.alias("__base"), judged.alias("__runs")), "found")
    runs = found.select(F.explode("__runs").alias("r")).select(length_class(F.col("r.is.size")).alias("class"), F.col("r.is.bin").alias("bin"))
    least = F.broadcast(scratch.save(bounds(runs, rate), "bounds"))  # one row
    discovery = lambda r: r["is"]["bin"] >= F.coalesce(F.element_at("__least", length_class(r["is"]["size"])), F.lit(TOP_BIN + 1))
    random = F.transform(uncovered(F.col("__base"), F.filter("__runs", discovery)), lambda r: F.struct(r["start"].alias("start"), F.lit(len(BASE)).alias("kind"), r["end"].alias("end")))
    return found.join(least).select(*keep, F.array_sort(F.concat("__base", random)).alias("spans"))


def shown(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", text: str = "text", **options) -> DataFrame:
    """docs with each span of its texts, or stretch of overlapping spans, replaced by the mark."""
    row = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text))
    found = scan(row, keep=("__row",), text=text, **options).withColumn("__text", F.col(f"__row.{text}"))
    ends = F.transform("spans", lambda s: s["end"])
    reach = running(ends, F.greatest)  # how far the spans before each go
    piece = lambda s, at: F.when(s["start"] >= at, F.concat(F.substr(F.col("__text"), at + 1, s["start"] - at), F.lit(mark))).otherwise("")
    clean = F.concat(F.array_join(F.zip_with("spans", reach, piece), ""), F.substr(F.col("__text"), F.array_max(ends) + 1, F.length("__text")))
    return found.select(*(F.when(F.size("spans") > 0, clean).otherwise(F.col("__text")).alias(c) if c == text else F.col(f"__row.{c}").alias(c) for c in docs.columns))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(C.table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select("doc_id", *(count(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
