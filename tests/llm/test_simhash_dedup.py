"""SimHash near-duplicates against a plain search."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from lamina.llm import _common as C
from lamina.llm import simhash_dedup as S

DOCS = "doc_id long, text string, lang string, fingerprint string, component_id string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "clash", "clash") for i, t in rows], DOCS)


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)][: len(words)]
    votes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def plain_components(rows):
    """rows: (doc_id, fingerprint). The smallest doc_id reachable, for each row."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (da, a) in enumerate(rows):
        for j, (db, b) in enumerate(rows[:i]):
            if bin(a ^ b).count("1") <= 4 or (da is not None and da == db):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(rows))]


def texts():
    own = random.Random(7)
    words = ["".join(own.choice("abcdeXé") for _ in range(own.randint(1, 6))) for _ in range(300)]
    out = [None, "", " \t\n ", "one", "One two\tthree", "a b c d", "a  b\nc\x0bd", " a b　c d"]
    for _ in range(40):
        base = [own.choice(words) for _ in range(own.randint(20, 250))]
        out.append(own.choice([" ", "  ", "\n"]).join(base))
        for _ in range(own.randint(0, 4)):
            changed = list(base)
            for _ in range(own.randint(0, 3)):
                changed[own.randrange(len(changed))] = own.choice(words)
            out.append(" ".join(changed))
    return [*out, " ".join(own.choice(words) for _ in range(200_000))]


def test_equals_a_plain_search(spark):
    rows = list(enumerate(texts(), 5))
    own = random.Random(3)
    own.shuffle(rows)
    rows += [(None, rows[3][1]), (None, "nothing else has these words at all"), rows[9], (rows[4][0], rows[40][1])]
    marks = [plain(t) for _, t in rows]
    want = sorted(zip([d for d, _ in rows], marks, plain_components([(d, m) for (d, _), m in zip(rows, marks)])), key=repr)
    got = S.near_duplicates(docs(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in got), key=repr) == want
    assert len({c for _, _, c in want}) < len(rows) - 20


@pytest.mark.parametrize(("width", "extra"), [(1, 2), (2, 3), (4, 3)])
def test_links_of_dense_groups(spark, width, extra):
    own = random.Random(width)
    values = set()
    for _ in range(12):
        centre = own.getrandbits(64)
        for _ in range(40):
            x = centre
            for _ in range(own.randint(0, 9)):
                x ^= 1 << own.randrange(64)
            values.add(x)
    values = sorted(values | {0, 1, 2**63, 2**64 - 1})
    want = dict(zip(values, plain_components([(v, v) for v in values])))
    table = spark.createDataFrame([(v - (v >> 63 << 64),) for v in values], "fingerprint long")
    labels = {r["node"] % 2**64: r["label"] for r in S.linked(table, C.Scratch(spark, "test"), None, 4, width, extra).collect()}
    groups, seen = {}, {}
    for v in values:
        groups.setdefault(labels.get(v, v - (v >> 63 << 64)), set()).add(v)
        seen.setdefault(want[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, seen.values()))


@pytest.mark.parametrize("width", [1, 2, 4, 8])
def test_the_embedding_bounds_the_distance(spark, width):
    own = random.Random(width)
    pairs = [(own.getrandbits(64), own.getrandbits(64)) for _ in range(200)] + [(0, 2**64 - 1), (5, 6)]
    signed = lambda v: v - (v >> 63 << 64)
    df = spark.createDataFrame([(i, signed(a), signed(b)) for i, (a, b) in enumerate(pairs)], "i int, a long, b long")
    got = {r["i"]: r["d"] for r in df.withColumns({"x": S.embedding("a", width), "y": S.embedding("b", width)}).select("i", S.differing("x", "y").alias("d")).collect()}
    for i, (a, b) in enumerate(pairs):
        count = lambda v, k: bin(v >> k & (1 << width) - 1).count("1")
        assert got[i] == sum(abs(count(a, k) - count(b, k)) for k in range(0, 64, width)) <= bin(a ^ b).count("1")


def test_one_of_each_stays(spark):
    base = " ".join(f"w{i}" for i in range(60))
    d = docs(spark, [(3, base), (2, base.upper()), (7, "other words in here"), (None, base)])
    kept = S.keep_one(d)
    assert kept.columns == d.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [2, 7, None]
    assert S.near_duplicates(d.limit(0)).count() == 0


def test_the_query_reads_all_rows(spark):
    from lamina.llm import queries

    got = queries.QUERIES["op12_simhash_dedup"](spark, "/root/testdata/sf0.001")
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    marks = [(d, plain(t)) for d, t in rows.items()]
    want = {d: (f"{m:016x}", c) for (d, m), c in zip(marks, plain_components(marks))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got.select("doc_id", F.col("fingerprint"), "component_id").collect()} == want
