"""Collocations against a plain count."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lamina.llm import phrases as P

DOCS = "doc_id long, text string, lang string, phrase string, count long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "clash", 7) for i, (t, lang) in enumerate(rows)], DOCS)


def plain(rows, least, longest=5):
    """{(lang, phrase): (words, a, l, r, n, score)}"""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = {}
    for lang, own in counts.items():
        often = {g: f for g, f in own.items() if f >= least and len(g) > 1}
        for g, a in often.items():
            if any(len(q) > len(g) and f >= a and any(q[i : i + len(g)] == g for i in range(len(q))) for q, f in often.items()):
                continue
            score, k = min((1000 * a * totals[lang] // (own[g[:k]] * own[g[k:]]), k) for k in range(1, len(g)))
            out[lang, " ".join(g)] = (len(g), a, own[g[:k]], own[g[k:]], totals[lang], score)
    return out


def collected(df):
    return {(r["lang"], r["phrase"]): (r["words"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


def sample(seed=1, n=150):
    own = random.Random(seed)
    words = ["the", "a", "b", "c\x01", "c", "éa", "I", "x-y", "the\x01", "\x02", "漢"]
    seps = [" ", " ", " ", " ", "  ", "\t", ", ", "\n", ".", " ; ", "\x0b"]
    rows = [("".join(own.choice(words) + own.choice(seps) for _ in range(own.randint(0, 60))), own.choice(["en", "en", "de", None, "und", ""])) for _ in range(n)]
    return [*rows, (None, "en"), ("", "de"), (" \t ", "en"), ("the a " * 30_000, "fr"), ("of the one two three four five six. " * 8, "en"), ("of the one", "en")]


@pytest.mark.parametrize(("least", "size"), [(3, 300), (8, 16 << 20)])
def test_equals_a_plain_count(spark, least, size, monkeypatch):
    monkeypatch.setattr(P, "SHARD", size)
    rows = sample()
    want = plain(rows, least)
    assert collected(P.collocations(docs(spark, rows), least=least)) == want
    assert ("en", "of the one") in want and ("en", "one two three four five") in want and ("en", "the one two three four") in want
    assert {len(p.split(" ")) for _, p in want} == {2, 3, 4, 5}


def test_a_full_field_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "FIELD", 64)
    rows = sample(2, 60)
    assert collected(P.collocations(docs(spark, rows), least=4)) == plain(rows, 4)


def test_ranges_that_begin_inside_a_subtree(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = sample(3)
        assert collected(P.collocations(docs(spark, rows), least=3)) == plain(rows, 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])


def test_ranks_and_exact_scores(spark):
    rows = [("a b. " * 4 + "c d. " * 4 + "é f. " * 4 + "z e. z g. " * 4, "en"), ("p q " * 50, "de")]
    found = P.collocations(docs(spark, rows), least=4)
    got = [(r["lang"], r["rank"], r["phrase"]) for r in P.top(found, 3).orderBy("lang", "rank").collect()]
    assert [x for x in got if x[0] == "en"] == [("en", 1, "a b"), ("en", 2, "c d"), ("en", 3, "é f")]
    big = spark.createDataFrame([("en", w, c) for w, c in (("x", 4 * 10**15), ("y", 3 * 10**15), ("x y", 10**15 + 7))], "lang string, phrase string, count long")
    from lamina.llm import _common as C

    cut = P.left_parts(big, C.Scratch(spark, "test")).collect()
    assert [(r["phrase"], r["k"], r["l"], r["rest"]) for r in cut] == [("x y", 1, 4 * 10**15, "y")]


def test_of_nothing(spark):
    assert P.collocations(docs(spark, [("a b", "en")]).limit(0)).count() == 0
    assert P.collocations(docs(spark, [(None, None), ("a b", "en")])).count() == 0


def test_tries_count_runs():
    ids, goes = np.array([0, 1, 2, 0, 1, 2, 3]), np.array([True, True, False, True, True, True, False])
    levels = list(P.trie(ids, goes, 4, 4))
    assert [tuple(x.tolist() for x in level) for level in levels] == [([0, 1, 2], [1, 2, 3], [2, 2, 1]), ([0, 1], [2, 3], [2, 1]), ([0], [3], [1])]
    assert P.tokens(pa.array([None, ""]))[0].tolist() == []
    ids, words, follows = P.tokens(pa.array(["B a,\tb", "b c.d"]))
    assert [words[i].as_py() for i in ids.tolist()] == [b"b", b"a", b"b", b"b", b"c", b"d"] and follows.tolist() == [True, False, False, True, False, False]
