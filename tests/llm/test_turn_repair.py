"""Repair of conversations against a plain search over all audits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from lamina.llm import turn_repair as R

TURNS = "conv_id long, turn long, role string, text string, audit string, place int"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def plain_faults(rows):
    """rows: (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(kind)
    return out


def plain_repair(rows):
    """cost and audit of (role, text) rows: the least (cost, audit) over everything that leads to an accepted end."""
    faults = plain_faults(rows)

    @lru_cache(None)
    def best(i, state, inserts):
        found = [(0, "")] if i == len(rows) and state in ("", "a") else []
        steps = []
        if i < len(rows):
            steps.append((4, "D", i + 1, state))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                after = STEP.get((state, rows[i][0][:1]))
                steps += [(extra, "K", i + 1, after)] if after else []
                steps += [(3 + extra, "R", i + 1, STEP[state, r]) for r in "ua" if (state, r) in STEP]
        if inserts < 3:
            steps += [(3, "I", i, STEP[state, r]) for r in "ua" if (state, r) in STEP]
        for cost, edit, at, after in steps:
            rest = best(at, after, inserts + 1 if edit == "I" else 0)
            if rest:
                found.append((cost + rest[0], edit + rest[1]))
        return min(found, default=None)

    return best(0, "", 0)


def plain_result(turns):
    """turns: (turn, role, text), after damage."""
    space = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    space.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    rows = [r[1:] for r in space]
    numbers = [r[0] for r in space if r[0] is not None]
    faults = plain_faults(rows)
    illegal = sum((p[:1] + q[:1]) not in ("su", "ua", "au") for (p, _), (q, _) in zip(rows, rows[1:]))
    cost, audit = plain_repair(tuple(rows))
    out, at, state = [], iter(rows), ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(at)
        if edit == "D":
            continue
        if edit in "IR":
            role = {"u": "user", "a": "assistant"}[next(r for r in "ua" if (state, r) in STEP)]
        state = STEP[state, role[0]]
        out.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def random_turns(own, convs, longest):
    texts = ["Yes.", "No!", "cut", "What? ", " ", "", None, "é.", "a.\n", "b\x0b", "c\xa0"]
    rows = []
    for conv in convs:
        for k in range(own.randint(0, longest)):
            turn = own.choice([k, k, k, k + 1, None, k - 3])
            role = own.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ustad"])
            rows.append((conv, turn, role, own.choice([own.choice(texts), f"t{own.randint(0, 9)}."])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], TURNS)


def collected(df):
    return {r["conv_id"]: tuple(r[c] for c in (*R.COUNTS, "audit", "repaired_sha256")) for r in df.collect()}


def test_layers_equal_a_search():
    own = random.Random(2)
    for _ in range(1500):
        rows = tuple((own.choice(["user", "assistant", "system", "tool"]), own.choice(["x.", f"{own.random()}.", "cut", f"cut {own.random()}", " "])) for _ in range(own.randint(0, 9)))
        codes = "".join(R.code(role[:1], f) for (role, _), f in zip(rows, plain_faults(rows)))
        assert R.solve(codes) == plain_repair(rows)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7])
def test_chunks_change_nothing(chunk, monkeypatch):
    own = random.Random(chunk)
    every = ["".join(own.choice("suaSUA-_x") for _ in range(own.randint(0, 40))) for _ in range(300)] + ["", "u", "x" * 30, "ua" * 20, "au" * 15]
    monkeypatch.setattr(R, "CHUNK", 1000)
    whole = [R.solve(c) for c in every]
    monkeypatch.setattr(R, "CHUNK", chunk)
    assert [R.solve(c) for c in every] == whole
    for codes, (cost, _) in zip(every, whole):
        assert R.ahead(R.table(codes), R.LAST)[0] == cost


@pytest.mark.parametrize(("long", "part"), [(10_000, 16), (5, 16), (0, 1)])
def test_equals_a_search(spark, long, part, monkeypatch):
    """The same whether conversations are held whole, or parted by ranges and into parts of two rows."""
    monkeypatch.setattr(R, "PART", part)
    own = random.Random(4)
    rows = random_turns(own, [*range(40), None, 2**40], 14)
    want = {conv: plain_result(turns) for conv, turns in plain_damage(rows).items()}
    assert collected(R.inspect(R.damaged(frame(spark, rows)), long)) == want
    assert any(not turns for turns in plain_damage([(7, t, "user", "x.") for t in range(40) if zlib.crc32(f"7:{t}".encode()) % 20 == 0]).values())


@pytest.mark.parametrize("long", [10_000, 1])
def test_conversations_of_which_nothing_is_left(spark, long):
    gone = [t for t in range(200) if zlib.crc32(f"7:{t}".encode()) % 20 == 0][:3]
    rows = [(7, t, "user", "x.") for t in gone] + [(8, None, None, None), (9, 1, "assistant", "Hello.")]
    got = collected(R.inspect(R.damaged(frame(spark, rows)), long))
    assert got == {conv: plain_result(turns) for conv, turns in plain_damage(rows).items()}
    assert got[7] == (0,) * 6 + ("", hashlib.sha256().hexdigest())
    assert R.inspect(R.damaged(frame(spark, rows).limit(0)), long).count() == 0


@pytest.mark.parametrize(("long", "part"), [(10_000, 16), (3, 16), (0, 1)])
def test_repaired_rows(spark, long, part, monkeypatch):
    monkeypatch.setattr(R, "PART", part)
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Well?"), (1, 3, "assistant", "no end"), (2, 5, "user", " "), (3, 0, "user", "Hi."), (3, 2, "tool", "Yes."), (3, 3, "user", "And?")]
    got = {}
    for r in R.repair(frame(spark, rows), long).orderBy("conv_id", "place").collect():
        got.setdefault(r["conv_id"], []).append((r["edit"], r["role"], r["text"]))
    for conv, edits in got.items():
        audit = plain_repair(tuple(r[2:4] for r in rows if r[0] == conv))[1]
        assert "".join(e for e, _, _ in edits) == audit
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for e, role, _ in edits if e != "D"))
    assert got[2] == [("D", "user", " ")]
    assert got[3] == [("K", "user", "Hi."), ("R", "assistant", "Yes."), ("D", "user", "And?")] or got[3][:2] == [("K", "user", "Hi."), ("R", "assistant", "Yes.")]


def test_a_very_long_conversation(spark):
    own = random.Random(8)
    rows = [(1, t, own.choice(["user", "assistant"]), own.choice(["Yes.", f"w{t}.", f"w{t}", f"w{t}!", " "])) for t in range(3000)]
    df = frame(spark, rows)
    assert collected(R.inspect(df, 10_000)) == collected(R.inspect(df, 100))


def test_the_query_reads_all_rows(spark):
    from lamina.llm import queries

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {conv: plain_result(turns) for conv, turns in plain_damage(rows).items()}
    assert collected(queries.QUERIES["op11_turn_repair"](spark, "/root/testdata/sf0.001")) == want
