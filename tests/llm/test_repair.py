import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import repair
from tests.llm.frames import with_clashes

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
BLANKS = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, hit = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if hit:
            row = (conv, turn, "user" if hit == 4 else role, "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text)
            out += [row] * (2 if hit == 3 else 1)
    return out


def brute_edits(turns):
    """Least ``(cost, audit, texts)`` by trying every edit at every turn, with up to two inserted turns before each."""
    @lru_cache(None)
    def go(i, grammar, inserted):
        best = []
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", grammar):
            best.append((0, "", ()))

        def take(cost, edit, letter, line, at, count):
            # Only how far the grammar has come matters from here on.
            now = grammar + letter
            if any(re.fullmatch("(s?(ua)+)?", now + rest) for rest in ("", "a", "ua")):
                now = "" if now == "" else "s" if now == "s" else "u" if now.endswith("u") else "ua"
                c, audit, lines = go(at, now, count)
                best.append((cost + c, edit + audit, (line, *lines) if line is not None else lines))

        if inserted < 2:
            for role in ("user", "assistant"):
                take(3, "I", role[0], f"{role}:", i, inserted + 1)
        if i < len(turns):
            role, text, fault = turns[i]
            take(4, "D", "", None, i + 1, 0)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] in ("s", "u", "a"):
                    take(more, "K", role[:1], f"{role}:{text}", i + 1, 0)
                for to in ("user", "assistant"):
                    take(3 + more, "R", to[0], f"{to}:{text}", i + 1, 0)
        return min(best, default=(10 ** 9, "", ()))

    return go(0, "", 0)


def brute(rows, damaged):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, turns = set(), []
        for _, _, role, text in mine:
            body = text.rstrip(BLANKS)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            turns.append((role, text, fault))
        known = [r[1] for r in mine if r[1] is not None]
        faults = [t[2] for t in turns]
        cost, audit, lines = brute_edits(tuple(turns))
        out.append((conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def some(rng, convs, most):
    rows = []
    for conv in range(convs):
        turn = 0
        for _ in range(rng.randrange(0, most)):
            turn += rng.choice((1, 1, 1, 2))
            rows.append((conv, turn, rng.choice(("system", "user", "user", "assistant", "assistant", "tool", "Anna")),
                         rng.choice(("Yes.", "No?", "open", "Well then!\n", " ", "a.b", "x" * rng.randrange(5) + "."))))
    return rows


@pytest.mark.parametrize("segment", [512, 3, 1])
def test_random_conversations(spark, segment):
    rows = some(random.Random(segment), 120, 9)
    df = spark.createDataFrame(rows, ROWS)
    damaged = repair.damage(df)
    assert sorted(map(tuple, damaged.collect()), key=str) == sorted(brute_damage(rows), key=str)
    assert got(repair.summary(df, damaged, segment)) == brute(rows, brute_damage(rows))


def test_awkward_conversations(spark):
    rows = [(None, None, None, None), (None, None, None, None), (None, 3, "user", "Hm?"), (1, None, "user", "First."), (1, 1, "assistant", None),
            (1, 1, "assistant", "Tie."), (1, 1, "assistant", "Tie."), (2, 5, "", "Nobody."), (3, 1, "user", "x" * 50_000),
            (3, -4, "system", "é漢😀."), (-1, 2, "user", "U."), (-1, 3, "assistant", "A. \t")]
    df = with_clashes(spark.createDataFrame(rows, ROWS), "conv", "seg", "sig", "fault", "hit", "copy", "digest", "audit")
    assert got(repair.summary(df, df.drop("none"))) == brute(rows, [tuple(" " if i > 1 and v is None else v for i, v in enumerate(r)) for r in rows])
    assert got(repair.summary(df, repair.damage(df))) == brute(rows, brute_damage(rows))
    none = spark.createDataFrame([], ROWS)
    assert got(repair.summary(none, repair.damage(none))) == []


def test_all_turns_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    rows = [(7, turn, "user", "Gone.")]
    df = spark.createDataFrame(rows, ROWS)
    assert got(repair.summary(df, repair.damage(df))) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_repeated_row_comes_after_the_one_it_repeats(spark, monkeypatch):
    # The staged turns in the other order, as a shuffle may bring them.
    monkeypatch.setattr(repair, "stage_rows", lambda df, name, f=repair.stage_rows: f(
        df.coalesce(1).sortWithinPartitions("conv", F.desc("fault")) if name == "repair-turns" else df, name))
    rows = [(c, t, role, text) for c in range(5) for t, role, text in ((1, "user", "Hi."), (1, "user", "Hi."), (2, "assistant", "Yes."))]
    df = spark.createDataFrame(rows, ROWS)
    assert {r[7] for r in got(repair.summary(df, df))} == {"KDK"}


def test_shared_ends_are_one_node(monkeypatch):
    calls = []
    monkeypatch.setattr(repair, "node", lambda mark, behind, f=repair.node: calls.append(mark) or f(mark, behind))
    import pyarrow as pa

    sigs = sorted(("uaua", "aua", "ua", "suua", "xuua"), key=lambda s: s[::-1])
    batch = pa.RecordBatch.from_arrays([pa.array([list(repair.END)] * 5, pa.list_(pa.int64())), pa.array(sigs)], names=["behind", "sig"])
    list(repair._shared(repair._costs, pa.int64())([batch]))
    assert len(calls) == len({s[i:] for s in sigs for i in range(len(s))})


def test_one_conversation_with_most_turns(spark):
    rows = [(5, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(3000)] + some(random.Random(9), 5, 6)
    df = spark.createDataFrame(rows, ROWS)
    import sys
    sys.setrecursionlimit(20_000)
    whole = got(repair.summary(df, repair.damage(df), 64))
    assert whole == got(repair.summary(df, repair.damage(df), 10_000))
    assert {r[0]: r for r in whole}[5][7].count("K") > 2000
