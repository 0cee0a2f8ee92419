"""Repair of conversations, against an exhaustive search over all edit lists."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

from fabspark.llm import conversations as C
from pyspark.sql import functions as F

TAKES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NAMES = {"u": "user", "a": "assistant"}


def cheapest(initials, faults):
    """(cost, letters, which role each put row has) over all lists with up to three rows put in at a place."""
    @lru_cache(None)
    def go(i, q, put):
        ways = [(0, "", "")] if i == len(initials) and q in (0, 3) else []
        if i < len(initials):
            c, a, r = go(i + 1, q, 0)
            ways.append((c + 2, "D" + a, r))
            if faults[i] != 1:
                more = 5 * (faults[i] == 2)
                if initials[i] in TAKES[q]:
                    c, a, r = go(i + 1, TAKES[q][initials[i]], 0)
                    ways.append((c + more, "K" + a, r))
                for x in "ua":
                    if x in TAKES[q]:
                        c, a, r = go(i + 1, TAKES[q][x], 0)
                        ways.append((c + more + 1, "R" + a, x + r))
        if put < 3:
            for x in "ua":
                if x in TAKES[q]:
                    c, a, r = go(i, TAKES[q][x], put + 1)
                    ways.append((c + 5, "I" + a, x + r))
        return min(ways) if ways else (10 ** 9, "~", "")
    return go(0, 0, 0)


def plain(rows):
    """The whole operator on (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = convs[conv]
        say = lambda x: " " if x is None else x
        h = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        kept += [(turn, role, text)] * (1 + (h == 3))
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in kept if t is not None}
        n, seen, faults = [0, 0, 0], set(), []
        for _, role, text in kept:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            f = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(0 if f is None else 2 if f == 2 else 1)
            if f is not None:
                n[f] += 1
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, put = cheapest(tuple(initials), tuple(faults))
        lines, put, at = [], iter(put), iter(kept)
        for x in audit:
            if x == "I":
                lines.append((NAMES[next(put)], ""))
            else:
                _, role, text = next(at)
                if x != "D":
                    lines.append((role if x == "K" else NAMES[next(put)], text))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = ((max(turns) - min(turns) + 1 - len(turns) if turns else 0), *n, illegal, cost, audit, digest), lines
    return out


def rows_of(seed, convs=250, longest=14):
    random.seed(seed)
    out = []
    for conv in range(convs):
        turn = random.randint(0, 3)
        for _ in range(random.randint(0, longest)):
            role = random.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "Ünit"])
            text = random.choice(["Yes.", "No", "Hm?\n", "", " \t", None, "Yes.", "Ja! 日本 🙂.", f"t{turn}", "x" * 3000 + ".", "\x85", "a.\x00"])
            out.append((conv if conv % 50 else None, turn if random.random() < 0.95 else None, role, text))
            turn += random.choice([0, 1, 1, 1, 2, 7])
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def test_search_from_both_ends_equals_all_lists():
    random.seed(1)
    for _ in range(3000):
        n = random.randint(0, 9)
        initials = "".join(random.choice("suaux ") for _ in range(n))
        faults = bytes(random.choice([0, 0, 0, 1, 2]) for _ in range(n))
        assert C.edits(initials, faults) == cheapest(initials, faults)[:2]


def test_report_equals_plain_version(spark):
    rows = rows_of(2)
    want = plain(rows)
    rows += [(1001, None, None, None), (1002, 5, "user", "Hi."), (1002, 5, "user", "Hi.")]
    want = plain(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", key long, gone string").repartition(5)
    made = C.damaged(df)
    assert made.columns == ["key", "turn", "role", "text", "gone"]
    out = C.report(made).collect()
    assert len(out) == len(want)
    for r in out:
        assert tuple(r)[1:] == want[r.conv_id][0]
    turns = defaultdict(list)
    for r in C.repaired(made).orderBy("place").collect():
        turns[r.conv_id].append((r.role, r.text))
        assert r.place == len(turns[r.conv_id])
    assert turns == {k: lines for k, (_, lines) in want.items() if lines}


def test_long_conversations_are_streamed_to_the_same_result(spark):
    rows = rows_of(3, convs=60, longest=40)
    made = C.damaged(spark.createDataFrame(rows, SCHEMA).repartition(4))
    held = sorted(C.report(made).collect(), key=str)
    assert sorted(C.report(made, long=10).collect(), key=str) == held
    assert sorted(C.repaired(made, long=10).collect(), key=str) == sorted(C.repaired(made).collect(), key=str)


def test_a_conversation_of_very_many_rows(spark):
    n = 12_000
    df = spark.range(n).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                               F.expr("if(id % 2 = 0, 'user', 'assistant')").alias("role"),
                               F.concat(F.lit("text "), F.col("id").cast("string"), F.lit(".")).alias("text"))
    r = C.report(C.damaged(df)).first()
    assert r.repaired_sha256 and len(r.audit) >= n * 0.9
    small = C.report(C.damaged(df), long=10 ** 9).first()
    assert r == small


def test_nothing_left_and_empty_tables(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    r = C.report(C.damaged(df)).collect()
    assert [tuple(x) for x in r] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert C.report(C.damaged(df.limit(0))).collect() == []
    assert C.repaired(C.damaged(df)).collect() == []
