"""Conversation repair against a sequential restatement and against all edits of tiny conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from lexiforge.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, part int, chunk string, known long"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def faults(rows):
    """(initial, dead, cut, kind, role, text) of each row of a conversation."""
    rows, seen, out = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])), set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1], kind in ("blank", "duplicate"), kind == "truncated", kind, role, text))
    return out


def cheapest(rows):
    """Least (cost, audit) by state after each row; audits carry the rows made."""
    never = (1 << 60, "", ())
    now = {"e": (0, "", ()), "s": never, "u": never, "a": never}
    add = lambda x, cost, letter, *made: (x[0] + cost, x[1] + letter, x[2] + made)

    def inserted(x):
        for _ in range(3):
            for a, b in (("e", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                x = {**x, b: min(x[b], add(x[a], 3, "I", ({"u": "user", "a": "assistant"}[b], "")))}
        return x

    for initial, dead, cut, _, role, text in rows:
        x, new = inserted(now), {}
        for k in "esua":
            ways = [add(x[k], 4, "D")]
            before = {"e": "", "s": "e", "u": "esa", "a": "u"}[k]
            for b in before:
                if not dead and initial == k:
                    ways.append(add(x[b], 3 * cut, "K", (role, text)))
                if not dead and k in "ua":
                    ways.append(add(x[b], 3 * cut + 3, "R", ({"u": "user", "a": "assistant"}[k], text)))
            new[k] = min(ways)
        now = new
    x = inserted(now)
    return min(x["e"], x["a"])


def expected(rows):
    out = {}
    after = damage(rows)
    for conv in {r[0] for r in rows}:
        own = [r for r in after if r[0] == conv]
        turns = {r[1] for r in own if r[1] is not None}
        found = faults(own)
        cost, audit, made = cheapest(found)
        kinds = [f[3] for f in found]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(found))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def conversation(r, conv, n):
    texts = ["Yes.", "No", "Why?", "", " \n", "ok!  ", "é", "long " * 3000 + ".", None]
    return [(conv, r.choice([i, i, i, None, 3]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), r.choice(texts + [f"t{i}."] * 9)) for i in range(n)]


def check(spark, rows, **how):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)
    got = {r["conv_id"]: tuple(r[c] for c in (*conversations.NUMBERS, "audit", "repaired_sha256")) for r in conversations.op13_conversation_repair(df).collect()}
    assert got == expected(rows)
    return got


def test_small_conversations(spark):
    r = random.Random(13)
    rows = [x for c in range(80) for x in conversation(r, c, r.randint(0, 9))] + conversation(r, None, 9)
    assert len(check(spark, rows)) > 60


def test_hot_conversation_in_many_parts(spark, monkeypatch):
    """Small chunks: one conversation crosses parts and needs several levels."""
    monkeypatch.setattr(conversations, "CHUNK", 3)
    monkeypatch.setattr(conversations, "FAN", 2)
    r = random.Random(5)
    rows = [x for c in range(30) for x in conversation(r, c, 5)] + conversation(r, 7, 260) + [(9, 4, "user", "same.")] * 200
    check(spark, rows)


def test_cheapest_of_all_edits():
    """The fold's restatement finds the least of all scripts of edits."""
    legal = re.compile("(s?(ua)+)?")
    r = random.Random(2)
    for _ in range(60):
        rows = faults([x for x in conversation(r, 1, r.randint(0, 3)) if x[2] is not None and x[3] is not None])
        ways = []
        for edits in itertools.product("KuaD", repeat=len(rows)):
            if any(e != "D" and row[1] for e, row in zip(edits, rows, strict=True)):
                continue
            for gaps in itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1):
                roles, audit, cost = gaps[0], "I" * len(gaps[0]), 3 * len(gaps[0])
                for e, gap, row in zip(edits, gaps[1:], rows, strict=True):
                    roles += (row[0] or "?") if e == "K" else "" if e == "D" else e
                    audit += "R" if e in "ua" else e
                    cost += 4 if e == "D" else 3 * row[2] + 3 * (e in "ua")
                    roles, audit, cost = roles + gap, audit + "I" * len(gap), cost + 3 * len(gap)
                if legal.fullmatch(roles):
                    ways.append((cost, audit))
        assert min(ways) == cheapest(rows)[:2]


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(None, None, "system", "Only.")]])
def test_edges(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    got = {r["conv_id"]: tuple(r[c] for c in (*conversations.NUMBERS, "audit", "repaired_sha256")) for r in conversations.op13_conversation_repair(df).collect()}
    assert got == expected(rows)
