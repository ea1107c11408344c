"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from quarry.llm import conversation_repair as cr
from quarry.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"
DDL = "conv_id long, turn long, role string, text string"
SOLID = re.compile("[^\x20\x09-\x0D]")
FOLLOW = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def damage(rows):
    """Rows of each conversation after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest())
    return {conv: sorted(kept, key=key) for conv, kept in out.items()}


def cheapest(rows, faults):
    """(cost, audit, repaired rows) by search from every row and state."""

    @lru_cache(None)
    def best(i, state, inserted):
        found = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        role, to = FOLLOW[state]
        if inserted < 3 and (rest := best(i, to, inserted + 1)):
            found.append((5 + rest[0], "I" + rest[1], (f"{role}:", *rest[2])))
        if i < len(rows):
            _, own, text = rows[i]
            if rest := best(i + 1, state, 0):
                found.append((2 + rest[0], "D" + rest[1], rest[2]))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if rest := best(i + 1, to, 0):
                    found.append((1 + more + rest[0], "R" + rest[1], (f"{role}:{text}", *rest[2])))
                if (own[:1], state) in KEPT and (rest := best(i + 1, KEPT[own[:1], state], 0)):
                    found.append((more + rest[0], "K" + rest[1], (f"{own}:{text}", *rest[2])))
        return min(found, key=lambda f: f[:2], default=None)

    for i in range(len(rows), -1, -20):  # fill the memo without deep recursion
        for state in range(4):
            best(i, state, 0)
    return best(0, 0, 0)


def brute(rows):
    out = {}
    for conv, kept in damage(rows).items():
        seen, faults = set(), []
        for _, role, text in kept:
            solid = SOLID.findall(text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, repaired = cheapest(kept, tuple(faults))
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)
    return out


def repaired(df):
    rows = cr.repair(df).collect()
    got = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def test_matches_brute_force_on_the_table(spark):
    table = read_table(spark, SF001, "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert repaired(table) == brute(rows)


@pytest.mark.parametrize("segment", [5, 100])
def test_matches_brute_force_on_odd_rows(spark, monkeypatch, segment):
    """Nulls, other roles, equal turns, blanks, repeats, and a conversation
    that holds most rows and so spans segments and partitions."""
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rng = random.Random(1)
    roles, texts = [None, "system", "user", "assistant", "tool", "", "User"], [None, "", "a.", "b", "c!", "d e ", "\t", "f? \x1c"]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(60)]), rng.choice(roles), rng.choice(texts)) for _ in range(1200)]
    rows += [(77, rng.randrange(30_000), rng.choice(["user", "assistant"]), rng.choice([f"y.{i}", f"z{i}."])) for i in range(1500)]
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "'x' as kind", "1 as pos", "2 as copies", "'y' as digest").repartition(5)
    assert repaired(df) == brute(rows)


def test_empty_table(spark):
    assert repaired(spark.createDataFrame([], DDL)) == {}


def test_a_conversation_whose_rows_all_drop(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert repaired(spark.createDataFrame([(gone, 0, "user", "hello.")], DDL)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_a_very_long_text_and_a_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"{i} text.") for i in range(9000)] + [(2, 1, "user", "long " * 400_000 + "."), (2, 2, "assistant", "ok.")]
    assert repaired(spark.createDataFrame(rows, DDL)) == brute(rows)


def test_re_pair_rebuilds_the_words():
    rng = random.Random(5)
    words = [[rng.randrange(3) for _ in range(rng.randrange(60))] for _ in range(200)] + [[1] * 33, [], [0, 0, 0]]
    rules, compressed = cr.re_pair(words, 3)

    def expand(s):
        return [s] if s < 3 else expand(rules[s - 3][0]) + expand(rules[s - 3][1])

    assert [[t for s in w for t in expand(s)] for w in compressed] == words
    assert all(max(rule) < 3 + i for i, rule in enumerate(rules))
    pairs = [p for w in compressed for p in zip(w, w[1:])]
    assert sum(map(len, compressed)) < sum(map(len, words)) / 2 and len(pairs) - len(set(pairs)) <= 2


def test_ropes_compare_like_strings(monkeypatch):
    monkeypatch.setattr(cr, "FLAT", 3)
    rng = random.Random(2)
    shared = cr.join("KKKDD", "KKKKRRRR")
    ropes = [shared]
    for _ in range(300):
        ropes.append(cr.join(rng.choice([shared, *ropes[-5:], "K", "D", ""]) , rng.choice([shared, "K", "D", "DDI"])))
    for _ in range(2000):
        a, b = rng.choice(ropes), rng.choice(ropes)
        assert cr.less(a, b) == (cr.flat(a) < cr.flat(b)) and cr.length(a) == len(cr.flat(a))
