"""Repair of conversations against a plain search over edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from annonia.llm import repair

DIR = "/root/testdata/sf0.001"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def plain(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, lines) of one conversation's rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = SOLID.findall(text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def best(i, state, inserts):
        """(cost, audit, lines) of the rest; fewer than three insertions in a row."""
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        turns = {"u": "user", "a": "assistant"}
        if inserts < 3:
            for to, name in turns.items():
                if step[state].get(to):
                    c, a, t = best(i, to, inserts + 1)
                    found.append((c + 3, "I" + a, (f"{name}:",) + t))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, t = best(i + 1, state, 0)
            found.append((c + 4, "D" + a, t))
            if faults[i] in ("", "truncated"):
                more = 3 if faults[i] else 0
                to = step[state].get(role[:1])
                if to:
                    c, a, t = best(i + 1, to, 0)
                    found.append((c + more, "K" + a, (f"{role}:{text}",) + t))
                for to, name in turns.items():
                    if step[state].get(to):
                        c, a, t = best(i + 1, to, 0)
                        found.append((c + more + 3, "R" + a, (f"{name}:{text}",) + t))
        return min(found, key=lambda f: f[:2], default=(10**9, "", ()))

    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, lines = best(0, "", 0)
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def got(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def made(seed, n):
    random.seed(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", "u", "assistant", "user"], ["Yes.", "No", "Why?", " ", "", "Ab!\n", "x", "One.", "Two!"]
    return [(random.choice([None, *range(n)]) if random.random() < 0.2 else k, random.choice(roles), random.choice(texts) + (str(k) + random.choice([".", ""]) if random.random() < 0.5 else "")) for k in range(n)]


@pytest.mark.parametrize("bits", [10, 1, 3])
def test_against_plain_search(spark, monkeypatch, bits):
    """Conversations in one block and in many."""
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    convs = {c: made(c, c % 23 + 1) for c in range(60)}
    convs[None] = [(None, "user", "a."), (1, "assistant", "b."), (1, "assistant", "b.")]
    convs[-5] = [(0, "system", "s."), (1, "user", "u"), (1, "user", "u"), (2, "user", " "), (9, "user", " ")]
    rows = [(c, *r, "clash", 3) for c, rs in convs.items() for r in rs]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, n int").repartition(5)
    assert got(repair.audited(df)) == {c: plain(in_order(rs)) for c, rs in convs.items()}


def test_walk_is_least_and_blocks_compose():
    random.seed(3)
    for n in [0, 1, 2, 5, 17, 60]:
        for _ in range(20):
            items = [random.choice("bdt---") + random.choice("suax-") for _ in range(n)]
            cut = random.randint(0, n)
            a, b = repair.matrix(items[:cut]), repair.matrix(items[cut:])
            end = [min(b[4 * s + t] + repair.END[t] for t in range(4)) for s in range(4)]
            whole = repair.matrix(items)
            costs = [min(whole[4 * s + t] + repair.END[t] for t in range(4)) for s in range(4)]
            assert costs == [min(a[4 * s + t] + end[t] for t in range(4)) for s in range(4)]
            for s in range(4):
                one, _, last = repair.walk(items, repair.END, s)
                left, _, mid = repair.walk(items[:cut], end, s)
                right, _, last_too = repair.walk(items[cut:], repair.END, mid)
                assert one == left + right and last == last_too


def test_long_conversation_and_hot_rows(spark):
    """One conversation with most rows, one row very often, null texts and roles, and an empty table."""
    turns = [(i, "user" if i % 2 == 0 else "assistant", f"t{i}.") for i in range(5_000)]
    rows = [(1, *t) for t in turns] + [(1, 40, "user", "t40.")] * 2_000 + [(2, 0, None, None), (3, None, "user", "a.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    out = {r.conv_id: r for r in repair.audited(df).collect()}
    assert (out[1].cost, out[1].duplicate, out[1].illegal, out[1].audit) == (8_000, 2_000, 2_000, "K" * 41 + "D" * 2_000 + "K" * 4_959)
    assert (out[2].blank, out[2].audit, out[2].cost) == (1, "D", 4)
    assert (out[3].gaps, out[3].audit, out[3].cost) == (0, "D", 4) or (out[3].audit, out[3].cost) == ("KI", 3)
    assert repair.audited(df.limit(0)).count() == 0


def test_damage(spark):
    rows = spark.read.parquet(f"{DIR}/conversations.parquet")
    kept = {}
    for r in rows.collect():
        kept.setdefault(r.conv_id, [])
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", r.text) if kind == 2 else r.text
        kept[r.conv_id] += [(r.turn, "user" if kind == 4 else r.role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert got(repair.audited(repair.damaged(rows), "n")) == {c: plain(in_order(rs)) for c, rs in kept.items()}
    lost = spark.createDataFrame([(i, 0, "user", "x.") for i in range(60)], "conv_id long, turn long, role string, text string")
    gone = [r for r in repair.audited(repair.damaged(lost), "n").collect() if zlib.crc32(f"{r.conv_id}:0".encode()) % 20 == 0]
    assert gone and all((r.cost, r.audit, r.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest()) for r in gone)
