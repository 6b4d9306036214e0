"""The prefix trie against dictionaries of prefixes."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from annonia.llm import trie

DIR = "/root/testdata/sf0.001"


def plain(convs):
    """Rows of every node, as a sorted list of tuples, from {conv_id: [(role, text)]}."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = collections.Counter(p[:-1] for p in members if p), collections.Counter(), collections.Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * words
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else -1, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items()
    )


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def table(spark, convs, parts=5):
    rows = [(c, i, r, t, 1, "x") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int, turns string").repartition(parts)


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def made(seed, n=120):
    """Random conversations from few turns, groups of copies, and long ones that part after the range key."""
    random.seed(seed)
    turns = [("user", "a"), ("assistant", "b c"), ("user", ""), ("", "d e f"), ("system", "g")]
    convs = {c: [random.choice(turns) for _ in range(random.randint(1, 7))] for c in range(n)}
    convs |= {1000 + c: list(convs[3]) for c in range(40)}
    trunk = [random.choice(turns) for _ in range(68)]
    convs |= {2000 + c: trunk[: 60 + c % 12] + [random.choice(turns) for _ in range(c % 5)] for c in range(60)}
    convs |= {3000 + c: trunk + [("user", str(c % 3))] * 5 for c in range(30)}
    return convs


@pytest.mark.parametrize("ranges", [1, 13])
def test_against_dictionaries(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        convs = made(ranges)
        assert got(trie.trie(trie.rebuilt(trie.turn_arrays(table(spark, convs))))) == plain(rebuilt(convs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_rows(spark):
    """Nulls, ties, repeated rows, turnless conversations and an empty table."""
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (2, None, "", ""), (None, 0, "user", "lost"), (40, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = {1: [("", ""), ("user", "a"), ("user", "a")], 2: [("", "")], 40: [("user", "a")]}
    assert got(trie.trie(trie.turn_arrays(df))) == plain(convs)
    assert got(trie.trie(trie.rebuilt(trie.turn_arrays(df)))) == plain(rebuilt(convs))
    short = {20: [("user", "x")], **{20 + c: [("user", str(c))] for c in range(1, 20)}}
    again = rebuilt(short)
    assert got(trie.trie(trie.rebuilt(trie.turn_arrays(table(spark, short))))) == plain(again)
    lone = {c: [("user", "x")] for c in range(41, 60)}  # the first of the group is absent: some lose their only turn
    assert any(not t for t in rebuilt(lone).values())
    assert got(trie.trie(trie.rebuilt(trie.turn_arrays(table(spark, lone))))) == plain(rebuilt(lone))
    assert trie.trie(trie.rebuilt(trie.turn_arrays(df.limit(0)))).count() == 0


def test_given_conversations(spark):
    rows = spark.read.parquet(f"{DIR}/conversations.parquet")
    convs = collections.defaultdict(list)
    for r in sorted(rows.collect(), key=lambda r: (r.conv_id, r.turn)):
        convs[r.conv_id].append((r.role, r.text))
    assert got(trie.trie(trie.rebuilt(trie.turn_arrays(rows)))) == plain(rebuilt(convs))


def test_ranks_keep_the_order_of_digests():
    digests = [hashlib.md5(str(k % 50).encode()).digest() for k in range(300)]
    ranks = trie._ranks(np.frombuffer(b"".join(digests), np.uint8))
    order = {d: i for i, d in enumerate(sorted(set(digests)))}
    assert ranks.tolist() == [order[d] for d in digests]
