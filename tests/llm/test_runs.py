"""Order, words and messages of a block's runs in the suffix-tree operator."""

import collections
import itertools
import random

import numpy as np
import pyarrow as pa

from annonia.llm import suffix_tree as st


def test_sorting_is_a_stable_order():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 5000):
        for top in (1, 300, 2**33, 2**64 - 1):
            x = rng.integers(0, top, n, dtype=np.uint64, endpoint=True)
            assert (st.sorting(x) == np.argsort(x, kind="stable")).all()
    # the highest bits tell nothing apart
    x = rng.integers(0, 50, 5000, dtype=np.uint64) + (rng.integers(0, 3, 5000, dtype=np.uint64) << np.uint64(62))
    assert (st.sorting(x) == np.argsort(x, kind="stable")).all()


def test_words_of_a_block():
    texts = ["The cat  the hat", "", None, "é\x00x cat\nThe", " "]
    runs = st._Runs(pa.table({"text": pa.chunked_array([texts[:2], texts[2:]], pa.string()), "train": pa.chunked_array([[True] * 2, [True] * 3])}), 40, 2)
    raw, offs = runs.spelled()
    assert len(offs) == len(runs.keys[0]) + 1
    assert sorted(raw[i : j - 1].tobytes() for i, j in zip(offs, offs[1:])) == sorted([b"", b"the", b"cat", b"hat", "é\x00x".encode()])
    only_ends = st._Runs(pa.table({"text": pa.chunked_array([["", None]], pa.string()), "train": [True] * 2}), 40, 2)
    assert only_ends.spelled()[0].tobytes() == b"\n"


def _answered(messages, answer):
    """What the ranges answer, as Spark would group it."""
    rows = pa.concat_tables(messages).to_pylist()
    key = lambda r: (r["kind"], r["part"])
    schema = messages[0].schema
    return [r for _, own in itertools.groupby(sorted(rows, key=key), key) for r in answer(pa.Table.from_pylist(list(own), schema)).to_pylist()]


def _left(rows, block):
    kinds = {"block": pa.int32(), "kind": pa.int32(), "part": pa.int64(), "data": pa.binary(), "ranks": pa.binary()}
    return pa.Table.from_pylist([r for r in rows if r["block"] == block], pa.schema(kinds))


def test_messages_hold_only_what_no_answer_tells():
    """Blocks know all counts that a state asks for, though the longest runs, words and contexts aren't sent again by every block."""
    r, bits, n_ranges = random.Random(6), 60, 3
    texts = [[" ".join(r.choice("abcdefghijkl") if r.random() < 0.8 else f"w{r.randrange(400)}" for _ in range(r.randrange(25))) for _ in range(30)] for _ in range(3)]
    texts[0] += ["only here only here again", "twice said twice said"]
    trains = [[r.random() < 0.8 for _ in x] for x in texts]
    tables = [pa.table({"block": pa.array([b] * len(x), pa.int32()), "text": pa.chunked_array([x], pa.string()), "train": pa.chunked_array([t])}) for b, (x, t) in enumerate(zip(texts, trains))]
    count, holders, sequences = collections.Counter(), collections.defaultdict(set), []
    for b, (own, train) in enumerate(zip(texts, trains)):
        sequences.append([])
        for text, t in zip(own, train):
            w = [*text.split(), ""]
            sequences[b] += w
            for j, k in itertools.product(range(len(w)), range(3)):
                if j >= k:
                    count[tuple(w[j - k : j + 1])] += t
                    holders[tuple(w[j - k : j + 1])].add(b)
    answers = _answered([st._asking(bits, 2, n_ranges)(t) for t in tables], st._counting)
    assert [sum(r[c] or 0 for r in answers) for c in ("n_train", "v_train", "texts")] == [sum(n for x, n in count.items() if len(x) == 1), sum(n > 0 for x, n in count.items() if len(x) == 1), count[("",)]]
    longest = [st._asking_longest(bits, 2, n_ranges)(_left(answers, b), t) for b, t in enumerate(tables)]
    named = _answered(longest, st._naming)
    words = {x["word"].decode(): x for x in named if x["word"] is not None}
    assert {w: x["n"] for w, x in words.items()} == {x[0]: n for x, n in count.items() if len(x) == 1}
    assert all(set(x["blocks"]) == (holders[(w,)] if not x["n"] else set()) for w, x in words.items()) and any(x["blocks"] for x in words.values())
    sent = [sum(st.n_sorted(m["keys"]) for m in t.to_pylist() if m["kind"] == 5) for t in longest]
    spelled = sum(st.n_sorted(m["keys"]) for t in longest for m in t.to_pylist() if m["kind"] == st._SPELLED)
    assert spelled == sum(1 if count[x] else len(holders[x]) for x in count if len(x) == 1)
    answers += [{**x, "ranks": None} for x in named if x["block"] is not None]
    owners = collections.Counter()
    for b, table in enumerate(tables):
        left, runs = _left(answers, b), st._Runs(table, bits, 2)
        counts, owned = st._all_counts(left, runs, 2)
        run = [[tuple(sequences[b][i - k : i + 1]) for i in runs.first[k]] for k in range(3)]
        for k in range(3):
            assert [count[x] if k < 2 or count[x[:-1]] >= 2 else 0 for x in run[k]] == counts[k].tolist()
            owners.update(x for x, own in zip(run[k], owned[k]) if own)
        assert sent[b] == sum(count[x[:-1]] >= 2 and len(holders[x[:-1]]) > 1 and len(holders[x[1:]]) > 1 for x in run[2]) < 0.75 * len(run[2])
        gains = st._gaining(bits, 2, 1000)(left, table).to_pylist()
        for length in (1, 2):
            asked = [st.unpack_sorted(m["keys"]) for m in gains if m["kind"] == 2 * length]
            assert sum(map(len, asked)) == sum(count[x] >= 2 for x in run[length - 1])
            # ranks, not fingerprints of 60 bits
            assert max(int(x.max()) for x in asked) < sum(n >= 2 for x, n in count.items() if len(x) == length)
    assert set(owners.values()) == {1} and set(owners) == {x for x in count if len(x) < 3 or count[x[:-1]] >= 2}
