"""Language-model scores from a probabilistic suffix tree.

The symbols are words, after the last the end of the text, and the contexts up to ``WORDS``
words before. A context is a state of the tree if it occurs ``LEAST_COUNT`` times and foretells the
training symbols, each left out once, better than its parent (the context without its first word) by
more than ``DIVERGENCE`` nats. A state's distribution is smoothed with that of its longest suffix that is
a state (Witten-Bell), the root's with the probability of a word's spelling, so words
never seen are still told apart. A symbol is scored in the longest suffix that is a state.
The states need not be closed under suffixes: two words may tell much where the last of them alone tells little, and then the
longer context is smoothed with the root. Its gain is measured against the counts of the context without its first word, whether
that is a state or not: what counts is what the one more word adds.

Spelling is a second tree over bytes: each word as a blank, its bytes, and a blank. Its contexts go back to the
blank before the word and up to ``DEPTH``, and are kept by the divergence of their next-byte
distribution. It is counted over the distinct training words, each once, and asked for unseen words only.

Documents stand in blocks of about ``BLOCK_BYTES``, written once as a bucketed table, so that what comes back
to a block meets its texts without another shuffle. Runs of one word up to ``WORDS`` + 1 are counted over all
training texts by messages: a block sends the sorted fingerprints of its distinct runs, cut into ranges, and each range
adds up what all blocks sent and answers in the same order. A frequent run is one entry a block. Each run has one block
as its owner; owners add up the gain of each context over the runs they own, and the ranges sum these to the
whole gain. Neither the vocabulary nor a tree is broadcast or collected.

Messages are most of the disk that a run takes, so nothing is sent that the answers before make needless. The longest runs are sent
last, and only those whose context occurs ``LEAST_COUNT`` times; a run that holds a shorter one of this block alone stands in no
other block, so the block counts it itself. The bytes of a word come from its owner, and where no text trains it. Contexts are named
to their range by the ranks among its frequent keys that it gave with the counts, not by their fingerprints again.

Words are told apart by 64 bits. Longer runs have as many bits as the corpus has bytes to number, and 18 more: fewer than one
run in two million shares its count with another.

Input: ``doc_id``, ``text``. Null and empty texts have the end alone as token; a null doc_id counts
as the text 'null' and trains; repeated rows count each time; an empty table gives no rows; other
columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .store import bucketed, new_name, written

DEPTH, WORDS, LEAST_COUNT, DIVERGENCE, SMOOTH = 4, 2, 2, 3.0, 4.0
BLOCK_BYTES, PART_WORDS = 12 << 20, 400_000
#: Most buckets of a table; Spark refuses more than 100,000.
BUCKETS = 50_000
#: Symbols that are scored at a time.
SLICE = 400_000
FOLDS, HELD_OUT = 7, 2
#: Gains are added as whole numbers of this part of a nat, so that sums don't depend on their order.
NAT = 256
_COUNTS = "ctx long, sym int, n long"
_SENT = "kind int, part long, block int, keys binary, n binary, more binary"
_ANSWER = "block int, kind int, part long, data binary"
_COUNTED = _ANSWER + ", ranks binary, n_train long, v_train long, texts long"
_KEPT = _COUNTED + ", key long, score double"
_NAMED = _ANSWER + ", key long, word binary, n long, blocks array<int>"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, unknown_score double"
_BLANK, _END = 0x20, 0x0A
_STOP = tk.mix(np.array([_END], np.uint64))[0]  # the end of a text among the words' hashes
_SPELLED = 0  # kind of the messages that hold words, and of the answers with an unseen word's spelling; the others are 2 * length - 1 (counts) and 2 * length (states)
_OWNER, _ALONE = 1, 2  # what a block is to a run: its owner, or the only block that has it, and so its owner too


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % FOLDS == HELD_OUT


def pack(x: np.ndarray) -> bytes:
    """Whole numbers from 0 as compressed byte planes."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    used = int(np.max(np.flatnonzero(planes.any(1)), initial=-1)) + 1
    return len(x).to_bytes(8, "little") + bytes([used]) + (pa.compress(planes[:used].tobytes(), "zstd", asbytes=True) if used else b"")


def unpack(raw: bytes) -> np.ndarray:
    n, used = int.from_bytes(raw[:8], "little"), raw[8]
    planes = np.zeros((8, n), np.uint8)
    if used:
        planes[:used] = np.frombuffer(pa.decompress(raw[9:], used * n, "zstd", asbytes=True), np.uint8).reshape(used, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys by their differences; the first is apart, as it may be large."""
    first = int(keys[0]) if len(keys) else 0
    return first.to_bytes(8, "little") + pack(np.diff(keys))


def unpack_sorted(raw: bytes) -> np.ndarray:
    steps = unpack(raw[8:])
    out = np.empty(len(steps) + 1, np.uint64)
    out[0] = int.from_bytes(raw[:8], "little")
    out[1:] = steps
    return np.cumsum(out)


def n_sorted(raw: bytes) -> int:
    """How many keys ``pack_sorted`` packed."""
    return int.from_bytes(raw[8:16], "little") + 1


def _ranges(keys: np.ndarray, bits: int, n: int) -> Iterator[tuple[int, int, int]]:
    """(range, from, to) of the ranges, of ``n`` of equal width, in which the sorted ``keys`` of ``bits`` bits lie."""
    if not len(keys):
        return
    top = keys >> tk.U(bits - 32) if bits > 32 else keys << tk.U(32 - bits)
    at = (top * tk.U(n) >> tk.U(32)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    for i, j in zip(new.tolist(), [*new[1:].tolist(), len(keys)]):
        yield int(at[i]), i, j


def sorting(x: np.ndarray) -> np.ndarray:
    """The order that sorts whole numbers, equal ones by place.

    Numbers alone are sorted far faster than their places. So the highest bits go before the place into one number of 64 bits; where
    numbers differ in lower bits only, which is rare among hashes, a second sort mends the order."""
    if not len(x):
        return np.zeros(0, np.int64)
    low = max(1, (len(x) - 1).bit_length())
    cut = max(0, int(x.max()).bit_length() + low - 64)
    packed = (x >> tk.U(cut)) << tk.U(low) | np.arange(len(x), dtype=np.uint64)
    packed.sort()
    order = (packed & tk.U((1 << low) - 1)).astype(np.int64)
    if cut:
        y = x[order]
        if (y[1:] < y[:-1]).any():
            order = order[np.argsort(y, kind="stable")]
    return order


class _Runs:
    """The runs of 1 to ``most`` + 1 symbols of a block's texts."""

    def __init__(self, table: pa.Table, bits: int, most: int):
        seq, sizes, self.words = [], [], []
        train = []
        for chunk, trains in zip(table.column("text").chunks, table.column("train").chunks):
            data, offs = tk.column(chunk)
            for i, j in tk.slices(offs):
                part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                h, starts, ends, first = tk.word_hashes(part, o)
                n = np.diff(first)
                out = np.full(len(h) + len(n), _STOP, np.uint64)
                out[np.arange(len(h)) + np.repeat(np.arange(len(n)), n)] = h
                self.words.append((tk.LOWER[part], starts, ends))
                seq.append(out)
                sizes.append(n + 1)
            train.append(trains.to_numpy(zero_copy_only=False))
        seq, self.sizes = np.concatenate(seq), np.concatenate(sizes)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.train = np.repeat(np.concatenate(train), self.sizes)
        self.place = np.arange(len(seq)) - np.repeat(self.begins, self.sizes)
        self.keys: list[np.ndarray] = []  # sorted, distinct, by number of symbols less one
        self.first: list[np.ndarray] = []  # a place where each stands
        self.at: list[np.ndarray] = []  # for each position the number of the run that ends there, -1 for none
        run = seq
        for k in range(most + 1):
            if k:
                longer = seq.copy()
                longer[1:] = tk.mix(run[:-1] * tk.U(tk._BASE) + seq[1:])
                run = longer
            here = np.flatnonzero(self.place >= k)
            x = run[here] if k == 0 or bits >= 64 else run[here] >> tk.U(64 - bits)
            order = sorting(x)
            x, here = x[order], here[order]
            del order
            new = np.ones(len(x), bool)
            np.not_equal(x[1:], x[:-1], out=new[1:])
            at = np.full(len(seq), -1, np.int32)
            at[here] = np.cumsum(new, dtype=np.int32) - 1
            self.keys.append(x[new])
            self.first.append(here[new].astype(np.int32))
            self.at.append(at)

    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """The words of the first list of keys, each with a line feed behind it, as bytes with offsets; the end of a text is empty."""
        where = self.first[0]
        # positions count the ends of texts, too
        ends_before = np.repeat(np.arange(len(self.sizes)), self.sizes)
        last = self.place == np.repeat(self.sizes - 1, self.sizes)
        number, word = where - ends_before[where], ~last[where]
        begins = np.cumsum([0, *(len(raw) for raw, _, _ in self.words)])[:-1]
        starts, ends = (np.concatenate([w[k] + at for w, at in zip(self.words, begins)]) for k in (1, 2))
        raw = np.concatenate([raw for raw, _, _ in self.words])
        begin, size = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
        begin[word] = starts[number[word]]
        size[word] = ends[number[word]] - begin[word]
        offs = np.concatenate([[0], np.cumsum(size + 1)])
        out = np.full(offs[-1], _END, np.uint8)
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(offs[:-1], size) + inside] = raw[np.repeat(begin, size) + inside]
        return out, offs

    def trained(self, k: int) -> np.ndarray:
        """How often each run of ``k`` + 1 symbols ends in the block's training texts."""
        at = self.at[k]
        return np.bincount(at[(at >= 0) & self.train], minlength=len(self.keys[k]))


def _rows(columns: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [x.split() for x in schema.split(", ")]
    cols = list(zip(*columns)) or [()] * len(fields)
    return pa.table([pa.array(c, kinds[t]) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def _asking(bits: int, most: int, n_ranges: int):
    """A block's messages about its runs but the longest: fingerprints and training counts."""

    def run(table: pa.Table) -> pa.Table:
        runs, block, out = _Runs(table, bits, max(most - 1, 0)), table.column("block")[0].as_py(), []
        for k, keys in enumerate(runs.keys):
            n = runs.trained(k)
            out += [(2 * k + 1, part, block, pack_sorted(keys[i:j]), pack(n[i:j]), None) for part, i, j in _ranges(keys, bits if k else 64, n_ranges)]
        return _rows(out, _SENT)

    return run


def _messages(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The blocks that sent, the ends of their messages, and all keys."""
    keys = [unpack_sorted(x.as_py()) for x in table.column("keys")]
    return table.column("block").to_pylist(), np.cumsum([0, *map(len, keys)]), np.concatenate(keys)


def _counted(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The blocks that sent, the ends of their messages, the number of each key among the distinct ones; these, their first places and counts."""
    blocks, cut, keys = _messages(table)
    sent = np.concatenate([unpack(x.as_py()) for x in table.column("n")]).astype(float)
    order = sorting(keys)
    new = np.ones(len(keys), bool)
    np.not_equal(keys[order[1:]], keys[order[:-1]], out=new[1:])
    first = order[new]
    number = np.empty(len(keys), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return blocks, cut, number, keys[first], first, np.bincount(number, weights=sent).astype(np.uint64)


def _answer(number: np.ndarray, first: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Counts times 4, plus what the block is to the run. The count of a run that one block has alone is left out: that block knows it."""
    answer = total[number] << tk.U(2)
    answer[first] += tk.U(_OWNER)
    answer[(np.bincount(number) == 1)[number]] = _ALONE
    return answer


def _counting(table: pa.Table) -> pa.Table:
    """Answers each block with its runs' counts in all training texts, and with the ranks of its frequent runs among the range's."""
    kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
    blocks, cut, number, distinct, first, total = _counted(table.sort_by("block"))
    answer, frequent = _answer(number, first, total), total >= LEAST_COUNT
    rank = np.cumsum(frequent, dtype=np.uint64) - tk.U(1)
    out = []
    for b, i, j in zip(blocks, cut, cut[1:]):
        own = number[i:j][frequent[number[i:j]]]
        out.append((b, kind, part, pack(answer[i:j]), pack_sorted(rank[own]) if len(own) else None, None, None, None))
    if kind == 1:
        out.append((None, kind, part, None, None, int(total.sum()), int((total > 0).sum()), int(total[distinct == _STOP].sum())))
    return _rows(out, _COUNTED)


def _told(answer: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, whether the block owns the run, and whether it alone has it; ``own`` are the block's own counts."""
    alone = answer & 3 == _ALONE
    return np.where(alone, own, answer >> 2), answer & 3 > 0, alone


def _shorter_counts(left: pa.Table, runs: _Runs, most: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What was answered about all runs but the longest, by their symbols less one."""
    return [_told(_answers(left, 2 * k + 1), runs.trained(k)) for k in range(max(most, 1))]


def _longest(runs: _Runs, told: list, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the longest runs with a frequent context the block counts itself, as no other can have them, and which it asks about."""
    counts, _, alone = told[most - 1]
    where = runs.first[most]
    context, rest = runs.at[most - 1][where - 1], runs.at[most - 1][where]
    used, here = counts[context] >= LEAST_COUNT, alone[context] | alone[rest]
    return used & here, np.flatnonzero(used & ~here)


def _asking_longest(bits: int, most: int, n_ranges: int):
    """A block's messages about its longest runs, and about the words that it owns or that no text trains, with their bytes."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        runs, block, out = _Runs(right, bits, most), right.column("block")[0].as_py(), []
        told = _shorter_counts(left, runs, most)
        if most:
            _, asked = _longest(runs, told, most)
            keys, n = runs.keys[most][asked], runs.trained(most)[asked]
            out += [(2 * most + 1, part, block, pack_sorted(keys[i:j]), pack(n[i:j]), None) for part, i, j in _ranges(keys, bits, n_ranges)]
        counts, owned, _ = told[0]
        named = np.flatnonzero(owned | (counts == 0))
        raw, offs = runs.spelled()
        keys, n, begins, ends = runs.keys[0][named], counts[named], offs[named].tolist(), (offs[named + 1] - 1).tolist()
        for part, i, j in _ranges(keys, 64, n_ranges):
            text = b"\n".join(raw[x:y].tobytes() for x, y in zip(begins[i:j], ends[i:j]))
            more = len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True)
            out.append((_SPELLED, part, block, pack_sorted(keys[i:j]), pack(n[i:j]), more))
        return _rows(out, _SENT)

    return run


def _naming(table: pa.Table) -> pa.Table:
    """Answers each block with the counts of its longest runs; of words, rows with their bytes and, of unseen ones, the blocks that have them."""
    kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
    table = table.sort_by("block")
    if kind != _SPELLED:
        blocks, cut, number, _, first, total = _counted(table)
        answer = _answer(number, first, total)
        return _rows([(b, kind, part, pack(answer[i:j]), None, None, None, None) for b, i, j in zip(blocks, cut, cut[1:])], _NAMED)
    blocks, cut, number, distinct, first, total = _counted(table)  # whoever sends a word knows its whole count: one owner, or 0 of all
    words: list[bytes] = []
    for x in table.column("more"):
        raw = x.as_py()
        words += pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True).split(b"\n")
    unseen: dict[int, list[int]] = {}
    for i in np.flatnonzero(total[number] == 0).tolist():
        unseen.setdefault(int(number[i]), []).append(blocks[int(np.searchsorted(cut, i, side="right")) - 1])
    signed = distinct.view(np.int64).tolist()
    return _rows([(None, kind, part, None, signed[x], words[i], n, unseen.get(x, [])) for x, (i, n) in enumerate(zip(first.tolist(), total.tolist()))], _NAMED)


def _answers(left: pa.Table, kind: int) -> np.ndarray:
    """What the ranges answered, in the order of the keys."""
    own = left.filter(pc.equal(left.column("kind"), kind)).sort_by("part")
    parts = [unpack(x.as_py()) for x in own.column("data")]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)).astype(np.int64)


def _all_counts(left: pa.Table, runs: _Runs, most: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Counts in all training texts and whether the block owns the run, by the runs' symbols less one; 0 for the longest with a rare context, which no state asks for."""
    told = _shorter_counts(left, runs, most)
    counts, owned = [x[0] for x in told], [x[1] for x in told]
    if most:
        local, asked = _longest(runs, told, most)
        own = runs.trained(most)
        n, owner = np.where(local, own, 0), local
        n[asked], owner[asked], _ = _told(_answers(left, 2 * most + 1), own[asked])
        counts.append(n)
        owned.append(owner)
    return counts, owned


def _asked_contexts(counts: list[np.ndarray], length: int) -> np.ndarray:
    """Which runs of ``length`` symbols the block asks about as contexts."""
    return np.flatnonzero(counts[length - 1] >= LEAST_COUNT)


def _gaining(bits: int, most: int, n_train: int):
    """A block's messages about its contexts: gain and number of different next symbols, over the runs that it owns."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        runs, out = _Runs(right, bits, most), []
        block = right.column("block")[0].as_py()
        counts, owned = _all_counts(left, runs, most)
        for length in range(1, most + 1):
            own = np.flatnonzero(owned[length] & (counts[length] > 0))
            where = runs.first[length][own]
            context = runs.at[length - 1][where - 1]
            total = counts[length - 1][context]
            own, where, context, total = (x[total >= LEAST_COUNT] for x in (own, where, context, total))
            n, n_up = counts[length][own], counts[length - 1][runs.at[length - 1][where]]
            total_up = n_train if length == 1 else counts[length - 2][runs.at[length - 2][where - 1]]
            gain = np.rint(NAT * left_out_gain(n, total, n_up / total_up))
            kinds = len(runs.keys[length - 1])
            gains, nexts = np.bincount(context, weights=gain, minlength=kinds).astype(np.int64), np.bincount(context, minlength=kinds)
            asked = _asked_contexts(counts, length)
            gains, nexts = gains[asked], nexts[asked]
            folded = np.where(gains < 0, -2 * gains - 1, 2 * gains)
            ranked = left.filter(pc.and_(pc.equal(left.column("kind"), 2 * length - 1), pc.is_valid(left.column("ranks")))).sort_by("part")
            j = 0
            for part, ranks in zip(ranked.column("part").to_pylist(), ranked.column("ranks").to_pylist()):
                i, j = j, j + n_sorted(ranks)
                out.append((2 * length, part, block, ranks, pack(folded[i:j]), pack(nexts[i:j])))
        return _rows(out, _SENT)

    return run


def left_out_gain(n, total, up):
    """Nats that a context gains over its parent for a symbol seen ``n`` of ``total`` times, each time left out, with the parent's probability ``up`` as one more occurrence."""
    return n * np.log((n - 1 + up) / (total * up))


def _judging(table: pa.Table) -> pa.Table:
    """Answers each block with the number of next symbols of each of its contexts, 0 for those that aren't states."""
    kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
    blocks, cut, ranks = _messages(table)
    number = ranks.astype(np.int64)
    folded = np.concatenate([unpack(x.as_py()) for x in table.column("n")]).astype(np.int64)
    gain = np.where(folded % 2 == 1, -(folded + 1) // 2, folded // 2)
    nexts = np.concatenate([unpack(x.as_py()) for x in table.column("more")]).astype(float)
    state = np.bincount(number, weights=gain.astype(float)) > DIVERGENCE * NAT
    answer = np.where(state, np.bincount(number, weights=nexts), 0)[number].astype(np.int64)
    return _rows([(b, kind, part, pack(answer[i:j])) for b, i, j in zip(blocks, cut, cut[1:])], _ANSWER)


def _symbols(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words as blank + bytes + blank, and the offsets. A zero byte counts as 0x1F, as zero pads the contexts."""
    data, offs = tk.column(words)
    size = np.diff(offs)
    out = np.full(len(data) + 2 * len(size), _BLANK, np.uint8)
    o = offs + 2 * np.arange(len(offs))
    out[np.arange(len(data)) + np.repeat(2 * np.arange(len(size)) + 1, size)] = np.where(data == 0, 0x1F, data)
    return out, o


def _contexts(sym: np.ndarray, o: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions that are predicted (all but each word's first blank) and, for each length, their contexts (0: none so long)."""
    at = np.delete(np.arange(len(sym)), o[:-1])
    inside = at - np.repeat(o[:-1], np.diff(o) - 1)
    ctxs, code = [np.zeros(len(at), np.int64)], np.zeros(len(at), np.int64)
    for d in range(1, depth + 1):
        ok = inside >= d
        code = np.where(ok, code | sym[np.maximum(at - d, 0)].astype(np.int64) << (8 * (d - 1)), 0)
        ctxs.append(np.where(ok, code, 0))
    return at, ctxs


def _context_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (context, next symbol), summed up within the task."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        c, s, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((s, c))
        c, s, n = c[order], s[order], n[order]
        new = np.concatenate([[True], (c[1:] != c[:-1]) | (s[1:] != s[:-1])]) if len(c) else np.zeros(0, bool)
        f = np.flatnonzero(new)
        return c[f], s[f], np.add.reduceat(n, f) if len(f) else n

    held: list = []
    for batch in batches:
        for k in range(0, len(batch), 20_000):
            part = batch.slice(k, 20_000)
            sym, o = _symbols(part.column(0))
            n = np.ones(len(part), np.int64)  # each distinct word once
            at, ctxs = _contexts(sym, o, DEPTH)
            weight, nxt = np.repeat(n, np.diff(o) - 1), sym[at].astype(np.int64)
            rows = [(ctxs[0], nxt, weight)] + [(c[m], nxt[m], weight[m]) for c in ctxs[1:] if (m := c != 0).any()]
            held.append(merged(rows))
            if sum(len(x[0]) for x in held) > 3_000_000:
                held = [merged(held)]
    if held:
        c, s, n = merged(held)
        for i in range(0, len(c), 100_000):
            yield pa.record_batch([pa.array(c[i : i + 100_000]), pa.array(s[i : i + 100_000].astype(np.int32)), pa.array(n[i : i + 100_000])], names=["ctx", "sym", "n"])


def tree(words: DataFrame, n_texts: int) -> DataFrame:
    """(ctx, sym, n, total) of the retained contexts; ``words`` has (word, n), the training counts. The end of a text counts as one word."""
    spark = words.sparkSession
    # the end of a text comes after a blank, in the contexts '' and ' '
    ends = spark.createDataFrame([(0, _END, min(n_texts, 1)), (_BLANK, _END, min(n_texts, 1))], _COUNTS)
    counts = words.where("n > 0").mapInArrow(_context_counts, _COUNTS).union(ends).where("n > 0")
    counts = written(counts.groupBy("ctx", "sym").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("ctx").agg(F.sum("n").alias("total"))
    frequent = written(counts.join(totals.where((F.col("total") >= LEAST_COUNT) | (F.col("ctx") == 0)), "ctx"))
    parent = frequent.where("ctx <> 0").withColumn("up", F.col("ctx").bitwiseAND(F.expr(f"shiftleft(1L, 8 * (({depth_sql()}) - 1)) - 1")))
    above = frequent.select(F.col("ctx").alias("up"), "sym", F.col("n").alias("n_up"), F.col("total").alias("total_up"))
    gain = F.sum(F.col("n") * F.log((F.col("n") / F.col("total")) / (F.col("n_up") / F.col("total_up"))))
    telling = parent.join(above, ["up", "sym"]).groupBy("ctx").agg(gain.alias("gain"), F.count("*").alias("k")).where(F.col("gain") > DIVERGENCE * (1 + F.col("k") / 8))
    suffixes = F.array(*(F.col("ctx").bitwiseAND(F.lit((1 << 8 * d) - 1)) for d in range(DEPTH + 1)))
    states = telling.select(F.explode(suffixes).alias("ctx")).union(spark.createDataFrame([(0,)], "ctx long")).distinct()
    return written(frequent.join(states, "ctx").select("ctx", "sym", "n", "total"))


def _part_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct byte contexts of the words of each part."""
    for batch in batches:
        part = batch.column(0).to_numpy()
        for x in np.unique(part):
            sym, o = _symbols(batch.column(1).filter(pa.array(part == x)))
            ctx = np.unique(np.concatenate(_contexts(sym, o, DEPTH)[1]))
            yield pa.record_batch([pa.array(np.full(len(ctx), x, np.int32)), pa.array(ctx)], names=["part", "ctx"])


def _offsets(lists: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])


def depth_sql() -> str:
    """Length of the context in column ctx."""
    return " + ".join(f"cast(ctx >= {1 << 8 * d} as int)" for d in range(DEPTH))


class Tree:
    """Smoothed log10 probabilities of the states, for lookup by (context, symbol)."""

    def __init__(self, ctx: np.ndarray, sym: np.ndarray, n: np.ndarray, total: np.ndarray):
        self.levels: list[tuple[np.ndarray, ...]] = []
        # level by level: probability = (n + SMOOTH * parent's) / (total + SMOOTH)
        order = np.lexsort((sym, ctx))
        ctx, sym, n, total = ctx[order], sym[order].astype(np.int64), n[order].astype(float), total[order].astype(float)
        length = np.zeros(len(ctx), np.int64)
        for d in range(DEPTH):
            length += ctx >= (1 << 8 * d)
        root = np.full(256, 1.0)
        root[sym[length == 0]] += n[length == 0]
        self.root = root / root.sum()
        for d in range(1, DEPTH + 1):
            m = length == d
            c, s = ctx[m], sym[m]
            up = self._below(c & ((1 << 8 * (d - 1)) - 1), s, d - 1)
            prob = (n[m] + SMOOTH * up) / (total[m] + SMOOTH)
            states, at = np.unique(c, return_index=True)
            self.levels.append((states, SMOOTH / (total[m][at] + SMOOTH), (c << 8) | s, prob))

    def _below(self, ctx: np.ndarray, sym: np.ndarray, depth: int) -> np.ndarray:
        """Probability of ``sym`` after ``ctx`` in the longest of its suffixes, up to ``depth``, that is a state."""
        p = self.root[sym]
        for d in range(1, depth + 1):
            states, back, keys, prob = self.levels[d - 1]
            if not len(states):
                continue
            c = ctx & ((1 << 8 * d) - 1)
            k = np.minimum(np.searchsorted(states, c), len(states) - 1)
            state = (states[k] == c) & (c >= (1 << 8 * (d - 1)))
            key = (c << 8) | sym
            j = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            p = np.where(state, np.where(keys[j] == key, prob[j], back[k] * p), p)
        return p

    def words(self, words: pa.Array) -> np.ndarray:
        """log10 probability of each word and the blank after it."""
        sym, o = _symbols(words)
        at, ctxs = _contexts(sym, o, DEPTH)
        longest = ctxs[0]
        for c in ctxs[1:]:
            longest = np.where(c != 0, c, longest)
        p = np.log10(self._below(longest, sym[at].astype(np.int64), DEPTH))
        c = np.concatenate([[0], np.cumsum(p)])
        cut = np.concatenate([[0], np.cumsum(np.diff(o) - 1)])
        return c[cut[1:]] - c[cut[:-1]]

def spelling_scores(words: DataFrame, n_texts: int) -> DataFrame:
    """(key, score): log10 of the spelling of the words without a training count; ``words`` has (key, word, n)."""
    spelling = tree(words.where("length(word) > 0").select("word", "n"), n_texts)
    unseen = words.where("n = 0 and length(word) > 0").select("key", "word")
    n_parts = max(1, -(-unseen.count() // PART_WORDS))
    parts = unseen.withColumn("part", F.pmod("key", F.lit(n_parts)).cast("int"))
    nexts = spelling.groupBy("ctx").agg(F.max("total").alias("total"), F.collect_list(F.struct("sym", "n")).alias("nexts"))  # at most 256 each
    needed = parts.select("part", "word").mapInArrow(_part_contexts, "part int, ctx long").distinct().join(nexts, "ctx")

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        at = np.repeat(np.arange(len(left)), np.diff(_offsets(left.column("nexts"))))
        nexts = left.column("nexts").combine_chunks().flatten()
        own = Tree(left.column("ctx").to_numpy()[at], nexts.field("sym").to_numpy(), nexts.field("n").to_numpy(), left.column("total").to_numpy()[at])
        score = [own.words(right.slice(k, 20_000).column("word")) for k in range(0, len(right), 20_000)]
        return pa.table({"key": right.column("key"), "score": np.concatenate(score) if score else np.zeros(0)})

    return needed.groupBy("part").cogroup(parts.groupBy("part")).applyInArrow(rate, "key long, score double")


def _scoring(bits: int, most: int, n_train: int, v_train: int):
    kinds_root = max(v_train, 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        runs = _Runs(right, bits, most)
        counts, _ = _all_counts(left, runs, most)
        # the root: counts, and for unseen words the share that new words have, by their spelling
        spelled = left.filter(pc.equal(left.column("kind"), _SPELLED)).sort_by("key")
        keys, score = spelled.column("key").to_numpy().view(np.uint64), spelled.column("score").to_numpy()
        order = np.argsort(keys)
        keys, score = keys[order], score[order]
        words = np.full(len(runs.keys[0]), -np.log10(256.0))  # the end of a text, where no text trains
        if len(keys):
            at = np.minimum(np.searchsorted(keys, runs.keys[0]), len(keys) - 1)
            words = np.where(keys[at] == runs.keys[0], score[at], words)
        words += np.log10(kinds_root / (n_train + kinds_root))
        words = np.where(counts[0] > 0, np.log10(np.maximum(counts[0], 1) / (n_train + kinds_root)), words)
        base = np.log10((counts[0] + 1) / (n_train + v_train + 1))
        states = []
        for length in range(1, most + 1):
            nexts = np.zeros(len(runs.keys[length - 1]), np.int64)
            nexts[_asked_contexts(counts, length)] = _answers(left, 2 * length)
            states.append(nexts)
        sums: list[list[np.ndarray]] = [[], [], [], []]
        i = 0
        while i < len(runs.sizes):  # some texts at a time
            j = max(i + 1, int(np.searchsorted(runs.begins, runs.begins[i] + SLICE)))
            lo, hi = int(runs.begins[i]), int(runs.begins[j]) if j < len(runs.begins) else len(runs.place)
            own = runs.at[0][lo:hi]
            p, known = words[own], counts[0][own] > 0
            for length in range(1, most + 1):  # from the shortest context to the longest
                here = lo + np.flatnonzero(runs.place[lo:hi] >= length)
                context = runs.at[length - 1][here - 1]
                state = states[length - 1][context] > 0
                here, context = here[state], context[state]
                times, total, kinds, lower = counts[length][runs.at[length][here]], counts[length - 1][context], states[length - 1][context], p[here - lo]
                mixed = np.log10((np.maximum(times, 1) + kinds * 10.0 ** np.maximum(lower, -300)) / (total + kinds))
                p[here - lo] = np.where(times > 0, mixed, lower + np.log10(kinds / (total + kinds)))
            for out, x in zip(sums, (known.astype(np.int64), base[own], p, np.where(known, 0.0, p))):
                out.append(np.add.reduceat(x, runs.begins[i:j] - lo))
            i = j
        n_known, base_score, score, unknown = (np.concatenate(x) for x in sums)
        return pa.table(
            {"doc_id": right.column("doc_id"), "held_out": pc.invert(right.column("train")), "n_tokens": runs.sizes, "n_known": n_known,
             "train_tokens": np.full(len(right), n_train, np.int64), "base_score": base_score, "score": score, "unknown_score": unknown}
        )

    return run


def in_blocks(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, int, int]:
    """(block, doc_id, train, text) as a table bucketed by block, the number of buckets, and the bytes of text.

    A block lies within one input partition, so nothing is shuffled. Up to ``BUCKETS`` blocks, numbers are chosen so that each
    falls into a bucket of its own; beyond, a bucket holds several, which its task takes one after the other. Should the input's
    partitions differ from those that were counted, blocks get larger, but no row is lost."""
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), (~held_out(docs["doc_id"])).alias("train"), docs["text"].cast("string").alias("text"))
    sizes = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size"))
    total, largest, parts = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0)), F.coalesce(F.max("part") + 1, F.lit(1))).first()
    each = max(1, -(-int(largest) // block_bytes))
    n = int(parts) * each
    block = F.pmod(F.spark_partition_id(), F.lit(int(parts))) * each + F.pmod(F.monotonically_increasing_id(), F.lit(each)).cast("int")
    if n <= BUCKETS:
        names = spark.range(16 * n + 64).groupBy(F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("bucket")).agg(F.min("id").cast("int").alias("id"))
        own = {r.bucket: r.id for r in names.collect()}
        block = F.element_at(F.lit([own.get(k, 17 * n + 64 + k) for k in range(n)]), block + 1)
    n = min(n, BUCKETS)
    return bucketed(rows.withColumn("block", block.cast("int")), n, "block"), n, int(total)


def scores(docs: DataFrame, block_bytes: int = BLOCK_BYTES, most: int = WORDS) -> DataFrame:
    """Base (add-one unigram) and tree score, with contexts of up to ``most`` words, of every document; ``unknown_score`` is the part of the score that falls to words never seen in training."""
    blocks, n_buckets, total = in_blocks(docs, block_bytes)
    bits, n_ranges = min(64, max(33, total.bit_length() + 18)), max(1, -(-total // block_bytes))

    def answered(messages: DataFrame, answer, schema: str) -> DataFrame:
        return messages.groupBy("kind", "part").applyInArrow(answer, schema)

    name, none = new_name(), F.lit(None)

    def kept(df: DataFrame, *columns: str) -> DataFrame:
        """All answers to the blocks so far, with those of ``df``, in one table with the blocks' buckets: each is shuffled once, however many steps read it."""
        rows = df.select(*(F.col(c) if c in columns else none.cast(t).alias(c) for c, t in (x.split() for x in _KEPT.split(", "))))
        return bucketed(rows.repartition(n_buckets, "block"), n_buckets, "block", name)

    def with_texts(answers: DataFrame, *columns: str):
        return answers.where("block is not null").select("block", "kind", "part", "data", *columns).groupBy("block").cogroup(blocks.groupBy("block"))

    sums = ("n_train", "v_train", "texts")
    answers = kept(answered(blocks.groupBy("block").applyInArrow(_asking(bits, most, n_ranges), _SENT), _counting, _COUNTED), "block", "kind", "part", "data", "ranks", *sums)
    n_train, v_train, texts = answers.where("block is null").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in sums)).first()
    longest = with_texts(answers).applyInArrow(_asking_longest(bits, most, n_ranges), _SENT)
    named = written(answered(longest, _naming, _NAMED))
    answers = kept(named.where("block is not null"), "block", "kind", "part", "data")
    gains = with_texts(answers, "ranks").applyInArrow(_gaining(bits, most, n_train), _SENT)
    kept(answered(gains, _judging, _ANSWER), "block", "kind", "part", "data")
    words = named.where("word is not null").select("key", "word", "n", "blocks")
    spelled = spelling_scores(words, texts).join(words.where("n = 0").select("key", F.explode("blocks").alias("block")), "key")
    answers = kept(spelled.withColumn("kind", F.lit(_SPELLED)), "block", "kind", "key", "score")
    return with_texts(answers, "key", "score").applyInArrow(_scoring(bits, most, n_train, v_train), _SCORES)
