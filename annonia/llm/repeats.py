"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier in the corpus
(documents in the order of their ids). Windows of that length are cut into runs that share
their minimiser, the 24-byte string of least hash within the window. Equal windows have equal
minimisers at equal offsets, so they meet if runs are shuffled by minimiser. Then

1. of runs with the same bytes the first stays, all others are repeats as a whole;
2. where a minimiser has several different runs, their bytes are fetched, the suffixes that
   start in them are sorted, and the previous and next smaller positions in suffix order give
   each its longest previous factor; a window is a repeat if that reaches its length.

Of runs with the same bytes this is the whole answer, so longest-previous-factor arrays are built where bytes differ.

Map tasks resolve copies among their own runs first, so a passage in a third of all documents
sends one row a task. A minimiser with over ``HOT`` different runs is dealt out window by
window, each by its own hash, after the same reduction; nothing is capped. Minimisers that a sample of
about ``SAMPLE_BYTES`` of text shows to be that frequent have their runs dealt out by content from the start, so that no
task gets all of them; the sample only decides where rows go.

Input: ``doc_id``, ``text``; ``text`` counts as UTF-8 bytes, null as empty. Rows that share a
doc_id but not their text are separate documents, ordered by a hash of the text; rows alike in
both are one document, all with its result. A null doc_id comes before all others. An empty
table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .store import written

LENGTH, GRAM, HOT = 100, 24, 2000
FLUSH, BLOCK = 1_500_000, 400_000
#: The sample that shows hot minimisers, and how many different runs in it make one hot.
SAMPLE_BYTES, SAMPLE_RUNS = 16 << 20, 50
#: Least share of the corpus in the sample; most hot minimisers, which every task gets (8 bytes each).
LEAST_SHARE, MOST_HOT = 1 / 2048, 1 << 20
#: Windows that are taken at a time; twenty bits number their places.
CHUNK = (1 << 19) - 256
#: Digests of hot windows that a task remembers at a time.
SEEN = 200_000
#: In ``at``: the start, then a bit for hot minimisers, one for copies, and seven for the number of windows.
_COPY, _HOT, _START = 1 << 7, 1 << 8, 9
_ALL_HOT = (1 << 31) - 1
#: Bytes of text for each task of the two shuffles, which hold their rows at once.
TASK_BYTES = 64 << 20
_POS = np.uint64((1 << 20) - 1)
_RUNS = "mh long, ch long, doc long, sub long, at long"
_FOUND = "doc long, sub long, begin long, end long, mh long, n_runs int"
_PIECES = "key long, doc long, sub long, begin long, piece binary"
_SPANS = "doc long, sub long, begin long, end long"


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position on."""
    h, width, at8 = tk._BYTE[b], 1, None
    while width < 16:
        if width == 8:
            at8 = h
        h = h[:-width] * tk.U(pow(tk._BASE, width, 1 << 64)) + h[width:]
        width *= 2
    return tk.mix(h[:-8] * tk.U(pow(tk._BASE, 8, 1 << 64)) + at8[16:])


def runs(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimiser: text index, start, number of windows, minimiser hash, content hash."""
    out: list[tuple[np.ndarray, ...]] = []
    most = CHUNK
    for lo in range(0, max(len(data) - LENGTH + 1, 0), most):
        b = data[lo : lo + most + LENGTH - 1]
        n = len(b) - LENGTH + 1
        g = _gram_hashes(b)
        m = (g & ~_POS) | np.arange(len(g), dtype=np.uint64)
        s = 1
        while s < 64:
            m = np.minimum(m[:-s], m[s:])
            s *= 2
        wide = LENGTH - GRAM + 1
        m = np.minimum(m[: len(m) - (wide - 64)], m[wide - 64 :])[:n]
        doc = np.searchsorted(offs, np.arange(lo, lo + n), side="right") - 1 if len(offs) > 2 else np.zeros(n, np.int64)
        fits = np.arange(lo, lo + n) + LENGTH <= offs[doc + 1]
        at = np.flatnonzero(fits)
        if not len(at):
            continue
        p = (m[at] & _POS).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] - at[:-1] != 1) | (p[1:] != p[:-1]) | (doc[at[1:]] != doc[at[:-1]])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        start, where = at[first], p[first]
        power, inverse = tk._powers(20)
        terms = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(tk._BYTE[b] * power[: len(b)], out=terms[1:])
        end = start + count + LENGTH - 1
        content = tk.mix((terms[end] - terms[start]) * inverse[start] + count.astype(np.uint64))
        d = doc[start]
        out.append((d, start + lo - offs[d], count, g[where], content))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _firsts(cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by minimiser, content, document and start; and which rows are the first of their content."""
    order = np.lexsort((cols[4], cols[3], cols[2], cols[1], cols[0]))
    mh, ch = cols[0][order], cols[1][order]
    first = np.ones(len(order), bool)
    first[1:] = (mh[1:] != mh[:-1]) | (ch[1:] != ch[:-1])
    return order, first


def _batch(cols, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, kinds[t]) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def _chunks(cols: list, schema: str, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(cols[0]), size):
        yield _batch([c[i : i + size] for c in cols], schema)


def _text_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Minimiser, content, document, sub and place of the runs of some texts at a time."""
    for batch in batches:
        ids, subs = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        data, offs = tk.column(batch.column(2))
        for i, j in tk.slices(offs):
            d, start, count, mh, ch = runs(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            yield [mh.view(np.int64), ch.view(np.int64), ids[i:j][d], subs[i:j][d], start << _START | count]


def _sampled_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cols in _text_runs(batches):
        yield pa.record_batch([pa.array(c) for c in cols[:2]], names=["mh", "ch"])


def hot_minimisers(texts: DataFrame, total: int, sample_bytes: int = SAMPLE_BYTES, sample_runs: int = SAMPLE_RUNS) -> np.ndarray:
    """Minimisers with many different runs in a sample of texts, at most ``MOST_HOT`` of them.

    The sample grows with the corpus (``LEAST_SHARE``), so that what stays unsplit grows far slower than the corpus; where
    more than ``MOST_HOT`` minimisers could have ``sample_runs`` runs in it, more runs are asked for."""
    share = min(1.0, max(LEAST_SHARE, sample_bytes / max(total, 1)))
    unit = F.shiftrightunsigned(F.xxhash64("doc", "sub", F.lit(1)), 11) / F.lit(float(1 << 53))
    counts = written(texts.where(unit < share).mapInArrow(_sampled_runs, "mh long, ch long").distinct().groupBy("mh").count())
    n_runs = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    found = counts.where(F.col("count") >= max(sample_runs, -(-n_runs // MOST_HOT)))
    return np.sort(np.array([r.mh for r in found.select("mh").collect()], np.int64))


def _map_runs(hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of the partition's texts. Later copies among them come with a random place to go, runs of hot minimisers go by content."""
        held: list[list[np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            cols = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            order, first = _firsts(cols)
            cols = [c[order] for c in cols]
            copy, frequent = ~first, np.isin(cols[0], hot.value)
            by_content = tk.mix(cols[0].view(np.uint64) * tk.U(tk._BASE) + cols[1].view(np.uint64)).view(np.int64)
            cols[0] = np.where(frequent, by_content, cols[0])
            cols[4] = cols[4] | copy * _COPY | frequent * _HOT
            spread = tk.mix(cols[2].view(np.uint64) * tk.U(tk._BASE) + cols[4].view(np.uint64)).view(np.int64)
            cols[0], cols[1] = np.where(copy, spread, cols[0]), np.where(copy, 0, cols[1])
            yield from _chunks(cols, _RUNS)

        for cols in _text_runs(batches):
            held.append(cols)
            if sum(len(x[0]) for x in held) > FLUSH:
                yield from flush()
        yield from flush()

    return run


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that are repeats as a whole (mh null), and runs to compare with others of their minimiser."""
    held = [[c.to_numpy() for c in b.columns] for b in batches]
    if not held:
        return
    cols = [np.concatenate(x) for x in zip(*held)]
    held.clear()
    copied = cols[4] & _COPY != 0
    done = [c[copied] for c in cols]
    cols = [c[~copied] for c in cols]
    order, first = _firsts(cols)
    cols = [c[order] for c in cols]
    later = [np.concatenate([a, c[~first]]) for a, c in zip(done, cols)]
    begin, count = later[4] >> _START, later[4] & 127
    nothing = pa.nulls(len(begin), pa.int64())
    yield from _chunks([later[2], later[3], begin, begin + count + LENGTH - 1, nothing, np.zeros(len(begin), np.int32)], _FOUND)
    mh, doc, sub, at = (cols[k][first] for k in (0, 2, 3, 4))
    if len(mh):
        new = np.concatenate([[True], mh[1:] != mh[:-1]])
        size = np.diff(np.append(np.flatnonzero(new), len(mh)))
        n = np.where(at & _HOT != 0, _ALL_HOT, np.repeat(size, size))
        m = n > 1
        begin, count = at[m] >> _START, at[m] & 127
        yield from _chunks([doc[m], sub[m], begin, begin + count + LENGTH - 1, mh[m], n[m].astype(np.int32)], _FOUND)


def _cut(hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the runs to compare; windows of hot minimisers one by one, later copies within the task without bytes."""
        seen: set[bytes] = set()
        for batch in batches:
            ids, subs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            data, offs = tk.column(batch.column(2))
            rows: list[tuple] = []
            for i, wanted in enumerate(batch.column(3).to_pylist()):
                body = data[offs[i] : offs[i + 1]].tobytes()
                for w in sorted(wanted, key=lambda w: w["begin"]):
                    begin, end = w["begin"], w["end"]
                    if w["n_runs"] <= hot:
                        rows.append((w["mh"], ids[i], subs[i], begin, body[begin:end]))
                        continue
                    for s in range(begin, end - LENGTH + 1):
                        one = body[s : s + LENGTH]
                        key = hashlib.blake2b(one, digest_size=16).digest()
                        if key in seen:  # texts come in order, so this one is later: no bytes needed, any task will do
                            rows.append((hash((ids[i], s)), ids[i], subs[i], s, b""))
                        else:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(key)
                            rows.append((int.from_bytes(key[:8], "little", signed=True), ids[i], subs[i], s, one))
                if len(rows) > 20_000:
                    yield _batch(list(zip(*rows)), _PIECES)
                    rows = []
            if rows:
                yield _batch(list(zip(*rows)), _PIECES)

    return run


def previous_factors(words: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Length of the longest match with a suffix that starts at an earlier place, up to the bytes given.

    ``words`` has the suffixes' bytes as big-endian 64-bit words, one row a suffix, and ``place`` their
    order in the corpus. In suffix order, the nearest suffixes of smaller place on either side are
    found by pointer jumping, which carries the least common prefix on the way."""
    n = len(words)
    order = np.lexsort((place, *words.T[::-1]))
    w, p = words[order], place[order]
    lcp = np.zeros(n + 1, np.int64)
    if n > 1:
        apart = w[1:] ^ w[:-1]
        differs = apart != 0
        k = np.where(differs.any(1), differs.argmax(1), words.shape[1])
        lcp[1:n] = k * 8
        part = np.flatnonzero(k < words.shape[1])
        lcp[1:n][part] += 7 - (np.log2(apart[part, k[part]].astype(np.float64) * (1 - 2**-52)).astype(np.int64) // 8)
    best = np.zeros(n, np.int64)
    for step in (-1, 1):
        # one sentinel of place -1 on either side
        at = np.concatenate([[-1], p, [-1]])
        to = np.clip(np.arange(n + 2) + step, 0, n + 1)
        low = np.concatenate([[0], lcp[:n] if step < 0 else lcp[1:], [0]])
        todo = np.flatnonzero(at[to] > at)
        while len(todo):
            low[todo] = np.minimum(low[todo], low[to[todo]])
            to[todo] = to[to[todo]]
            todo = todo[at[to[todo]] > at[todo]]
        low = np.where(at[to] < 0, 0, low)
        best = np.maximum(best, low[1:-1])
    out = np.empty(n, np.int64)
    out[order] = best
    return out


def _window_words(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the pieces as big-endian words (the last one padded), with piece number and offset."""
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"".join(pieces) + bytes(8), np.uint8)
    counts = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(pieces)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (np.cumsum(sizes) - sizes)[owner] + inside
    eight = np.lib.stride_tricks.sliding_window_view(text, 8)
    cols = []
    for k in range(0, LENGTH, 8):
        word = np.ascontiguousarray(eight[at + k]).view(">u8").ravel().astype(np.uint64)
        if k + 8 > LENGTH:
            word = word & tk.U((1 << 64) - (1 << 8 * (8 - LENGTH % 8)))
        cols.append(word)
    return np.stack(cols, 1), owner, inside


def _factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the windows whose previous factor is as long as a window."""
    held = list(batches)
    if not sum(len(b) for b in held):  # a task may get no rows at all
        return
    table = pa.Table.from_batches(held)
    table = table.combine_chunks().sort_by([(c, "ascending") for c in ("key", "doc", "sub", "begin")])
    key, doc, sub, begin = (table.column(k).to_numpy() for k in range(4))
    pieces = table.column(4).to_pylist()
    known = np.array([not p for p in pieces])
    if known.any():
        yield from _chunks([doc[known], sub[known], begin[known], begin[known] + LENGTH], _SPANS)
        keep = np.flatnonzero(~known)
        key, doc, sub, begin, pieces = key[keep], doc[keep], sub[keep], begin[keep], [pieces[k] for k in keep]
    n, i = len(key), 0
    counts = np.cumsum([len(p) - LENGTH + 1 for p in pieces])
    while i < n:
        j = max(i + 1, int(np.searchsorted(counts, (counts[i - 1] if i else 0) + BLOCK)))
        while j < n and key[j] == key[j - 1]:
            j += 1
        words, owner, inside = _window_words(pieces[i:j])
        d, s, b = doc[i:j][owner], sub[i:j][owner], begin[i:j][owner] + inside
        place = np.empty(len(d), np.int64)
        place[np.lexsort((b, s, d))] = np.arange(len(d))
        hit = previous_factors(words, place) >= LENGTH
        if hit.any():
            o, x = owner[hit], inside[hit]
            new = np.ones(len(o), bool)
            new[1:] = (o[1:] != o[:-1]) | (x[1:] != x[:-1] + 1)
            f = np.flatnonzero(new)
            last = np.append(f[1:], len(o)) - 1
            yield from _chunks([doc[i:j][o[f]], sub[i:j][o[f]], begin[i:j][o[f]] + x[f], begin[i:j][o[f]] + x[last] + LENGTH], _SPANS)
        i = j


def _trimmed(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = tk.column(batch.column(1))
            begins, ends = batch.column(2), batch.column(3)
            rows = []
            for i in range(len(batch)):
                body = data[offs[i] : offs[i + 1]]
                if begins[i].is_valid:
                    mark = np.zeros(len(body) + 1, np.int32)
                    np.add.at(mark, begins[i].values.to_numpy(), 1)
                    np.add.at(mark, ends[i].values.to_numpy(), -1)
                    gone = np.cumsum(mark[:-1]) > 0
                    kept = body[~gone].tobytes()
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    rows.append((len(body), int(gone.sum()), spans, kept))
                else:
                    rows.append((len(body), 0, 0, body.tobytes()))
            size, removed, spans, kept = zip(*rows) if rows else ((),) * 4
            yield pa.record_batch(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept if with_text else [None] * len(kept), pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, with_text: bool = True, hot: int = HOT, sample_bytes: int = SAMPLE_BYTES, sample_runs: int = SAMPLE_RUNS) -> DataFrame:
    """Per document: size, removed bytes, maximal removed runs, digest of what stays and (``with_text``) what stays."""
    least = F.lit(-(1 << 63)).cast("long")
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).withColumn("doc", F.coalesce("doc_id", least))
    most, total = base.groupBy("doc").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    again = most > 1
    spark = docs.sparkSession
    n_tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TASK_BYTES)

    def dealt(df: DataFrame, key: str) -> DataFrame:
        """Tasks in proportion to the corpus; up to the session's number, small ones are still put together."""
        return df.repartition(n_tasks, key) if total // TASK_BYTES >= n_tasks else df.repartition(key)

    base = base.withColumn("sub", F.xxhash64("text") if again else F.lit(0).cast("long"))
    once = base.select("doc", "sub", "text")
    once = once.dropDuplicates(["doc", "sub"]) if again else once
    frequent = spark.sparkContext.broadcast(hot_minimisers(once, total, sample_bytes, sample_runs))
    found = written(dealt(once.mapInArrow(_map_runs(frequent), _RUNS), "mh").mapInArrow(_resolve, _FOUND))
    asked = found.where("mh is not null").groupBy("doc", "sub").agg(F.collect_list(F.struct("begin", "end", "mh", "n_runs")).alias("wanted"))
    pieces = once.join(asked, ["doc", "sub"]).select("doc", "sub", "text", "wanted").sortWithinPartitions("doc", "sub").mapInArrow(_cut(hot), _PIECES)
    spans = dealt(pieces, "key").mapInArrow(_factor, _SPANS).union(found.where("mh is null").select("doc", "sub", "begin", "end"))
    gathered = spans.groupBy("doc", "sub").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    whole = base.join(gathered, ["doc", "sub"], "left").select("doc_id", "text", "spans.begin", "spans.end")
    out = whole.mapInArrow(_trimmed(with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")
