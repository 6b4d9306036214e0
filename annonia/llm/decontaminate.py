"""Benchmark decontamination by SimHash over windows of the items' sizes.

For each benchmark item, windows of as many words slide over the documents. A window can only
reach the similarity asked for if it shares a five-word shingle with the item, so windows are
taken where such a shingle stands, at every shift that would put it in its place. Each
window's SimHash of ``BITS`` bits is looked up in an index of the fingerprints of the items of its size, split into
``BLOCKS`` blocks: within ``RADIUS`` some block differs in at most RADIUS // BLOCKS bits, so all values of a block
that are so near to the window's give every fingerprint within the radius. Candidates are
then compared exactly: weighted Jaccard similarity of the shingles, each counted as often as
it occurs. A window equal to the item is at distance 0.

Up to ``ITEMS`` items are broadcast, and the documents are read once and not shuffled. Beyond, the documents are read
twice, whatever the number of items: an item of n shingles is looked for by its rarest alone, as many as a window of similarity
0.75 can't all lack (n less 0.75 n, rounded up, and one more, repeats counted). Shingles that many items share are so
left out where an item has rarer ones. Those that pass a sieve of bounded size meet the items' in a join, and each document
then meets its candidates, some ``TOGETHER`` at a time.

Input: ``doc_id``, ``text``; benchmark ``item_id``, ``text``. Words are lower-cased (A-Z). Null and
empty texts match nothing; items without words, id or text match nothing; a null doc_id is found like others; an item of fewer than five words
is one shingle; repeated rows give repeated results; an empty table gives no rows; other columns
are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .store import written

WORDS, PERCENT, ITEMS = 5, 75, 5000
#: Candidate items of one document that a task compares at a time, about.
TOGETHER = 256
#: Similarity 0.75 makes a bit differ with a chance of about 0.172: 22 bits of 128, deviation 4.3; the radius is four deviations more.
BITS, RADIUS, BLOCKS = 128, 39, 8
#: log2 of the cells of the sieve: at least, at most.
SIEVE = (22, 28)
_MATCHES = "doc_id long, item_id long, start long, n_words long, distance int, similarity double"
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def simhash(s: np.ndarray) -> np.ndarray:
    """The sign of each bit's vote over the shingle hashes, as ``BLOCKS`` numbers."""
    votes = np.concatenate([(tk.mix(s + tk.U(k))[:, None] & _BITS != 0).sum(0) for k in range(BITS // 64)])
    return np.packbits(2 * votes > len(s), bitorder="little").view(np.uint16)



class Index:
    """Shingles of some items, and for each size of item the fingerprints in blocks."""

    def __init__(self, items: list[tuple[int, int, np.ndarray]]):
        self.items = items
        pairs = sorted((int(h), i, k) for i, (_, _, s) in enumerate(items) for k, h in enumerate(s))
        self.hashes = np.array([p[0] for p in pairs], np.uint64)
        self.places = [(p[1], p[2]) for p in pairs]
        self.prints = np.stack([simhash(s) for _, _, s in items]) if items else np.zeros((0, BLOCKS), np.uint16)
        sizes = np.array([n for _, n, _ in items], np.int64)
        self.blocks: dict[int, tuple] = {}
        for n in set(sizes.tolist()):
            own = np.flatnonzero(sizes == n)
            orders = [np.argsort(self.prints[own, b], kind="stable") for b in range(BLOCKS)]
            self.blocks[n] = (own, [(o, *np.unique(self.prints[own, b], return_counts=True)) for b, o in enumerate(orders)])
        self.looked_up = self.lookups = 0

    def near(self, n: int, fingerprint: np.ndarray) -> Iterator[tuple[int, int]]:
        """All items of ``n`` words within the radius, with their distances."""
        if n not in self.blocks:
            return
        own, blocks = self.blocks[n]
        hit = np.zeros(len(own), bool)
        for b, (order, values, times) in enumerate(blocks):
            # of the block's different values, at most 65,536 for any number of items, those near the window's
            near = np.bitwise_count(values ^ fingerprint[b]) <= RADIUS // BLOCKS
            hit[order[np.repeat(near, times)]] = True
        found = own[hit]
        self.lookups, self.looked_up = self.lookups + 1, self.looked_up + len(found)
        distance = np.bitwise_count(self.prints[found] ^ fingerprint).sum(1, dtype=np.int64)
        for i, d in zip(found[distance <= RADIUS].tolist(), distance[distance <= RADIUS].tolist()):
            yield i, d

    def matches(self, h: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(item, first word, words, distance, similarity): the best window of each item in a text with word hashes ``h``."""
        by_size: dict[int, np.ndarray] = {WORDS: tk.shingles(h, WORDS) if len(h) >= WORDS else h[:0]}
        starts: set[tuple[int, int]] = set()
        for size in {min(n, WORDS) for _, n, _ in self.items}:
            if size not in by_size:
                by_size[size] = tk.shingles(h, size) if len(h) >= size else h[:0]
            s = by_size[size]
            first = np.searchsorted(self.hashes, s)
            for at in np.flatnonzero(self.hashes[np.minimum(first, len(self.hashes) - 1)] == s):
                k = int(first[at])
                while k < len(self.hashes) and self.hashes[k] == s[at]:
                    item, place = self.places[k]
                    n = self.items[item][1]
                    if min(n, WORDS) == size:
                        # a text shorter than the item is one window; else the window that puts the shingle in place
                        starts.add((n, min(max(int(at) - place, 0), max(len(h) - n, 0))))
                    k += 1
        best: dict[int, tuple] = {}
        for n, start in sorted(starts):
            size, taken = min(n, WORDS), min(n, len(h))
            window = by_size[size][start : start + taken - size + 1]
            for item, d in self.near(n, simhash(window)):
                own = self.items[item][2]
                if min(len(window), len(own)) * 100 < PERCENT * max(len(window), len(own)):
                    continue
                sim = weighted_jaccard(window, own)
                if sim * 100 >= PERCENT and (item not in best or sim > best[item][3]):
                    best[item] = (start, taken, d, sim)
        for item in sorted(best):
            yield self.items[item][0], *best[item]


def weighted_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    (a, m), (b, n) = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = int(np.minimum(m[i], n[j]).sum())
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 0.0


def _item(item_id: int, text: str | None) -> tuple[int, int, np.ndarray]:
    h = tk.word_hashes(*tk.column(pa.array([text or ""])))[0]
    return item_id, len(h), tk.shingles(h, WORDS)


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> tk.U(64 - bits)).astype(np.int64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _MATCHES.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.float64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def leaks(docs: DataFrame, benchmark: DataFrame, items: int = ITEMS) -> DataFrame:
    """doc_id, item_id and the best window's first word, words, distance and similarity, for each leaked item of each document."""
    spark = docs.sparkSession
    wanted = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    n, size = wanted.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    if n > items or size > items << 12:
        return _leaks_by_join(texts, wanted)
    found = [x for r in sorted((r.item_id, r.text) for r in wanted.collect()) if (x := _item(*r))[1]]
    return texts.mapInArrow(_searcher(spark.sparkContext.broadcast(found)), _MATCHES)


def _searcher(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, bits = Index(sent.value), SIEVE[0]
        sieve = np.zeros(1 << bits, bool)  # what passes is looked up exactly
        sieve[_cells(index.hashes, bits)] = True
        sizes = {min(n, WORDS) for _, n, _ in index.items}
        for batch in batches:
            ids, rows = batch.column(0), []
            data, offs = tk.column(batch.column(1))
            for i, j in tk.slices(offs):
                h, _, _, first = tk.word_hashes(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                hit: set[int] = set()
                for size in sizes if len(h) else ():
                    at = np.flatnonzero(sieve[_cells(_over_texts(h, size), bits)])
                    hit.update((np.searchsorted(first, at, side="right") - 1).tolist())
                for k in sorted(hit):
                    rows += [(ids[i + k].as_py(), *m) for m in index.matches(h[first[k] : first[k + 1]])]
            if rows:
                yield _rows(rows)

    return run


def _over_texts(h: np.ndarray, size: int) -> np.ndarray:
    """Shingles of words that follow each other in a run of texts; one that spans two texts does no harm to a sieve."""
    return tk.shingles(h, size) if len(h) >= size else h[:0]


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            _, n, s = _item(item_id, text)
            s, times = np.unique(s, return_counts=True)
            key = int(s.sum(dtype=np.uint64)) >> 1  # tells texts of one id apart
            same = [np.full(len(s), x, np.int64) for x in (item_id, key)]
            yield pa.record_batch([*map(pa.array, (*same, s.view(np.int64), times, np.full(len(s), min(n, WORDS), np.int32)))], names=["item_id", "of", "h", "times", "size"])


def _rarest(shingles: DataFrame) -> DataFrame:
    """Of each item the shingles that fewest items hold, one of which every window of the similarity has."""
    spread = shingles.groupBy("h").agg(F.count("*").alias("n_items"))
    ranked = shingles.join(spread, "h")
    own = Window.partitionBy("item_id", "of")
    before = F.coalesce(F.sum("times").over(own.orderBy("n_items", "h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("times").over(own)
    may_lack = total - F.ceil(total * PERCENT / 100)
    return ranked.withColumn("needed", before <= may_lack).where("needed").select("item_id", "h", "size")


def _leaks_by_join(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """For a benchmark of any size. Documents are told apart by id and a hash of the text."""
    spark = texts.sparkSession
    shingles = written(_rarest(wanted.mapInArrow(_item_shingles, "item_id long, of long, h long, times long, size int")))
    n, sizes = shingles.agg(F.count("*"), F.collect_set("size")).first()
    bits = min(SIEVE[1], max(SIEVE[0], int(8 * n).bit_length()))
    width = min(bits, 20)  # the sieve comes in chunks of so many cells, put together by Spark

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_cells(batch.column(0).to_numpy().view(np.uint64), bits))
            part = at >> width
            for x in np.unique(part):
                cells = np.zeros(1 << width, bool)
                cells[at[part == x] & ((1 << width) - 1)] = True
                yield pa.record_batch([pa.array([x], pa.int64()), pa.array([np.packbits(cells).tobytes()], pa.binary())], names=["part", "cells"])

    def put_together(table: pa.Table) -> pa.Table:
        cells = np.bitwise_or.reduce([np.frombuffer(c, np.uint8) for c in table.column("cells").to_pylist()])
        return pa.table({"part": table.column("part").slice(0, 1), "cells": pa.array([cells.tobytes()], pa.binary())})

    sieve = np.zeros((1 << (bits - width), 1 << width >> 3), np.uint8)  # at most 32 MB
    for r in shingles.select("h").mapInArrow(chunks, "part long, cells binary").groupBy("part").applyInArrow(put_together, "part long, cells binary").collect():
        sieve[r.part] = np.frombuffer(r.cells, np.uint8)
    sent = spark.sparkContext.broadcast(sieve.ravel())
    keyed = texts.withColumn("own", F.xxhash64("text")).withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owns = (batch.column(k).to_numpy() for k in (0, 1))
            data, offs = tk.column(batch.column(2))
            for i, j in tk.slices(offs):
                h, _, _, first = tk.word_hashes(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                for size in sizes if len(h) else ():
                    s = _over_texts(h, size)
                    cell = _cells(s, bits)
                    at = np.flatnonzero(sent.value[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1)
                    d = np.searchsorted(first, at, side="right") - 1
                    yield pa.record_batch([pa.array(keys[i:j][d]), pa.array(owns[i:j][d]), pa.array(s[at].view(np.int64))], names=["key", "own", "h"])

    rows = keyed.select("key", "own", "text").mapInArrow(passing, "key long, own long, h long")
    pairs = written(rows.distinct().join(shingles.select("h", "item_id"), "h").select("key", "own", "item_id").distinct())
    parts = pairs.groupBy("key", "own").agg(F.ceil(F.count("*") / TOGETHER).alias("parts"))
    sliced = pairs.join(parts, ["key", "own"]).select("key", "own", "item_id", F.pmod(F.xxhash64("item_id"), F.col("parts")).alias("slice"))
    with_items = sliced.join(wanted, "item_id").groupBy("key", "own", "slice").agg(F.collect_list(F.struct("item_id", "text")).alias("items"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, items in zip(*(batch.column(k).to_pylist() for k in range(3))):
                index = Index([x for i in sorted((i["item_id"], i["text"]) for i in items) if (x := _item(*i))[1]])
                out += [(doc_id, *m) for m in index.matches(tk.word_hashes(*tk.column(pa.array([text])))[0])]
            if out:
                yield _rows(out)

    return keyed.join(with_items, ["key", "own"]).select("doc_id", "text", "items").mapInArrow(verify, _MATCHES)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a leaked item. Rows of one id go together; rows without an id go by their text."""
    bad = leaks(docs, benchmark).where("doc_id is not null").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(bad, "doc_id", "left_anti").select(docs.columns)
    nameless, text = docs.where("doc_id is null"), F.xxhash64("text")
    leaking = leaks(nameless.select(text.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("_leaking")).distinct()
    return named.unionByName(nameless.join(leaking, text == F.col("_leaking"), "left_anti").select(docs.columns))
