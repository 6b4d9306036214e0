"""Near-duplicate documents by one-permutation MinHash.

Each distinct five-word shingle is hashed once; the top seven bits choose one of 128 bins,
the smallest hash of a bin stands for it. Empty bins are filled by optimal densification: each
probes bins in an order of its own, the same for all documents, until one is full. 32 bands
of 4 bins put a pair of similarity 0.75 into a common bucket but for about 5 in a million.

In a bucket, candidates are edges from a centre to the members: a star, so their number is
that of the rows. Documents with the same set were joined before and enter once. Stars alone
would lose links between two members that are both far from the centre, so buckets that still
hold several components are looked at again. Documents whose shingles occur too seldom
outside their own component to allow any link are left out first, by an exact bound. The rest
of a bucket is cut into blocks, and pairs of blocks are compared by bitmaps of the sets, which
bound the similarity from above. Of two components that might be linked first only the pair most alike comes
out; where that is a link they are one component from then on, and of the others all pairs that might be links
come out. No bucket is capped. Links are confirmed on the full sets.

Input: ``doc_id``, ``text``. Null and empty texts have an empty set, linked with nothing. Rows
that share a ``doc_id`` are one node (linked if any of its texts are); each row has its own
result row. A null ``doc_id`` is linked with nothing: component null, kept. An empty table gives
no rows; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .components import components
from .store import written

BINS, BANDS, ROWS, WORDS, PERCENT = 128, 32, 4, 5, 75
#: Cells of the bitmaps that bound a pair's similarity from above before its sets are compared.
CELLS = 2048
#: Documents of a bucket in one block.
BLOCK = 192
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def densified(sig: np.ndarray) -> np.ndarray:
    """Fill empty bins (rows with all bins empty stay so)."""
    full = sig != _NONE
    out = sig.copy()
    row, col = np.nonzero(~full & full.any(1)[:, None])
    t = 0
    while len(row):
        t += 1
        probe = (tk.mix(col.astype(np.uint64) * tk.U(1 << 20) + tk.U(t)) >> tk.U(57)).astype(np.int64)
        hit = full[row, probe]
        out[row[hit], col[hit]] = sig[row[hit], probe[hit]]
        row, col = row[~hit], col[~hit]
    return out


def sets(col: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offs = tk.column(col)
    for i, j in tk.slices(offs):
        h, _, _, first = tk.word_hashes(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        for k in range(j - i):
            yield np.unique(tk.shingles(h[first[k] : first[k + 1]], WORDS))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = len(batch)
        sizes, a, b = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        sig = np.full((n, BINS), _NONE)
        for i, s in enumerate(sets(batch.column(1))):
            if len(s):
                sizes[i] = len(s)
                a[i], b[i] = np.add.reduce(tk.mix(s)), np.bitwise_xor.reduce(tk.mix(s + tk.U(7)))
                bins = (s >> tk.U(57)).astype(np.int64)
                new = np.concatenate([[0], np.flatnonzero(bins[1:] != bins[:-1]) + 1])
                sig[i, bins[new]] = s[new]  # sorted: the first of a bin is its least
        parts = tk.mix(densified(sig)).reshape(n, BANDS, ROWS)
        key = np.arange(1, BANDS + 1, dtype=np.uint64)[None] * tk.U(0x9E3779B97F4A7C15)
        for r in range(ROWS):
            key = tk.mix(key + parts[:, :, r])
        flat = pa.array(key.view(np.int64).ravel())
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS), pa.int32()), flat)
        yield pa.record_batch([batch.column(0), pa.array(sizes), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), bands], names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])


def similar(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: tuple = (None, None)
    for batch in batches:
        us, vs, centre = batch.column(0), batch.column(1), batch.column(2)
        ok = []
        for i, member in enumerate(sets(batch.column(3))):
            text = centre[i].as_py()
            if text != known[0]:
                known = (text, next(sets(pa.array([text], pa.string()))))
            ok.append(similar(known[1], member))
        keep = pa.array(ok, pa.bool_())
        yield pa.record_batch([us.filter(keep), vs.filter(keep)], names=["u", "v"])


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (u: centre, v: member) that are links. A hot centre's rows may be split, as it is joined last."""
    member = pairs.join(texts.toDF("v", "text_v"), "v")
    both = member.join(texts.toDF("u", "text_u"), "u")
    return both.select("u", "v", "text_u", "text_v").mapInArrow(_confirm, "u long, v long")


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for k in range(0, len(batch), 500):
            own = list(sets(batch.column(2).slice(k, 500)))
            n = np.array([len(s) for s in own], np.int64)
            h = np.concatenate(own) if own else np.zeros(0, np.uint64)
            yield pa.record_batch([np.repeat(ids[k : k + 500], n), np.repeat(labels[k : k + 500], n), np.repeat(n, n), h.view(np.int64)], names=["doc_id", "label", "size", "h"])


def _linkable(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows (bucket, doc_id, label) without the documents that can have no link outside their component.

    Such a link needs common shingles, and these must occur in several components. ``shared`` counts a
    document's shingles that do; with ``size`` it bounds every similarity from above, so nothing that
    could be linked is dropped. Near copies too far from their group have mostly shingles of their own."""
    documents = rows.select("doc_id", "label").distinct()
    shingles = documents.join(texts, "doc_id").select("doc_id", "label", "text").mapInArrow(_shingle_rows, "doc_id long, label long, size long, h long")
    common = shingles.groupBy("h").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("h")
    counts = shingles.join(common, "h", "left_semi").groupBy("doc_id").agg(F.count("*").alias("shared"), F.min("size").alias("size"))
    joined = rows.drop("label").join(written(counts), "doc_id")
    least = joined.groupBy("bucket").agg(F.min("size").alias("least"))
    able = 100 * F.col("shared") >= PERCENT * (F.col("size") + F.col("least") - F.col("shared"))
    return joined.join(least, "bucket").where(able).select("bucket", "doc_id", "shared", "size")


_PACKED = "doc_id long, shingles binary, n long, bits binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set as bytes, and as a bitmap of hashed cells."""
    for batch in batches:
        own = list(sets(batch.column(1)))
        cells = np.zeros((len(own), CELLS), np.uint8)
        for i, s in enumerate(own):
            cells[i, (s & np.uint64(CELLS - 1)).astype(np.int64)] = 1
        bits = [row.tobytes() for row in np.packbits(cells, axis=1)]
        yield pa.record_batch([batch.column(0), pa.array([s.tobytes() for s in own], pa.binary()), pa.array([len(s) for s in own], pa.int64()), pa.array(bits, pa.binary())], names=["doc_id", "shingles", "n", "bits"])


def _compared(one: bool):
    """Pairs of two blocks that lie in different components and that the bitmaps don't rule out; ``one``: for two components only the pair most alike.

    Each cell set in one bitmap only costs its document a shingle that the other lacks."""

    def unpacked(members: list[dict]):
        bits = np.frombuffer(b"".join(m["bits"] for m in members), np.uint64).reshape(len(members), -1)
        return *(np.array([m[k] for m in members], np.int64) for k in ("doc_id", "label", "n")), bits, np.bitwise_count(bits).sum(1, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                (doc_a, label_a, n_a, bits_a, cells_a), (doc_b, label_b, n_b, bits_b, cells_b) = unpacked(x.as_py()), unpacked(y.as_py())
                both = np.zeros((len(doc_a), len(doc_b)), np.int64)
                for w in range(bits_a.shape[1]):
                    both += np.bitwise_count(bits_a[:, w, None] & bits_b[None, :, w])
                both += np.minimum((n_a - cells_a)[:, None], (n_b - cells_b)[None, :])
                either = n_a[:, None] + n_b[None, :] - both
                i, j = np.nonzero((label_a[:, None] != label_b[None, :]) & (100 * both >= PERCENT * either))
                low, high = np.minimum(label_a[i], label_b[j]), np.maximum(label_a[i], label_b[j])
                alike = both[i, j] / np.maximum(either[i, j], 1)
                if one and len(i):
                    order = np.lexsort((-alike, high, low))
                    new = np.concatenate([[True], (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])])
                    i, j, low, high, alike = (c[order[new]] for c in (i, j, low, high, alike))
                if len(i):
                    u, v = np.minimum(doc_a[i], doc_b[j]), np.maximum(doc_a[i], doc_b[j])
                    yield pa.record_batch([pa.array(c) for c in (u, v, low, high, alike)], names=["u", "v", "low", "high", "alike"])

    return run


def _block_pairs(rest: DataFrame, packed: DataFrame, one: bool) -> DataFrame:
    """Pairs (u, v, low, high, alike) that may be links between components of a bucket; low and high are the components.

    Blocks have about BLOCK documents of a bucket, so that a bucket of any size is compared by many tasks."""
    parts = rest.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("parts")).alias("block")
    placed = rest.join(parts, "bucket").join(packed.drop("shingles"), "doc_id").select("bucket", block, F.struct("doc_id", "label", "n", "bits").alias("member"))
    blocks = written(placed.groupBy("bucket", "block").agg(F.collect_list("member").alias("members")))
    other = blocks.select("bucket", F.col("block").alias("block_v"), F.col("members").alias("members_v"))
    both = blocks.join(other, "bucket").where("block <= block_v").select("members", "members_v")
    return both.mapInArrow(_compared(one), "u long, v long, low long, high long, alike double")


def _confirmed_packed(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    shingles = packed.select("doc_id", "shingles")
    both = pairs.join(shingles.toDF("v", "shingles_v"), "v").join(shingles.toDF("u", "shingles_u"), "u")
    return written(both.select("u", "v", "shingles_u", "shingles_v").mapInArrow(_confirm_packed, "u long, v long"))


def _confirm_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            at = np.searchsorted(a, b)
            both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
            ok.append(100 * both >= PERCENT * (len(a) + len(b) - both))
        keep = pa.array(ok, pa.bool_())
        yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, n_links (confirmed candidate links of the node; copies of one set are joined by a star)."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    sketch = written(texts.mapInArrow(_sketches, SKETCH))
    whole = sketch.where("n_shingles > 0 and doc_id is not null")
    keys = ["set_a", "set_b", "n_shingles"]
    first = whole.groupBy(*keys).agg(F.min("doc_id").alias("rep"))
    equal = written(whole.select("doc_id", *keys).join(first, keys).where("doc_id <> rep").select(F.col("rep").alias("u"), F.col("doc_id").alias("v")).distinct())
    unique = whole.join(first.select(*keys, F.col("rep").alias("doc_id")), [*keys, "doc_id"], "left_semi")
    rows = unique.select("doc_id", F.explode("bands").alias("bucket")).distinct()
    shared = rows.groupBy("bucket").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last")).where("centre < last")
    members = written(rows.join(shared, "bucket").select("bucket", "doc_id", "centre"))
    needed = written(texts.join(members.select("doc_id").distinct(), "doc_id", "left_semi"))

    # first round: every document against the smallest centre of its buckets
    tested = written(members.where("doc_id <> centre").groupBy(F.col("doc_id").alias("v")).agg(F.min("centre").alias("u")).select("u", "v"))
    links = written(_confirmed(tested, needed))
    labels = components(links.union(equal))

    def undecided(known: DataFrame) -> DataFrame:
        """The rows (bucket, doc_id, label) of buckets that still hold several components."""
        several = known.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("bucket")
        return known.join(several, "bucket")

    def labelled(rows: DataFrame) -> DataFrame:
        known = rows.select("bucket", "doc_id").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        return known.select("bucket", "doc_id", F.coalesce("label", "doc_id").alias("label"))

    rest = written(undecided(labelled(_linkable(written(undecided(labelled(members))), needed))))
    packed = written(needed.join(rest.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_packed, _PACKED))
    # of two components first the pair most alike; what it links is one component when all other pairs are taken
    best = _block_pairs(rest, packed, True).groupBy("low", "high").agg(F.max_by(F.struct("u", "v"), F.struct("alike", "u", "v")).alias("pair")).select("low", "high", "pair.u", "pair.v")
    best = written(best.join(tested, ["u", "v"], "left_anti"))
    found = _confirmed_packed(best.select("u", "v"), packed)
    # chains of linked components are closed, or all pairs between them would be candidates below
    joined = components(best.join(found, ["u", "v"], "left_semi").select(F.col("low").alias("u"), F.col("high").alias("v"))).toDF("label", "to")
    rest = written(undecided(rest.join(joined, "label", "left").select("bucket", "doc_id", F.coalesce("to", "label").alias("label"))))
    others = written(_block_pairs(rest, packed, False).select("u", "v").distinct().join(tested.union(best.select("u", "v")), ["u", "v"], "left_anti"))
    found = found.union(_confirmed_packed(others, packed))
    links = links.union(found)
    labels = components(links.union(equal))
    degree = links.select(F.explode(F.array("u", "v")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("n_links"))
    judged = sketch.select("doc_id", "n_shingles").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").join(degree, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id"))
    return judged.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group left: that of the smallest doc_id.

    Of several rows with this id one stays, that of the least digest, whatever the order of the rows. Rows without an id all stay."""
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    own = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    row = [F.col(f"`{c}`") for c in docs.columns]
    digest = F.xxhash64(*(c for c, (_, kind) in zip(row, docs.dtypes) if "map<" not in kind and "variant" not in kind))  # these have no hash
    least = own.groupBy("doc_id").agg(F.min_by(F.struct(*row), F.struct(F.xxhash64("text"), digest)).alias("_row"))
    return least.select("_row.*").unionByName(docs.where("doc_id is null"))
