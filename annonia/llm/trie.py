"""The prefix trie of conversations, with counts for each node.

A node is a distinct sequence of first turns; its members are the conversations that start with it. Each turn
becomes an id, the digest of its role and text; a conversation becomes the row of its ids. Rows are dealt
over ranges of their first ids, so that prefixes stay together and a group of copies of any size is
still split by conversation. In a range the ids stand in padded matrices, some columns at a time with
the rows that are long enough: they are sorted by numpy's lexsort, the changes from row to row are
OR-accumulated over the columns, and the places where the accumulated mask is set are the starts of nodes,
at every depth; ``reduceat`` gives the nodes' counts.

A node that may go on in another range contains its range's first or last row. Such boundary nodes, two
paths a range, are recombined by the digest of their ids: counts add up, children in several ranges
count once, and sums over subtrees are taken by doubling distances in the tree of boundary nodes.

Input: ``conv_id``, ``turn``, ``role``, ``text``, one row a turn. Turns are taken by ``turn`` (null
first), those of one number by the digest of role and text; null roles and texts count as empty; repeated
rows are turns of their own; rows without a conv_id belong to no conversation and are left out; an empty table
gives no rows; other columns are ignored. A task holds one range, about ``RANGE_TURNS`` ids or one longer
conversation; the ids of a node's members are digested as a stream."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit
from .store import written

#: Turns aimed at in a range, first turns by which ranges are cut, and columns of a padded matrix.
RANGE_TURNS, KEY_TURNS, COLUMNS = 1 << 20, 64, 64
DIGEST = 16
_PARTS = (
    "shared boolean, key string, parent_key string, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string, ends string, first_end long"
)
_KINDS = pa.schema([(n, {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string()}[k]) for n, k in map(str.split, _PARTS.split(", "))])
_NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_arrays(rows: DataFrame) -> DataFrame:
    """conv_id, turns: each conversation's turns in order as (id, words), without texts."""
    role, text = (F.coalesce(rows[c].cast("string"), F.lit("")) for c in ("role", "text"))
    ident = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    turn = rows["turn"].cast("long")
    each = F.struct(turn.isNotNull().alias("known"), turn.alias("turn"), ident.alias("id"), words.cast("int").alias("words")).alias("t")
    plain = rows.select(rows["conv_id"].cast("long").alias("conv_id"), each).where("conv_id is not null")
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words")))
    return plain.groupBy("conv_id").agg(ordered.alias("turns"))


def rebuilt(convs: DataFrame, group: int = 20, most: int = 3) -> DataFrame:
    """Conversations whose first turns, none to ``most`` by a checksum of the id, come from the conversation of their id less its rest by ``group`` (absent: none)."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = convs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    joined = convs.withColumns({"_h": h, "_to": F.col("conv_id") - F.col("conv_id") % group}).join(heads, F.col("_to") == F.col("_base"), "left")
    none = F.array().cast(convs.schema["turns"].dataType)
    head = F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h"))
    own = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def _ranks(digests: np.ndarray) -> np.ndarray:
    """Dense numbers of 16-byte digests, in the order of their bytes."""
    halves = digests.view(">u8").reshape(-1, 2)
    high, low = halves[:, 0].astype(np.uint64), halves[:, 1].astype(np.uint64)
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.ones(len(order), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


class Range:
    """Nodes of one range of rows, depth by depth. Rows come in the order of their first ``KEY_TURNS`` ids, then of ``conv``."""

    def __init__(self, conv: np.ndarray, size: np.ndarray, digests: np.ndarray, words: np.ndarray):
        self.conv, self.size, self.digests, self.words = conv, size, digests, words
        self.at = np.concatenate([[0], np.cumsum(size)])
        self.ids = _ranks(digests) if len(words) else np.zeros(0, np.int64)
        self.levels: list[dict] = []
        self._find()
        self._sum()

    def _level(self, rows: np.ndarray, starts: np.ndarray, parent: np.ndarray) -> None:
        """The nodes of the next depth: their rows in trie order, where each starts, and its parent's place in the level above."""
        depth = len(self.levels)
        conv, first = self.conv[rows], rows[starts]
        words = self.words[self.at[first] + depth - 1] if depth else np.zeros(1, np.int64)
        if depth <= KEY_TURNS:  # a prefix that stands in several ranges holds the first or the last row of each
            shared = np.logical_or.reduceat((rows == 0) | (rows == len(self.conv) - 1), starts)
        else:
            shared = self.levels[-1]["shared"][parent]
        ends = np.add.reduceat((self.size[rows] == depth).astype(np.int64), starts)
        n = np.diff(np.append(starts, len(rows)))
        lowest = np.minimum.reduceat(conv, starts)
        self.levels.append({"first": first, "parent": parent, "shared": shared, "n": n, "conv": lowest, "words": words, "ends": ends, "members": conv, "starts": starts})

    def _find(self) -> None:
        rows = np.lexsort((self.conv, self.size > 0))
        self._level(rows, np.array([0]), np.array([-1]))
        rows = rows[self.size[rows] > 0]
        node, depth = np.zeros(len(rows), np.int64), 0  # the place in the last level of each row that goes on
        while len(rows):
            width = int(min(COLUMNS, self.size[rows].max() - depth))
            column = np.arange(depth, depth + width)
            inside = column[None, :] < self.size[rows][:, None]
            padded = np.full((len(rows), width), -1, np.int64)
            padded[inside] = self.ids[(self.at[rows][:, None] + column[None, :])[inside]]
            # shorter rows before longer ones, and rows that end together by conversation
            order = np.lexsort((self.conv[rows], self.size[rows] > depth + width, *padded.T[::-1], node))
            rows, node, padded = rows[order], node[order], padded[order]
            change = np.ones((len(rows), width), bool)
            change[1:] = padded[1:] != padded[:-1]
            change[1:, 0] |= node[1:] != node[:-1]
            np.logical_or.accumulate(change, axis=1, out=change)
            for j in range(width):
                member = padded[:, j] >= 0
                start = change[:, j] & member
                self._level(rows[member], np.cumsum(member)[start] - 1, node[start])
                node = np.cumsum(start) - 1
            depth += width
            go_on = self.size[rows] > depth
            rows, node = rows[go_on], node[go_on]

    def _sum(self) -> None:
        """Children, leaves and savings, from the deepest level up; nodes that other ranges may share give nothing to their parents here."""
        for v in self.levels:
            v |= {"children": np.zeros(len(v["n"]), np.int64), "leaves": np.zeros(len(v["n"]), np.int64), "saved": np.zeros(len(v["n"]), np.int64)}
        for above, v in zip(self.levels[-2::-1], self.levels[:0:-1]):
            own = ~v["shared"]
            v["leaves"] += own & (v["children"] == 0)
            v["saved"] += np.where(own, (v["n"] - 1) * v["words"], 0)
            parent = v["parent"][own]
            np.add.at(above["children"], parent, 1)
            np.add.at(above["leaves"], parent, v["leaves"][own])
            np.add.at(above["saved"], parent, v["saved"][own])

    def nodes(self) -> Iterator[dict]:
        """Rows of ``_PARTS``, level by level."""
        paths: dict[int, object] = {}
        for depth, v in enumerate(self.levels):
            above = self.levels[depth - 1] if depth else None
            here: dict[int, object] = {}
            for k in range(len(v["n"])):
                parent = int(v["parent"][k])
                shared, a, e = bool(v["shared"][k]), int(v["starts"][k]), int(v["ends"][k])
                ends = ",".join(map(str, v["members"][a : a + e].tolist())) if e else ""
                if shared:
                    here[k] = paths[parent].copy() if depth else hashlib.md5()
                    if depth:
                        last = int(self.at[v["first"][k]]) + depth - 1
                        here[k].update(self.digests[DIGEST * last : DIGEST * (last + 1)].tobytes())
                known = paths.get(parent) if depth else None
                yield {
                    "shared": shared,
                    "key": here[k].hexdigest() if shared else None,
                    "parent_key": known.hexdigest() if known is not None else None,
                    "depth": depth,
                    "conv_id": int(v["conv"][k]),
                    "parent_conv_id": int(above["conv"][parent]) if depth and known is None else None,
                    "n_convs": int(v["n"][k]),
                    "n_children": int(v["children"][k]),
                    "n_leaves": int(v["leaves"][k]),
                    "saved_tokens": int(v["saved"][k]),
                    "words": int(v["words"][k]),
                    "ends_sha256": None if shared else hashlib.sha256(ends.encode()).hexdigest(),
                    "ends": ends if shared and e else None,
                    "first_end": int(v["members"][a]) if shared and e else None,
                }
            paths = here


def _range_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, size, digests, words = [], [], [], []
    for batch in batches:
        conv.append(batch.column(0).to_numpy(zero_copy_only=False))
        size.append(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
        digests.append(textkit.column(batch.column(1).flatten())[0].copy())
        words.append(batch.column(2).flatten().to_numpy(zero_copy_only=False))
    if not conv or not sum(map(len, conv)):
        return
    found = Range(*(np.concatenate(x).astype(t) for x, t in ((conv, np.int64), (size, np.int64), (digests, np.uint8), (words, np.int64))))
    done = []
    for row in found.nodes():
        done.append(row)
        if len(done) >= 20_000:
            yield pa.RecordBatch.from_pylist(done, schema=_KINDS)
            done = []
    yield pa.RecordBatch.from_pylist(done, schema=_KINDS)


def _digests(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256) of comma-joined pieces in order; each key's pieces are read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for key, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(piece.encode())
                else:
                    digest.update(f",{piece}".encode())
            yield pa.record_batch([pa.array([d[k] for d in done], pa.string()) for k in (0, 1)], names=["key", "ends_sha256"])
        if now is not None:
            yield pa.record_batch([pa.array([x], pa.string()) for x in (now, digest.hexdigest())], names=["key", "ends_sha256"])

    return pieces.repartition("key").sortWithinPartitions("key", "first_end").select("key", "ends").mapInArrow(run, "key string, ends_sha256 string")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """(key, n_leaves, saved_tokens) summed over each node's subtree, in as many rounds as the greatest depth has binary digits.

    After a round each node has the sum of its descendants up to some distance, and knows its ancestor at that distance."""
    far = nodes.select("key", F.col("parent_key").alias("far"), "n_leaves", "saved_tokens")
    while not far.where("far is not null").isEmpty():
        gain = far.where("far is not null").groupBy("far").agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")).withColumnRenamed("far", "_key")
        above = far.select(F.col("key").alias("_at"), F.col("far").alias("_far"))
        summed = far.join(gain, F.col("key") == F.col("_key"), "left").join(above, F.col("far") == F.col("_at"), "left")
        far = written(summed.select("key", F.col("_far").alias("far"), *((F.col(c) + F.coalesce(g, F.lit(0))).alias(c) for c, g in (("n_leaves", "l"), ("saved_tokens", "s")))))
    return far.select("key", "n_leaves", "saved_tokens")


def trie(convs: DataFrame) -> DataFrame:
    """From (conv_id, turns): a row a node with its smallest member, depth, parent's smallest member, and counts."""
    spark = convs.sparkSession
    key = F.array_join(F.transform(F.slice("turns", 1, KEY_TURNS), lambda t: F.hex(t["id"])), "")
    keyed = written(convs.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words"), key.alias("key")))
    total = keyed.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).first()[0]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE_TURNS)
    parts = written(keyed.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id").select("conv_id", "ids", "words").mapInArrow(_range_nodes, _PARTS))

    shared = parts.where("shared")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = shared.groupBy("key").agg(F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), *sums)
    kids = merged.where("parent_key is not null").groupBy(F.col("parent_key").alias("_key")).agg(F.count("*").alias("kids"))
    children = F.col("n_children") + F.coalesce("kids", F.lit(0))
    joined = merged.join(kids, F.col("key") == F.col("_key"), "left").withColumn("n_children", children)
    own = {"n_leaves": F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0), "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")}
    base = written(joined.withColumns(own).drop("_key", "kids", "words"))
    ends = _digests(shared.where("first_end is not null").select("key", "first_end", "ends"))
    parents = base.select(F.col("key").alias("_parent"), F.col("conv_id").alias("_conv"))
    top = base.drop("n_leaves", "saved_tokens").join(_subtree_sums(base), "key").join(ends, "key", "left").join(parents, F.col("parent_key") == F.col("_parent"), "left")
    top = top.withColumns({"parent_conv_id": F.col("_conv"), "ends_sha256": F.coalesce("ends_sha256", F.lit(_EMPTY))})
    rest = parts.where("not shared").join(parents, F.col("parent_key") == F.col("_parent"), "left").withColumn("parent_conv_id", F.coalesce("_conv", "parent_conv_id"))
    return top.select(*_NODE).unionByName(rest.select(*_NODE))
