"""SentencePiece encoding and decoding through a table of distinct chunks.

Blanks become markers, and one more stands before each text. Where no piece has a marker after
another character, no merge can cross the place before a marker that follows another character: a text is
a sequence of chunks (markers, then other characters) that are segmented apart. Each batch of texts is cut into
chunks in a few vectorised passes and reduced to its distinct ones; each distinct chunk is merged once
and gets a row in a table (ids, their decimal form, decoded bytes). The texts' results are that
table's rows taken by position and joined, so the work on text grows with the distinct chunks.
The table of a task outlives its batches up to ``CHUNKS`` short chunks, then it is begun anew; that
changes no result. Long chunks are cut further between characters that stand side by side in no piece.

Input: any table with ``doc_id`` and ``text``. Null text counts as empty and gives no ids; texts are
encoded whole; repeated rows give repeated results; an empty table gives no rows; other columns are
ignored. A marker character in a text is a blank, as in the library. Models that normalise texts, merge
blanks, take in no blank at the start, lack byte fallback or have user-defined or crossing pieces raise ValueError."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import textkit

ENCODED = "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"
MARK = "▁"
#: Chunks up to this many bytes stay in a task's table, and so many of them at most; longer ones are segmented anew in each batch.
CHUNK, CHUNKS = 48, 300_000
#: Bytes of text in a slice of a batch; characters from which merging takes a heap.
SLICE, LONG = 8 << 20, 64
_NONE = 1 << 60
codecs.register_error("one_each", lambda e: ("\ufffd" * (e.end - e.start), e.end))

# ---- fixed values: the model file's kinds of pieces and numbers of fields ----
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PIECES_FIELD, TRAINER_FIELD, NORMALIZER_FIELD = 1, 2, 3
MODEL_TYPE, BPE, BYTE_FALLBACK = 3, 2, 35
CHARS_MAP, DUMMY_PREFIX, REMOVE_BLANKS, ESCAPE_BLANKS = 2, 3, 4, 5
# ---- end of fixed values ----


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            yield number, data[at : at + n]
            at += n


class Model:
    """Merges and pieces of one model file."""

    def __init__(self, raw: bytes):
        pieces, spec, norm = [], {}, {DUMMY_PREFIX: 1, REMOVE_BLANKS: 1, ESCAPE_BLANKS: 1}
        for number, value in _fields(raw):
            if number == PIECES_FIELD:
                f = dict(_fields(value))
                pieces.append((f[1].decode(), struct.unpack("<f", f.get(2, bytes(4)))[0], f.get(3, NORMAL)))
            elif number in (TRAINER_FIELD, NORMALIZER_FIELD):
                (spec if number == TRAINER_FIELD else norm).update(_fields(value))
        wrong = {
            "no merges": spec.get(MODEL_TYPE) != BPE,
            "no byte fallback": not spec.get(BYTE_FALLBACK),
            "normalising": bool(norm.get(CHARS_MAP)) or not norm[DUMMY_PREFIX] or norm[REMOVE_BLANKS] or not norm[ESCAPE_BLANKS],
            "user-defined or unused pieces": any(kind in (USER_DEFINED, UNUSED) for _, _, kind in pieces),
            "pieces that cross a marker": any(MARK in p.lstrip(MARK) for p, _, kind in pieces if kind == NORMAL),
        }
        if any(wrong.values()):
            raise ValueError("unsupported model: " + ", ".join(k for k, v in wrong.items() if v))
        scores = sorted({s for _, s, kind in pieces if kind == NORMAL}, reverse=True)
        place = {s: i for i, s in enumerate(scores)}
        #: rank by score, pieces of equal scores share it: the leftmost of them is merged first
        self.rank = {p: place[s] for p, s, kind in pieces if kind == NORMAL}
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        byte_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        empty = {i for i, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        unknown = " ⁇ ".encode()
        self.bytes_of = [byte_of.get(i, b"" if i in empty else unknown if kind == UNKNOWN else p.replace(MARK, " ").encode()) for i, (p, _, kind) in enumerate(pieces)]
        self.pairs = {p[k : k + 2] for p in self.rank for k in range(len(p) - 1)}
        self.table: dict[bytes, tuple[int, bytes, bytes, bytes]] = {}

    def _merged(self, text: str) -> list[str]:
        """The parts of a short text: the best pair is merged until none is a piece."""
        get, parts = self.rank.get, list(text)
        ranks = [get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], _NONE)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], _NONE)
        return parts

    def _merged_long(self, text: str) -> list[str]:
        """The same through a heap of pairs over a linked list of parts."""
        n, get = len(text), self.rank.get
        parts: list[str] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := get(text[i : i + 2], _NONE)) < _NONE]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n and (r := get(parts[a] + parts[b], _NONE)) < _NONE:
                    heapq.heappush(heap, (r, a, len(parts[a]) + len(parts[b])))
        return [p for p in parts if p]

    def segment(self, chunk: str) -> list[int]:
        """Ids of a chunk of markers and other characters."""
        out: list[int] = []
        a = 0
        for b in range(1, len(chunk) + 1):
            if b < len(chunk) and (len(chunk) <= LONG or chunk[b - 1 : b + 1] in self.pairs):
                continue
            part = chunk[a:b]
            for p in self._merged(part) if len(part) <= LONG else self._merged_long(part):
                known = self.ids.get(p)
                out += [known] if known is not None else map(self.byte_ids.__getitem__, p.encode("utf-8", "surrogatepass"))
            a = b
        return out

    def entry(self, chunk: bytes) -> tuple[int, bytes, bytes, bytes]:
        """The chunk's row of the table: number of ids, the ids (4-byte little-endian), in decimal with a comma before each, decoded bytes."""
        row = self.table.get(chunk)
        if row is None:
            ids = self.segment(chunk.decode("utf-8", "replace").replace(" ", MARK))
            row = len(ids), struct.pack(f"<{len(ids)}I", *ids), "".join(f",{i}" for i in ids).encode(), b"".join(map(self.bytes_of.__getitem__, ids))
            if len(chunk) <= CHUNK:
                if len(self.table) >= CHUNKS:
                    self.table.clear()
                self.table[chunk] = row
        return row

    def decode(self, ids) -> str:
        """Text of any ids; each byte of a broken run gives a replacement character."""
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        return data.removeprefix(b" ").decode("utf-8", "one_each")


@lru_cache(maxsize=2)
def model(raw: bytes) -> Model:
    return Model(raw)


def _chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All chunks of the texts in order, and for each text the index of its first chunk (one more entry at the end)."""
    plain = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), MARK, " ")
    led = pc.if_else(pc.equal(plain, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), plain, pa.scalar("", pa.large_string())))
    data, offs = textkit.column(led)
    blank = data == 0x20
    starts = blank.copy()
    starts[1:] &= ~blank[:-1]
    starts[offs[:-1][offs[1:] > offs[:-1]]] = True
    at = np.flatnonzero(starts)
    bounds = np.append(at, len(data))
    chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data.tobytes())])
    return chunks, np.searchsorted(at, offs)


def _joined(column: list[bytes], position: pa.Array, first: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The table's values taken by position, as one buffer, and each text's bounds in it."""
    taken = pa.array(column, pa.large_binary()).take(position)
    data, offs = textkit.column(taken)
    return memoryview(data.tobytes()), offs[first]


def encode_decode(docs: DataFrame, model_path: str, with_ids: bool = True) -> DataFrame:
    """Per document: number of ids, the ids (4-byte little-endian each), and digests of the ids in decimal and of the decoded text.

    ``with_ids=False`` leaves the ids themselves null where only the digests are wanted."""
    with open(model_path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # the model file, half a megabyte
    names = [x.split()[0] for x in ENCODED.split(", ")]

    def coded(m: Model, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        chunks, first = _chunks(texts)
        coded_chunks = chunks.dictionary_encode()
        rows = [m.entry(c) for c in coded_chunks.dictionary.to_pylist()]
        position = coded_chunks.indices
        counts = np.array([r[0] for r in rows], np.int64)[position.to_numpy()] if rows else np.zeros(0, np.int64)
        n_tokens = np.diff(np.append(0, np.cumsum(counts))[first])
        decimal, at = _joined([r[2] for r in rows], position, first)
        digests = [hashlib.sha256(decimal[a + (b > a) : b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        decoded, at = _joined([r[3] for r in rows], position, first)
        texts_back = [hashlib.sha256(decoded[a + (b > a) : b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        blobs: list = [None] * len(ids)
        if with_ids:
            packed, at = _joined([r[1] for r in rows], position, first)
            blobs = [bytes(packed[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.record_batch([ids, pa.array(n_tokens, pa.int64()), pa.array(blobs, pa.binary()), pa.array(digests, pa.string()), pa.array(texts_back, pa.string())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(sent.value)
        for batch in batches:
            _, offs = textkit.column(batch.column(1))
            for i, j in textkit.slices(offs, SLICE):
                yield coded(m, batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i))

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, ENCODED)
