"""Byte-level BPE by backtracking over longest vocabulary matches.

The bytes of a piece are mapped to Latin-1 so that an Aho-Corasick automaton finds all
vocabulary entries in one pass. The encoder takes the longest entry at each place and
keeps it if it can stand after its left neighbour in a merge result; else it shortens, and
at last gives its left neighbour back. Positions that led nowhere are remembered, so each
is left at most once and the time is linear. Which neighbours are compatible is memoised.

Input: any table with ``doc_id`` and ``text``. Null text counts as empty and gives no ids;
texts are encoded whole; repeated rows give repeated results; an empty table gives no rows;
other columns are ignored."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

ENCODED = "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"
#: Pieces up to this many characters are remembered, and so many of them at most; others are encoded anew.
PIECE, PIECES = 48, 400_000


def read_ranks(path: str) -> bytes:
    """The rank file, read where the job is planned; it travels with the tasks (under 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


class _Pieces(dict):
    """Ids of the pieces seen lately, in decimal."""

    def __init__(self, enc: "Encoder"):
        super().__init__()
        self.enc = enc

    def __missing__(self, piece: str) -> str:
        got = " ".join(map(str, self.enc.encode_bytes(piece.encode("utf-8", "surrogatepass"))))
        if len(piece) <= PIECE:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = got
        return got


class Encoder:
    """Encodes and decodes with the ranks of one vocabulary."""

    def __init__(self, ranks: bytes, pattern: str):
        self.pattern = regex.compile(pattern)
        pairs = [line.split() for line in ranks.splitlines() if line.strip()]
        self.bytes_of = {int(r): base64.b64decode(t) for t, r in pairs}
        self.ids = {b: r for r, b in self.bytes_of.items()}
        self.automaton = ahocorasick.Automaton()
        for r, b in self.bytes_of.items():
            self.automaton.add_word(b.decode("latin-1"), (r, len(b)))
        self.automaton.make_automaton()
        self.joined: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        for r in sorted(self.bytes_of):
            self.halves[r] = self._split(r)
        self.fits.clear()
        self.decimal = {str(r): b for r, b in self.bytes_of.items()}
        self.cache = _Pieces(self)

    def _split(self, r: int) -> tuple[int, int]:
        """The two entries whose merge makes ``r``; a single byte is its own half."""
        b = self.bytes_of[r]
        for cut in range(len(b) - 1, 0, -1):
            left, right = self.ids.get(b[:cut], r), self.ids.get(b[cut:], r)
            if left < r and right < r and self._fit(left, right):
                self.joined[left, right] = r
                return left, right
        return r, r

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` side by side."""
        key = (left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            known = self.fits[key] = self._fit(left, right)
        return known

    def _fit(self, left: int, right: int) -> bool:
        """Undo the later of the two merges again and again; no merge across the border may come before it."""
        bound = float("inf")
        while True:
            if self.joined.get((left, right), bound) < bound:
                return False
            undo_left = left > right
            for _ in range(2):
                if undo_left:
                    bound, (_, half) = left, self.halves[left]
                    if half != left:
                        left = half
                        break
                else:
                    bound, (half, _) = right + 1, self.halves[right]
                    if half != right:
                        right = half
                        break
                undo_left = not undo_left
            else:
                return True

    def encode_bytes(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ids.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        at: list[list[int]] = [[] for _ in range(n)]
        for end, (r, size) in self.automaton.iter(piece.decode("latin-1")):
            at[end + 1 - size].append(r)  # by growing length
        size_of, open_ = self.bytes_of, bytearray(b"\1") * (n + 1)
        out: list[int] = []
        tried: list[int] = []  # how many entries of at[pos] were passed over, for each token of out
        pos, skip = 0, 0
        while pos < n:
            found = at[pos]
            k = len(found) - 1 - skip
            while k >= 0:
                r = found[k]
                if open_[pos + len(size_of[r])] and (not out or self.compatible(out[-1], r)):
                    break
                k -= 1
            if k >= 0:
                out.append(r)
                tried.append(len(found) - 1 - k)
                pos, skip = pos + len(size_of[r]), 0
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a single byte of the text")
                open_[pos] = 0
                pos -= len(size_of[out.pop()])
                skip = tried.pop() + 1
        return tuple(out)

    def encode_decimal(self, text: str) -> str:
        """The ids in decimal, with one space between."""
        return " ".join(map(self.cache.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encode_decimal(text).split()))

    def decode_decimal(self, ids: str) -> bytes:
        return b"".join(map(self.decimal.__getitem__, ids.split()))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(ranks: bytes, pattern: str) -> Encoder:
    return Encoder(ranks, pattern)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """Per document: number of tokens, the ids (4-byte little-endian each), and digests of ids and of the decoded bytes.

    ``with_ids=False`` leaves the ids themselves null where only the digests are wanted."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import array

        enc = encoder(sent.value, pattern)
        for batch in batches:
            ids, counts, blobs, digests, decoded = batch.column(0), [], [], [], []
            for value in batch.column(1):
                got = enc.encode_decimal(value.as_py() or "")
                counts.append(got.count(" ") + 1 if got else 0)
                blobs.append(array.array("I", map(int, got.split())).tobytes() if with_ids else None)
                digests.append(hashlib.sha256(got.encode()).hexdigest())
                decoded.append(hashlib.sha256(enc.decode_decimal(got)).hexdigest())
            yield pa.record_batch([ids, pa.array(counts, pa.int64()), pa.array(blobs, pa.binary()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, ENCODED)
