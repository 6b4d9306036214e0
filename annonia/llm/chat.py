"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole, with a template that marks each turn:

    ### role: text</turn>

Control strings inside roles and texts (runs of three or more ``#``, ``</turn>``, and the escape
character ``\\`` itself) are escaped reversibly. The rendered text is encoded once; tokens know
the bytes they cover. The spans of the texts to learn from and those of the tokens are both
sorted, so their intersection is found by binary search, and gives the mask: the tokens
under it, with the first and last one clipped to the span.

Input: ``conv_id``, ``turn``, ``role``, ``text``, one row a turn. Turns are ordered by ``turn`` (null
first), then role, then text; null roles and texts count as empty; repeated rows are turns of
their own; rows with a null conv_id form one conversation; an empty table gives no rows; other
columns are ignored. Rows of a conversation are sorted by Spark and read as a stream, so one
conversation is held at a time."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe

LEARN_FROM = "assistant"
_CONTROL = re.compile(r"\\|#{3,}|</turn>")
_IN_ROLE = re.compile(r"\\|#{3,}|</turn>|:")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*?)</turn>\n", re.S)
FORMATTED = "conv_id long, n_turns long, formatted string, ids binary, mask_first binary, mask_last binary, mask_begin binary, mask_end binary"


def escaped(text: str, pattern: re.Pattern = _CONTROL) -> str:
    return pattern.sub(lambda m: "<\\/turn>" if m[0] == "</turn>" else "".join("\\" + c for c in m[0]), text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text and, in characters, the spans of the texts to learn from."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"### {escaped(role, _IN_ROLE)}: ", escaped(text)
        if role == LEARN_FROM:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}</turn>\n")
        at += len(parts[-1])
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns, read back from a rendered conversation."""
    return [(unescaped(m[1]), unescaped(m[2])) for m in _TURN.finditer(formatted)]


def masked(token_ends: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last token (exclusive) that each sorted byte span meets, by binary search in the sorted token ends."""
    first = np.searchsorted(token_ends, spans[:, 0], side="right")
    last = np.searchsorted(token_ends, spans[:, 1], side="left") + 1
    return first, np.where(spans[:, 1] > spans[:, 0], last, first)


def format_conversations(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row a conversation: rendered text, ids (4-byte little-endian), and the mask as token ranges with their byte spans (8-byte little-endian each)."""
    sent = rows.sparkSession.sparkContext.broadcast(bpe.read_ranks(ranks_path))
    names = [x.split()[0] for x in FORMATTED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(sent.value, pattern)
        sizes = {i: len(b) for i, b in enc.bytes_of.items()}
        done: list[tuple] = []

        def finish(conv: int | None, turns: list[tuple[str, str]]) -> None:
            text, spans = render(turns)
            ids = enc.encode(text)
            ends = np.cumsum([sizes[i] for i in ids], dtype=np.int64)
            cuts = sorted({x for s in spans for x in s})
            in_bytes, at, size = {}, 0, 0
            for c in cuts:
                size += len(text[at:c].encode())
                in_bytes[c], at = size, c
            byte_spans = np.array([[in_bytes[a], in_bytes[b]] for a, b in spans], np.int64).reshape(-1, 2)
            first, last = masked(ends, byte_spans)
            done.append((conv, len(turns), text, np.array(ids, np.uint32).tobytes(), *(x.astype(np.int64).tobytes() for x in (first, last, byte_spans[:, 0], byte_spans[:, 1]))))

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * 5]
            out = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
            done.clear()
            return out

        now: list = []
        turns: list[tuple[str, str]] = []
        for batch in batches:
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2))):
                if now != [conv]:
                    if now:
                        finish(now[0], turns)
                    now, turns = [conv], []
                    if len(done) >= 200:
                        yield batch_of()
                turns.append((role, text))
        if now:
            finish(now[0], turns)
        if done:
            yield batch_of()

    plain = rows.select(rows["conv_id"].cast("long").alias("conv_id"), rows["turn"].cast("long").alias("turn"), *(F.coalesce(rows[c].cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    return plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """What the formatted rows say: turns from the text, learnt text from the ids under the mask."""
    sent = formatted.sparkSession.sparkContext.broadcast(bpe.read_ranks(ranks_path))
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(sent.value, pattern)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                turns = parse(r["formatted"])
                digest = hashlib.sha256()
                for role, text in turns:
                    digest.update(f"{role}\n{text}\n".encode())
                ids = np.frombuffer(r["ids"], np.uint32).tolist()
                first, last, begin, end = (np.frombuffer(r[k], np.int64).tolist() for k in ("mask_first", "mask_last", "mask_begin", "mask_end"))
                at = np.concatenate([[0], np.cumsum([len(enc.bytes_of[i]) for i in ids])]).astype(int)
                learnt = "".join(unescaped(enc.decode(ids[f:t])[b - at[f] : e - at[f]].decode()) for f, t, b, e in zip(first, last, begin, end))
                rows.append((r["conv_id"], len(turns), digest.hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(r["formatted"]), len(ids), sum(t - f for f, t in zip(first, last))))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 8, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return formatted.mapInArrow(run, schema)
