"""Secret scan through nested encodings.

A worklist starts with the text itself. Each layer is scanned with the base rules, then
its URL escapes and its Unicode escapes are decoded, in the whole layer (a key and its value may be
parted by plain blanks) and in each token alone (where a match in plain text before it can't take part
of it). Base64, in a line or wrapped over lines, also of gzip, zlib or bz2 data with all its members, is unwrapped
too. Each gives a new layer that knows, for each of its characters, the span of
the original text it stands for. A layer seen before with the same place is not taken up
again, so cycles end; the list runs dry at the fixpoint.

Decoded bytes need not be clean text: what isn't UTF-8 counts as Latin-1, and base64 is read from each of its
first four digits, as it may be glued to a path or a word. Compressed data of any size is unpacked as a
stream, in pieces of about ``PIECE`` bytes cut at characters that no secret and no encoding holds; a
stretch without such a character stays whole.

Input: any table with ``doc_id`` and ``text``. Null and empty texts have no spans; texts are
scanned whole; repeated rows give repeated results; an empty table gives no rows; other
columns are ignored. Offsets are code points, ends exclusive."""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
PIECE = 4 << 20
SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string, n_layers long"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_NAMES = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_TOKEN = re.compile(r"\S+")
_PERCENT = re.compile(r"%([0-9A-Fa-f]{2})")
_FORM = re.compile(r"%([0-9A-Fa-f]{2})|\+")
_UNICODE = re.compile(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})|\\u\{([0-9a-fA-F]{1,6})\}|\\U([0-9a-fA-F]{8})")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
#: No secret and no encoding has fewer plain characters in a row.
_PLAIN = re.compile(rb"[\x20-\x7e]{12}")
#: Bytes that are part of no secret and of no encoding.
_APART = re.compile(rb"[^A-Za-z0-9+/_.=\-\"': \t\r\n%\\{}\x80-\xff]")
_REPEATED = re.compile(rb"(.)\1{4095,}", re.S)
_TEXTUAL = re.compile(r"[\t\n\r\x20-\x7e -\U0010ffff]*")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the base rules, leftmost and without overlap for each kind."""
    out = []
    low = text.lower()
    if any(x in low for x in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


class _Layer:
    """A decoded text and, for each character, where in the document its source starts and ends."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray):
        self.text, self.starts, self.ends = text, starts, ends

    def key(self) -> tuple:
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), int(self.starts[0]), int(self.ends[-1])


def _replaced(source: _Layer | None, text: str, at: int, to: int, pattern: re.Pattern, decode) -> _Layer | None:
    """The token with each run of matches decoded as one unit; its characters share the run's bytes evenly."""
    parts, starts, ends, last = [], [], [], at
    runs: list[list[re.Match]] = []
    for m in pattern.finditer(text, at, to):
        if runs and runs[-1][-1].end() == m.start():
            runs[-1].append(m)
        else:
            runs.append([m])

    def plain(a: int, b: int) -> None:
        parts.append(text[a:b])
        starts.append(np.arange(a, b))
        ends.append(np.arange(a, b) + 1)

    for run in runs:
        plain(last, run[0].start())
        for got, a, b in decode(run):
            parts.append(got)
            starts.append(np.full(len(got), a))
            ends.append(np.full(len(got), b))
        last = run[-1].end()
    plain(last, to)
    return _mapped(source, "".join(parts), np.concatenate(starts).astype(np.int64), np.concatenate(ends).astype(np.int64))


def _mapped(source: _Layer | None, got: str, starts: np.ndarray, ends: np.ndarray) -> _Layer | None:
    if not got:
        return None
    return _Layer(got, starts, ends) if source is None else _Layer(got, source.starts[starts], source.ends[ends - 1])


def _percent_run(run: list[re.Match]) -> Iterator[tuple[str, int, int]]:
    raw = bytes(int(m[1], 16) if m[1] else 0x20 for m in run)
    i = 0
    while i < len(raw):  # one character at a time, so that each keeps its own span
        lead = raw[i]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            got = raw[i : i + size].decode()
        except UnicodeDecodeError:
            got, size = chr(lead), 1
        size = min(size, len(raw) - i)
        yield got, run[i].start(), run[i + size - 1].end()
        i += size


def _unicode_run(run: list[re.Match]) -> Iterator[tuple[str, int, int]]:
    i = 0
    while i < len(run):
        code, size = int(next(filter(None, run[i].groups())), 16), 1
        if 0xD800 <= code < 0xDC00 and i + 1 < len(run) and run[i + 1][1] and 0xDC00 <= (low := int(run[i + 1][1], 16)) < 0xE000:
            code, size = 0x10000 + ((code - 0xD800) << 10) + low - 0xDC00, 2
        yield chr(code if code < 0xD800 or 0xE000 <= code < 0x110000 else 0xFFFD), run[i].start(), run[i + size - 1].end()
        i += size


def _opener(head: bytes):
    """A decompressor for data with this head, or None."""
    if head[:2] == b"\x1f\x8b" or (head[:1] == b"\x78" and len(head) > 1 and (head[0] * 256 + head[1]) % 31 == 0):
        return zlib.decompressobj(47)
    return bz2.BZ2Decompressor() if head[:3] == b"BZh" else None


#: Where compressed data may begin in decoded bytes: gzip, bzip2, and zlib's usual headers but the one of plain letters.
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\x78[\x01\x9c\xda]")


def inflated(raw, member, used: list[int], size: int = PIECE, more: Iterator[bytes] = iter(())) -> Iterator[bytes]:
    """The content of all members of compressed data, in parts; ``member`` opens the first, ``more`` gives what follows ``raw``.

    ``used`` gets the number of bytes they take, and, if it has room, that of the members that are whole. Damaged data gives what comes before the damage."""
    data, read = raw, len(raw)
    while member is not None:
        while not member.eof:
            try:
                out = member.decompress(data, size)
            except (zlib.error, OSError, ValueError, EOFError):
                return
            data = getattr(member, "unconsumed_tail", b"")
            if out:
                used[0] = read
                yield out
            elif not data:
                data = next(more, b"")
                read += len(data)
                if not data:
                    return  # cut short
        data = member.unused_data
        if len(data) < 64:
            extra = next(more, b"")
            data, read = data + extra, read + len(extra)
        if data[:1] == b"\0":  # padding between members
            data = data.lstrip(b"\0")
        used[:] = [read - len(data)] * len(used)
        member = _opener(data)


def _content(parts: Iterator[bytes]) -> Iterator[bytes]:
    """The same bytes; if they are compressed in turn, their content, unpacked as it comes."""
    head = next(parts, b"")
    inner = _opener(head)
    tried: list[bytes] | None = [head]  # given out as they are if nothing can be unpacked
    if inner is not None:

        def fed() -> Iterator[bytes]:
            for part in parts:
                if tried is not None:
                    tried.append(part)
                yield part

        for out in _content(inflated(head, inner, [0], more=fed())):
            tried = None
            yield out
    if tried is not None:
        yield from tried
        yield from parts


def pieces(parts: Iterator[bytes], size: int = PIECE) -> Iterator[bytes]:
    """The same bytes cut at bytes that stand apart, from ``size`` bytes on. Where none does, the bytes grow, but for repeats of one byte, of which 4,096 or a few more stay."""
    held = b""
    for part in parts:
        held += part
        if len(held) < size:
            continue
        for near in (1 << 14, len(held)):
            cut = max((m.end() for m in _APART.finditer(held, len(held) - min(near, len(held)))), default=0)
            if cut:
                break
        if cut:
            yield held[:cut]
            held = held[cut:]
        else:
            held = _REPEATED.sub(lambda m: m[1] * (4096 + len(m[0]) % 4), held)
    if held:
        yield held


def _text(raw: bytes) -> str | None:
    """As UTF-8, else Latin-1; None where no secret can be in it."""
    if not _PLAIN.search(raw):
        return None
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _sizes(text: str, raw: bytes) -> np.ndarray:
    """The bytes that each character stands for."""
    if len(text) == len(raw):
        return np.ones(len(text), np.int64)
    code = np.array([ord(c) for c in text])
    return 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)


def _unpacked_layers(source: _Layer | None, raw, member, at: int, to: int, used: list[int] | None = None) -> Iterator[_Layer]:
    """The pieces of compressed data, and of compressed data in it; each character stands for all of it."""
    if source is not None:
        at, to = int(source.starts[at]), int(source.ends[to - 1])
    for piece in pieces(_content(inflated(raw, member, used or [0]))):
        if text := _text(piece):
            yield _Layer(text, np.broadcast_to(np.int64(at), len(text)), np.broadcast_to(np.int64(to), len(text)))


def _from_bytes(source: _Layer | None, raw: bytes, at: int, to: int) -> Iterator[_Layer]:
    """The layers of decoded base64 that stands from ``at`` to ``to``: each run of compressed data in it, and the bytes before, between and after them as text."""

    def plain(a: int, b: int) -> Iterator[_Layer]:
        if text := _text(raw[a:b]):
            ends = a + np.cumsum(sizes := _sizes(text, raw[a:b]))
            if layer := _mapped(source, text, at + (ends - sizes) * 4 // 3, np.minimum(at - (-ends * 4 // 3), to)):
                yield layer

    view, done, damaged = memoryview(raw), 0, False
    for i in sorted({0, *(m.start() for m in _MAGIC.finditer(raw))}):
        if i < done or (member := _opener(raw[i : i + 4])) is None:
            continue
        used = [0, 0]
        for layer in _unpacked_layers(source, view[i:], member, at + i * 4 // 3, to, used):
            damaged = True
            yield layer
        if used[1]:  # what only looked like compressed data ends in damage, and the bytes in it are looked at again
            yield from plain(done, i)
            done = i + used[1]
    if done:
        yield from plain(done, len(raw))
    elif not damaged and _PLAIN.search(raw):
        yield from plain(0, len(raw))
    elif not damaged:  # deflate without a header
        yield from _unpacked_layers(source, raw, zlib.decompressobj(-15), at, to)


def _decoded(digits: str) -> bytes:
    digits = digits[: len(digits) - (len(digits) % 4 == 1)]
    return base64.b64decode(digits.replace("-", "+").replace("_", "/") + "=" * (-len(digits) % 4))


def _leading(raw: bytes) -> str:
    """The longest start of ``raw`` that is text."""
    try:
        got = raw.decode()
    except UnicodeDecodeError as e:
        got = raw[: e.start].decode()
    return _TEXTUAL.match(got)[0]


def _joined_lines(source: _Layer | None, text: str) -> Iterator[_Layer]:
    """The layers of base64 that goes over line breaks.

    Lines of base64 don't get shorter before the last. A word on the line before looks like base64, too, so each line may be the first one,
    and what follows the last is cut off where it is no text."""
    for m in _WRAPPED.finditer(text):
        lines = [(x.start(), x.end()) for x in _LINE.finditer(text, m.start(), m.end())]
        i = 0
        while i < len(lines) - 1:
            j = i + 1
            while j < len(lines) - 1 and lines[j][1] - lines[j][0] >= lines[j - 1][1] - lines[j - 1][0]:
                j += 1
            first, i, mine = lines[i][1] - lines[i][0], i + 1, lines[i : j + 1]
            if max(b - a for a, b in mine) < 16:
                continue
            # enough of the first line tells whether it is worth joining
            head = _decoded(text[mine[0][0] : mine[0][1]][: 64 if first >= 64 else first // 4 * 4])
            if not head or not (head[:2] == b"\x1f\x8b" or head[:1] == b"\x78" or head[:3] == b"BZh" or len(_leading(head)) > 0):
                continue
            raw = _decoded("".join(text[a:b] for a, b in mine))
            at = np.concatenate([np.arange(a, b) for a, b in mine])
            used = [0]
            if (member := _opener(raw)) is not None:
                for _ in inflated(raw, member, used):  # to learn where the data ends
                    pass
            if used[0]:
                last = min(-(-used[0] * 4 // 3), len(at))
                if last <= first:
                    continue
                yield from _unpacked_layers(source, raw[: used[0]], _opener(raw), int(at[0]), int(at[last - 1]) + 1)
                if last > len(at) - (mine[-1][1] - mine[-1][0]):
                    i = j + 1
                continue
            if got := _leading(raw):
                sizes = np.array([len(c.encode()) for c in got], np.int64)
                to = np.cumsum(sizes)
                last = min(-(-int(to[-1]) * 4 // 3), len(at))
                starts, ends = at[(to - sizes) * 4 // 3], at[np.minimum(-(-to * 4 // 3), len(at)) - 1] + 1
            if not got or last <= first:
                continue
            if layer := _mapped(source, got, starts.astype(np.int64), ends.astype(np.int64)):
                yield layer
            if last > len(at) - (mine[-1][1] - mine[-1][0]):
                i = j + 1  # all lines are used


def _escapes(source: _Layer | None, text: str, pattern: re.Pattern, decode) -> Iterator[_Layer]:
    tokens = [t.span() for t in _TOKEN.finditer(text) if pattern.search(text, *t.span())]
    for at, to in dict.fromkeys([(0, len(text)), *tokens]):
        if layer := _replaced(source, text, at, to, pattern, decode):
            yield layer


def _unwrapped(source: _Layer | None, text: str) -> Iterator[_Layer]:
    """The layers directly below ``text``."""
    if "%" in text and _PERCENT.search(text):
        yield from _escapes(source, text, _PERCENT, _percent_run)
        if "+" in text:
            yield from _escapes(source, text, _FORM, _percent_run)
    if "\\" in text and _UNICODE.search(text):
        yield from _escapes(source, text, _UNICODE, _unicode_run)
    if "\n" in text:
        yield from _joined_lines(source, text)
    for m in _BASE64.finditer(text):
        body = m[0].rstrip("=")
        for phase in range(4):
            if len(body) - phase >= 16 - (phase > 0):
                yield from _from_bytes(source, _decoded(body[phase:]), m.start() + phase, m.end())


def scan(text: str) -> tuple[list[Span], list[Span], int]:
    """Base spans, all spans, number of layers below the text."""
    base = base_spans(text)
    found, seen = set(base), set()
    work = [_unwrapped(None, text)]  # the layers still to come, by depth; one of each depth is held at a time
    above = [text]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            above.pop()
        elif layer.text != above[-1] and (key := layer.key()) not in seen:
            seen.add(key)
            for s, kind, e in base_spans(layer.text):
                found.add((int(layer.starts[s]), kind, int(layer.ends[e - 1])))
            work.append(_unwrapped(layer, layer.text))
            above.append(layer.text)
    return base, sorted(found), len(seen)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{s}:{e}" for s, kind, e in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per document: base counts by kind, base spans and all spans as ``kind:start:end`` lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_assign", "n_access", "n_hex", "base_spans", "spans", "n_layers"]
        for batch in batches:
            rows = []
            for value in batch.column(1):
                base, every, layers = scan(value.as_py() or "")
                rows.append((*(sum(k == i for _, k, _ in base) for i in range(3)), joined(base), joined(every), layers))
            cols = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=["doc_id", *names])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, SCANNED)


def masked(text: str, spans: list[Span], sign: str = "*") -> str:
    """``text`` with each span overwritten, its length unchanged; ``spans`` in order, in one pass."""
    parts, at = [], 0
    for s, _, e in spans:
        s = max(s, at)
        if s < e:
            parts += [text[at:s], sign * (e - s)]
            at = e
    return "".join([*parts, text[at:]])


def mask_secrets(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, with every secret span in ``text`` overwritten by ``*``.

    Null texts stay null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else masked(t, scan(t)[1]))

    return docs.withColumn("text", clean(docs["text"]))
