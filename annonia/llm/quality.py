"""Quality rules: text statistics, and a linear-chain CRF over lines.

Lines become sequences of feature vectors; a conditional random field with two states
(content, boilerplate) is decoded with Viterbi, and the share of a document's characters
that stand in content lines decides whether it stays.

The field is fitted on a bounded sample of labelled documents: ``TRAIN_DOCS`` of them, those
with the smallest hash of ``doc_id``; of these, documents of more than ``TRAIN_LINES`` lines are left out of the
fitting, not shortened. A document's label says what most of its lines are like, so lines that look otherwise are
left open. Everything else runs over all documents and whole texts.

Input: ``doc_id``, ``text``; labels with ``doc_id``, ``quality``. Null and empty texts have no
words and fail the base rules; repeated rows give repeated results but count once in the sample, rows of one id
with different texts as the one of least features; a document with both labels counts as bad in the sample, labels without a document or a value are passed over; without labels the
field has no say and keeps all; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

TRAIN_DOCS, TRAIN_LINES = 1500, 40
SHARE, CAUTION, SURE = 0.3, 1.0, 0.9
STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_share double, base_failed boolean, kept boolean"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_BANG = np.zeros(256, bool)
_BANG[list(b"!?")] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
N_FEATURES = 24


def _lines(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines that hold a word, and first lines by text."""
    cut = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offs[:-1], cut + 1]))
    starts = starts[starts < len(data)]
    doc_end = offs[np.searchsorted(offs, starts, side="right")]
    ends = np.minimum(np.append(cut, len(data))[np.searchsorted(cut, starts)], doc_end)
    has = np.concatenate([[0], np.cumsum(tk.IS_WORD[data])])
    full = has[ends] > has[starts]
    starts, ends = starts[full], ends[full]
    return starts, ends, np.searchsorted(starts, offs)


def _count(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flags)])
    return c[ends] - c[starts]


def line_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, repeated: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """0/1 features of each line."""
    size = np.maximum(ends - starts, 1)
    f = np.zeros((len(starts), N_FEATURES))
    if not len(starts):
        return f
    f[:, 0] = 1
    at = 1
    for flags, bounds in ((_SYMBOL, (0.001, 0.02, 0.06, 0.15)), (_BANG, (0.001, 0.03, 0.1))):
        share = _count(flags[data], starts, ends) / size
        for b in bounds:
            f[:, at] = share >= b
            at += 1
    share = _count(_UPPER[data], starts, ends) / np.maximum(_count(_ALPHA[data], starts, ends), 1)
    for b in (0.05, 0.2, 0.5):
        f[:, at] = share >= b
        at += 1
    per_word = size / np.maximum(n_words, 1)
    for b in (4.5, 5.5, 7, 9, 12):
        f[:, at] = per_word >= b
        at += 1
    for b in (3, 8, 20, 60):
        f[:, at] = n_words >= b
        at += 1
    f[:, at] = repeated
    f[:, at + 1] = np.isin(data[ends - 1], list(b".!?:;"))
    f[:, at + 2] = data[ends - 1] == 46
    return f


class Field:
    """Weights of the two states' features (state 1 is boilerplate) and of the four transitions."""

    def __init__(self, w: np.ndarray, t: np.ndarray):
        self.w, self.t = w, t

    @classmethod
    def blank(cls) -> Field:
        return cls(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)))

    @classmethod
    def fit(cls, lines: list[np.ndarray], labels: list[int], rounds: int = 40, rate: float = 0.15, ridge: float = 1e-3) -> Field:
        """Maximum likelihood by gradient steps with forward-backward; classes of documents count alike.

        A document's label is evidence for its lines, not their label. Lines are first told apart one by
        one as if it were; then the state of a line that looks like the other class is left open (in good documents
        only where it surely does, by ``SURE``), and the field is fitted to the states that are not open."""
        field = cls.blank()
        if not lines or len(set(labels)) < 2:
            return field
        order = np.argsort([-len(x) for x in lines], kind="stable")
        lines, y = [lines[i] for i in order], np.array([labels[i] for i in order])
        n, most = len(lines), len(lines[0])
        sizes = np.array([len(x) for x in lines])
        x = np.zeros((n, most, N_FEATURES))
        for i, one in enumerate(lines):
            x[i, : len(one)] = one
        weight = (n / (2 * np.bincount(y, minlength=2)))[y] / sizes
        barred = np.zeros((n, most, 2))
        barred[np.arange(n), :, 1 - y] = -1e9
        field._climb(x, sizes, weight, barred, rounds, rate, ridge, with_moves=False)
        bad = field._expected(x @ field.w, sizes)[0][:, :, 1]
        barred[np.where(y[:, None] == 1, bad < 0.5, bad > SURE)] = 0
        field._climb(x, sizes, weight, barred, rounds, rate, ridge, with_moves=True)
        return field

    def _expected(self, e: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each line's states, and expected moves of each document; documents stand by falling size."""
        n, most = e.shape[:2]
        on = np.arange(most)[None] < sizes[:, None]
        a, b = np.zeros((n, most, 2)), np.zeros((n, most, 2))
        a[:, 0] = e[:, 0]
        for k in range(1, most):
            live = int(on[:, k].sum())
            a[:live, k] = e[:live, k] + np.logaddexp.reduce(a[:live, k - 1][:, :, None] + self.t[None], axis=1)
        for k in range(most - 2, -1, -1):
            live = int(on[:, k + 1].sum())
            b[:live, k] = np.logaddexp.reduce(self.t[None] + (e[:live, k + 1] + b[:live, k + 1])[:, None, :], axis=2)
        z = np.logaddexp.reduce(a[np.arange(n), sizes - 1], axis=1)
        p = np.exp(a + b - z[:, None, None]) * on[:, :, None]
        q = np.exp(a[:, :-1, :, None] + self.t + (e + b)[:, 1:, None, :] - z[:, None, None, None]) * on[:, 1:, None, None]
        return p, q.sum(1)

    def _climb(self, x, sizes, weight, barred, rounds: int, rate: float, ridge: float, with_moves: bool) -> None:
        """Gradient steps: what the field expects with the barred states left out, less what it expects."""
        moments = [np.zeros_like(self.w), np.zeros_like(self.w), np.zeros_like(self.t), np.zeros_like(self.t)]
        for step in range(1, rounds + 1):
            e = x @ self.w
            (p, q), (p_on, q_on) = self._expected(e, sizes), self._expected(e + barred, sizes)
            gw = np.einsum("ntf,nts,n->fs", x, p_on - p, weight) / len(x) - ridge * self.w
            gt = np.einsum("nij,n->ij", q_on - q, weight) / len(x) - ridge * self.t
            for g, (m, v), target in ((gw, moments[:2], self.w), (gt, moments[2:], self.t)):
                if target is self.t and not with_moves:
                    continue
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                target += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)

    def decode(self, e: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best state of every line; ``first`` has each text's first line. All texts advance together, the longest first."""
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        states = np.zeros(len(e), np.int8)
        if not len(e):
            return states
        back = np.zeros((len(e), 2), np.int8)
        begin, live = first[:-1][order], int((sizes > 0).sum())
        ordered = -sizes[order]
        score = e[begin[:live]].copy()
        last = score.copy()
        for k in range(1, int(sizes.max())):
            live = int(np.searchsorted(ordered, -k, side="left"))
            paths = last[:live, :, None] + self.t[None]
            back[begin[:live] + k] = paths.argmax(1)
            last[:live] = paths.max(1) + e[begin[:live] + k]
        now = last.argmax(1)
        for k in range(int(sizes.max()) - 1, -1, -1):
            live = int(np.searchsorted(ordered, -k, side="left"))
            states[begin[:live] + k] = now[:live]
            now[:live] = back[begin[:live] + k, now[:live]]
        return states


def measure(data: np.ndarray, offs: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Statistics by text, features and sizes of the lines, first lines by text."""
    h, ws, _, first = tk.word_hashes(data, offs, lower=False)
    n_docs = len(offs) - 1
    starts, ends, line_at = _lines(data, offs)
    line_hash = tk.span_hashes(data, starts, ends)
    chars = ((data & 0xC0) != 0x80) & tk.IS_WORD[data]
    stats = {"n_words": np.diff(first), "word_chars": _count(chars, offs[:-1], offs[1:]), "n_symbols": _count(_SYMBOL[data], offs[:-1], offs[1:])}
    dup, rep = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    repeated = np.zeros(len(starts), bool)
    for i in range(n_docs):
        a, b = line_at[i], line_at[i + 1]
        if b - a > 1:
            seen = np.unique(line_hash[a:b], return_index=True)[1]
            if len(seen) < b - a:
                repeated[a:b] = True
                repeated[a + seen] = False
                dup[i] = b - a - len(seen)
        a, b = first[i], first[i + 1]
        if b - a > 3:
            w = h[a:b]
            three = tk.mix(w[:-2]) * tk.U(3) + tk.mix(w[1:-1] + tk.U(1)) * tk.U(5) + w[2:]
            order = np.argsort(three)
            same = three[order[1:]] == three[order[:-1]]
            if same.any():
                twice = np.zeros(len(three), bool)
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                covered = np.zeros(b - a, bool)
                for j in range(3):
                    covered[j : j + len(three)] |= twice
                rep[i] = covered.sum()
    stats |= {"n_dup_lines": dup, "n_repeat_words": rep}
    words_in = np.searchsorted(ws, ends) - np.searchsorted(ws, starts)
    return stats, line_features(data, starts, ends, repeated, words_in), ends - starts, line_at


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> Field:
    """The field fitted on the sample; the sampled ids and features are all that reaches the driver."""
    ids = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_docs)
    )
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = tk.column(batch.column(1))
            out = []
            for i, j in tk.slices(offs):
                _, f, _, at = measure(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                out += [f[at[k] : at[k + 1]].astype(np.uint8).tobytes() if 0 < at[k + 1] - at[k] <= train_lines else None for k in range(j - i)]
            yield pa.record_batch([batch.column(0), batch.column(2).cast(pa.int32()), pa.array(out, pa.binary())], names=["doc_id", "quality", "f"])

    found = picked.mapInArrow(run, "doc_id long, quality int, f binary").where("f is not null")
    rows = sorted((r.doc_id, r.quality, bytes(r.f)) for r in found.groupBy("doc_id", "quality").agg(F.min("f").alias("f")).collect())  # at most one an id
    return Field.fit([np.frombuffer(f, np.uint8).reshape(-1, N_FEATURES).astype(float) for _, _, f in rows], [int(q == 0) for _, q, _ in rows])


def verdict(data: np.ndarray, offs: np.ndarray, field: Field, share: float, caution: float) -> list[np.ndarray]:
    """The columns of ``STATS`` after the first."""
    stats, f, size, at = measure(data, offs)
    content = np.concatenate([[0], np.cumsum(size * (field.decode(f @ field.w + [caution, 0], at) == 0))])
    total = np.concatenate([[0], np.cumsum(size)])
    part = (content[at[1:]] - content[at[:-1]]) / np.maximum(total[at[1:]] - total[at[:-1]], 1)
    failed = (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])
    return [stats[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [part, failed, ~failed & (part >= share)]


def quality(docs: DataFrame, field: Field, share: float = SHARE, caution: float = CAUTION) -> DataFrame:
    """Statistics and verdict of every document. ``caution`` is added to the score of content on every line, for a wrong rejection costs more than a wrong pass."""
    names = ["doc_id", *(x.split()[0] for x in STATS.split(", ")[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = tk.column(batch.column(1))
            for i, j in tk.slices(offs):
                cols = verdict(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], field, share, caution)
                yield pa.record_batch([batch.column(0).slice(i, j - i), *(pa.array(c) for c in cols)], names=names)

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, STATS)


def kept(docs: DataFrame, field: Field, share: float = SHARE, caution: float = CAUTION) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; judged row by row in place, without a join."""

    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        data, offs = tk.column(pa.array(texts, pa.string(), from_pandas=True))
        out = [verdict(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], field, share, caution)[-1] for i, j in tk.slices(offs)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0, bool))

    return docs.where(passes(docs["text"].cast("string")))
