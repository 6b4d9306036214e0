"""The pipeline, each stage on its own input against brute force."""

import collections
import hashlib
import re

import pyarrow as pa
import pytest

from annonia.llm import quality, queries
from annonia.llm import textkit as tk

corpus_pipeline = pytest.importorskip("corpus_pipeline")
DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return WORD.findall((text or "").translate(AZ))


def runs(seq, size):
    return [tuple(seq[k : k + size]) for k in range(max(1, len(seq) - size + 1))] if seq else []


def table(spark, name):
    return spark.read.parquet(f"{DIR}/{name}.parquet")


def passes(text, field):
    """The base rules by counting words, and the line model by a plain Viterbi over the text's lines."""
    w = WORD.findall(text or "")
    three = collections.Counter(zip(w, w[1:], w[2:]))
    repeated = {k + j for k, g in enumerate(zip(w, w[1:], w[2:])) if three[g] > 1 for j in range(3)}
    if len(w) < 50 or 100 * len(repeated) > 50 * len(w):
        return False
    _, f, size, _ = quality.measure(*tk.column(pa.array([text])))
    best = []
    for k, scores in enumerate((f @ field.w + [quality.CAUTION, 0]).tolist()):
        before = best[-1] if k else [(0.0, [])] * 2
        best.append([max(((before[x][0] + (field.t[x, y] if k else 0) + scores[y], before[x][1] + [y]) for x in (0, 1)), key=lambda p: p[0]) for y in (0, 1)])
    states = max(best[-1], key=lambda p: p[0])[1]
    return sum(int(n) for n, s in zip(size, states) if s == 0) / int(size.sum()) >= quality.SHARE


def one_of_each_group(texts):
    """Ids that are the smallest of what is linked with them, over all pairs."""
    sets = {i: frozenset(runs(words(t), 5)) for i, t in texts.items()}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {i for i in sets if top(i) == i}


def holds(seq, item):
    """Whether a window as long as the item has a weighted similarity of 0.75 with it; windows slide by one word."""
    size = min(len(item), 5)
    own, n = collections.Counter(runs(item, size)), min(len(item), len(seq))
    of_text = runs(seq, min(size, len(seq)))
    if not n or not own.keys() & set(of_text):
        return False
    width = max(1, n - size + 1)
    inside, both = collections.Counter(), 0
    for k, g in enumerate(of_text):
        inside[g] += 1
        both += inside[g] <= own[g]
        if k >= width:
            gone = of_text[k - width]
            both -= inside[gone] <= own[gone]
            inside[gone] -= 1
        if k >= width - 1 and 100 * both >= 75 * (width + own.total() - both):
            return True
    return False


def test_stages(spark):
    docs = table(spark, "documents")
    columns = docs.columns
    field = quality.train(docs, table(spark, "labels"))
    items = [words(r.text) for r in table(spark, "benchmark").collect()]
    gone = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, DIR)
        assert out.columns == columns, name
        after = {r.doc_id: r.text for r in out.collect()}
        assert set(after) <= set(before) and len(after) == out.count()
        gone[name] = len(before) - len(after)
        if name == "secret scans":
            assert set(after) == set(before) and all(len(after[i]) == len(before[i]) for i in after)
            assert not any(re.search(r"AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}", t) for t in after.values())
        else:
            assert all(after[i] == before[i] for i in after)
        if name == "quality rules":
            assert set(after) == {i for i, t in before.items() if passes(t, field)}
        if name == "MinHash near-dedup":
            assert set(after) == one_of_each_group(before)
        if name == "benchmark decontamination":
            assert set(after) == {i for i, t in before.items() if not any(holds(words(t), item) for item in items)}
        docs = out
    assert all(gone[name] for name in ("quality rules", "MinHash near-dedup", "benchmark decontamination")), gone
    last = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, DIR).collect()}
    assert set(last) == set(after)
    import tiktoken

    from annonia.llm import bpe

    path, pattern = queries.tokenizer_path()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.Encoder(bpe.read_ranks(path), pattern).ids, special_tokens={})
    for i, text in after.items():
        ids = library.encode_ordinary(text)
        assert last[i].n_tokens == len(ids) and last[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert last[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_clean_labelled_documents_stay(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    kept = corpus_pipeline.quality_rules(spark, docs, DIR).select("doc_id")
    good = quality.quality(docs, quality.Field.blank()).where("not base_failed").join(labels.where("quality = 1"), "doc_id")
    assert good.join(kept, "doc_id", "left_anti").count() <= 0.02 * good.count()
