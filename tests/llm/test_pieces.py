"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from annonia.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return pieces.Model(f.read())


ODD = [
    (1, None), (2, ""), (3, " "), (4, "   \n "), (5, "a"), (6, " leading and  double   blanks "), (7, "\u2581a\u2581\u2581b"), (8, "<s> </s> <unk> <0x41>"),
    (9, "\u4e2d\u6587 \U0001f600\x00\u0301"), (10, "x" * 30_000), (11, " " * 5_000), (12, "ab " * 40_000), (12, "ab " * 40_000), (None, "no id"), (13, "=" * 3_000 + "\u3000" + "the" * 2_000),
]


def test_table_against_library(spark, library):
    rows = spark.createDataFrame([(i, t, 7, b"x") for i, t in ODD], "doc_id long, text string, n_tokens int, ids binary").repartition(3)
    got = sorted((repr(r.doc_id), r.n_tokens, r.ids, r.ids_sha256, r.decoded_sha256) for r in pieces.encode_decode(rows, PATH).collect())
    want = []
    for i, t in ODD:
        ids = library.encode(t or "")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want.append((repr(i), len(ids), np.array(ids, np.uint32).tobytes(), *digests))
    assert got == sorted(want)
    assert pieces.encode_decode(rows.limit(0), PATH).count() == 0


def test_documents_against_library(spark, library):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.encode_decode(docs, PATH, with_ids=False).collect()}
    assert len(got) == docs.count()
    for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect():
        ids = library.encode(r.text)
        assert got[r.doc_id] == (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))))


def test_random_chunks_and_ids(model, library):
    random.seed(5)
    letters = ["a", "b", "th", "in", "e", "\n", "\u00e9", "\u4e2d", "\U0001f600", "=", "==", "1", "<0x41>", "\u0301", "the", "\t"]
    for n in [*range(1, 60), 300, 2_000] * 5:
        text = "".join(random.choice(letters) for _ in range(n))
        assert model.segment(pieces.MARK + text) == library.encode(text)
        assert model._merged(text) == model._merged_long(text)
        ids = [random.randrange(32_000) if k % 2 else random.randrange(262) for k in range(9)]
        assert model.decode(ids) == library.decode(ids)


def test_each_distinct_chunk_is_segmented_once(model, monkeypatch):
    import pyarrow as pa

    chunks, first = pieces._chunks(pa.array(["a b", None, "", "b  a b", " b"]))
    assert [c.decode() for c in chunks.to_pylist()] == [" a", " b", " b", "  a", " b", "  b"] and first.tolist() == [0, 2, 2, 2, 5, 6]


def test_table_that_overflows_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(pieces, "CHUNKS", 2)
    words = [f" w{i % 7}".encode() for i in range(50)]
    assert [model.entry(w)[0] for w in words] == [len(model.segment(w.decode().replace(" ", pieces.MARK))) for w in words] and len(model.table) <= 2


def test_refused_models():
    def field(number, value):
        return bytes([number << 3]) + bytes([value]) if isinstance(value, int) else bytes([number << 3 | 2, len(value)]) + value

    piece = field(1, field(1, b"a\xe2\x96\x81b"))
    spec = field(2, field(3, 2))
    with pytest.raises(ValueError, match="cross a marker"):
        pieces.Model(piece + spec)
