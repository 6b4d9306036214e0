"""Secrets around and between compressed data, and labels of any length."""

import base64
import bz2
import gzip
import zlib

import pytest

from annonia.llm import secrets, urls

SECRET = "password=Tr0ub4dor-and-3-more"
GZ, ZLIB = gzip.compress(SECRET.encode()), zlib.compress(SECRET.encode())
HIDDEN = gzip.compress(b"nothing to see here, just words and words")


@pytest.mark.parametrize(
    "raw",
    [
        (SECRET + " ").encode() + HIDDEN,
        HIDDEN + SECRET.encode(),
        HIDDEN + b"\x00\x01 between \xff" + GZ,
        GZ + b" between " + HIDDEN,
        b"\x1f\x8b\x08 no data \x00\x01" + GZ,
        b"\x78\x01\x02 false " + GZ,
        b"\x00\x01head " + ZLIB,
        HIDDEN + b" x " + SECRET.encode() + b" y " + bz2.compress(b"other words"),
        gzip.compress(bz2.compress(zlib.compress(SECRET.encode()))),
        gzip.compress(gzip.compress(b"z" * 3_000_000 + b" " + SECRET.encode() + b" " + b"y" * 3_000_000)),
    ],
)
def test_text_around_compressed_data(spark, raw):
    text = "k " + base64.b64encode(raw).decode() + " z"
    row = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert "assign:" in row.spans
    masked = secrets.mask_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
    assert len(masked) == len(text) and masked != text


def plain(label, counts, total):
    import math

    best = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        best.append(min((best[b][0] + (math.log(total + 1) - math.log(counts[label[b:end]]) if label[b:end] in counts else math.log(total + 1) + (end - b) * math.log(10)), b) for b in range(end)))
    out, end = [], len(label)
    while end:
        out.append(label[best[end][1] : end])
        end = best[end][1]
    return out[::-1]


def test_splits_against_plain_viterbi(spark):
    import random

    r = random.Random(9)
    counts = {"".join(r.choice("abc") for _ in range(r.randint(1, 5))): r.randint(1, 30) for _ in range(60)}
    labels = ["".join(r.choice("abcd") for _ in range(r.randint(1, 40))) for _ in range(80)]
    got = urls.segment(spark.createDataFrame([(x,) for x in labels], "label string"), spark.createDataFrame(list(counts.items()), "piece string, n long")).collect()
    total = sum(counts.values())
    assert {x.label: x.pieces for x in got} == {x: plain(x, counts, total) for x in labels}


def test_labels_of_20_000_letters(spark):
    """A host label and a word of 20,000 letters, in pages whose other words have many lengths."""
    long = "ab" * 10_000
    words = " ".join("c" * k for k in range(1, 12))
    pages = [(1, f"http://{long}.net/es/x", f"<p>{long} {words}</p>"), (2, f"http://{long}.org/", words), (3, "http://cc.example.com/en/", words)]
    got = {x.page_id: x.verdict for x in urls.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[1] == "block" and got[3] == "block" and got[2] in ("allow", "block")
