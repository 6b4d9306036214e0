"""The registered queries as they are, and the pipeline's stages on awkward rows."""

import collections
import glob
import math
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from annonia.llm import queries, urls

DIR = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_chat": ("conversations", "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars"),
    "op2_minhash": ("documents", "doc_id n_shingles component_id kept"),
    "op3_urls": ("pages", "page_id host path rule verdict"),
    "op4_bpe": ("documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op5_secrets": ("documents", "doc_id n_assign n_access n_hex base_sha256 spans"),
    "op6_quality": ("documents", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"),
    "op7_suffix_tree": ("documents", "doc_id held_out n_tokens n_known train_tokens base_score score"),
    "op8_sharding": ("documents", "doc_id size text_crc32 law shard slot grown_shard"),
    "op9_decontaminate": (None, "doc_id item_id"),
    "op11_prefix_trie": (None, "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"),
    "op12_repair": ("conversations", "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256"),
    "op13_sentencepiece": ("documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op10_repeats": ("documents", "doc_id n_bytes n_removed n_spans kept_sha256"),
}


@pytest.mark.parametrize("name", list(CONTRACT))
def test_query(spark, name):
    source, columns = CONTRACT[name]
    out = queries.QUERIES[name](spark, DIR)
    assert set(columns.split()) <= set(out.columns)
    n = out.count()
    table = spark.read.parquet(f"{DIR}/{source}.parquet") if source else None
    if source == "conversations":
        assert n == table.select("conv_id").distinct().count() + (name == "op1_chat")
    else:
        assert n == table.count() if source else n > 0


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    out = queries.QUERIES[name](spark, DIR)
    want = con.sql(queries.ORACLE[name])
    assert sorted(out.columns) == sorted(want.columns)
    assert sorted(map(tuple, out.select(want.columns).collect())) == sorted(want.fetchall())


def test_naive_bayes_against_plain_counting(spark):
    """Scores of the urls that no rule fits, from the tokens of those that one does; hosts and paths that many pages share."""
    texts = ["redhouse", "bluehouse", "redboat", "boat", "housered", "zzz"]
    rows = []
    for i in range(90):
        host = f"{texts[i % 6]}.{('com', 'net', 'org')[i % 3]}"
        path = ("/es/red", "/fr/boat", "/en/house", "/", "/red-red/house")[i % 5]
        rows.append((i, f"http://{host}{path}?q={i}", "<p>red house blue boat</p>"))
    rows += [(100 + i, "http://redhouse.org/red/boat", "") for i in range(40)] + [(200, "http://zzz.org/", None), (201, None, "<p>x</p>"), (202, f"http://{'redboat' * 40}.org/{'red/' * 500}", "")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, score int").repartition(3)
    split = {}
    real = urls.segment

    def seen(labels, counts):
        out = real(labels, counts)
        split.update({r.label: r.pieces for r in out.collect()})
        return out

    urls.segment = seen
    try:
        got = {r.page_id: r for r in urls.judge(df).collect()}
    finally:
        urls.segment = real
    tokens = {}
    for i, r in got.items():
        words = [f"h:{p}" for label in re.split(r"[^a-z0-9]+", r.host) if label for p in split[label]]
        tokens[i] = collections.Counter(words + [f"p:{w}" for w in re.findall(r"[a-z]+", r.path)])
    counts = {"allow": collections.Counter(), "block": collections.Counter()}
    pages = collections.Counter(r.verdict for r in got.values() if r.rule)
    for i, r in got.items():
        if r.rule:
            counts[r.verdict].update(tokens[i])
    vocabulary = set(counts["allow"]) | set(counts["block"])
    size = {c: n.total() + len(vocabulary) + 1 for c, n in counts.items()}
    judged = 0
    for i, r in got.items():
        if r.rule is None:
            odds = math.log(pages["block"] / pages["allow"])
            odds += sum(k * (math.log((counts["block"][t] + 1) / size["block"]) - math.log((counts["allow"][t] + 1) / size["allow"])) for t, k in tokens[i].items() if t in vocabulary)
            assert math.isclose(r.score, odds, abs_tol=1e-6) and r.verdict == ("block" if round(odds, 9) > 0 else "allow"), r
            judged += 1
    assert judged > 60 and pages["block"] > 5 and pages["allow"] > 5


def test_stages_take_awkward_rows(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    long = "".join(f"Word{k} is{k} here{k}, and so it goes{k}." + (" " if k % 9 else "\n") for k in range(60_000))
    odd = [(-1, None), (-2, ""), (-3, long), (-3, long), (None, "short"), (-4, " \n\t")]
    rows = spark.createDataFrame([(i, t, None, "kept", 1, "clash") for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long, label string")
    docs = docs.withColumn("label", F.lit("clash")).unionByName(rows.select("doc_id", "text", "lang", "source", F.col("n_chars").cast(docs.schema["n_chars"].dataType), "label"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DIR)
        assert out.columns == docs.columns, name
        before, after = (collections.Counter(map(tuple, x.collect())) for x in (docs, out))
        assert after <= before or name == "secret scans", name
        ids = [r[0] for r in after.elements() if (r[0] or 0) < 0]
        assert ids.count(-3) == (2 if name == "quality rules" else 1), name
        docs = out
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DIR).count() == 0
