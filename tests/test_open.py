"""Lists as text, instalments, open fields, vocabulary tables, and streaks by event time."""

import json
import random

import pytest
from pyspark.sql import functions as F

from annonia.functions import money, pages
from annonia.operators import metrics, rows, vocabularies
from annonia.sources import io
from annonia.streaming import streams


def test_lists_written_as_text(spark, tmp_path):
    random.seed(7)
    alphabet = ["'", '"', "\\", ",", "[", "]", " ", "a", "\u00e9", "\n", "\t", "\u00a0", "\U0001f600", "x y", ""]
    lists = [["".join(random.choice(alphabet) for _ in range(random.randint(0, 6))) for _ in range(random.randint(0, 5))] for _ in range(300)]
    lists += [["l'eau", "b"], [""], [], ["z" * 50_000, "it's"], ["\\'" * 4_000]]
    for k, write in enumerate((repr, json.dumps, lambda x: json.dumps(x, ensure_ascii=False))):
        df = spark.createDataFrame([(i, write(x)) for i, x in enumerate(lists)], "i int, images string")
        df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{tmp_path}/{k}")
        got = {int(r.i): r.images for r in io.read_listings_csv(spark, f"{tmp_path}/{k}", ["images"]).collect()}
        assert [got[i] for i in range(len(lists))] == lists
    odd = spark.createDataFrame([(None,), ("",), ("no list",), ("[1, 2.5, None]",), ("['open",)], "t string")
    assert [r[0] for r in odd.select(pages.list_items(F.col("t"))).collect()][:4] == [[], [], [], ["1", "2.5", "None"]]


def test_instalments_in_text(spark):
    texts = ["2 500 DA / mois jusqu'\u00e0 12 mois et 1300DA/mois jusqu'\u00e0 24 mois", "VENTE PAR FACILIT\u00c9 : 3\u00a0000 DA / 6 mois Premier Versement : 9 000", "Vente par Facilit\u00e9 : 800", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.i for r in df.select(money.parse_instalments(F.col("t")).alias("i")).collect()]
    assert [(i.par_facilite, i.prix_facilite, i.premier_versement_value, i.total) for i in got] == [
        (True, {"12": 2500.0, "24": 1300.0}, 0.0, 30_000.0), (True, {"6": 3000.0}, 9000.0, 18_000.0), (True, {}, 0.0, 800.0), (False, {}, 0.0, 0.0), (False, {}, 0.0, 0.0),
    ]


def test_open_fields(spark):
    df = spark.createDataFrame([("u", "12.5", "x", 3, {"hu": "yes"}), ("v", "dear", None, None, None)], "url string, prix_dec string, status string, doors int, specs map<string,string>")
    got = rows.conform_open(df, "voiture").select("url", "prix_dec", "status", "rejected", F.try_variant_get("other_information", "$.doors", "int").alias("doors"), F.try_variant_get("other_information", "$.specs.hu", "string").alias("hu"), F.try_variant_get("other_information", "$.specs.hu", "int").alias("no")).collect()
    assert [tuple(r) for r in got] == [("u", 12.5, None, {"status": "x"}, 3, "yes", None), ("v", None, None, {"prix_dec": "dear"}, None, None, None)]
    assert rows.conform_open(df.select("url"), "emploi").select("rejected").first()[0] == {}


def test_vocabulary_tables(spark):
    own = spark.createDataFrame([("city", " Oran ", "Wahran", 3), ("city", "blida", None, 2), ("city", "new", "b", 1), ("city", "new", "a", 1), ("city", None, "x", 9)], vocabularies.SCHEMA)
    entries = vocabularies.built_in(spark).unionByName(own)
    df = spark.createDataFrame([(1, "ORAN", "k"), (2, "Blida", "k"), (3, " new", "k"), (4, None, "k"), (5, "zz", "k"), (5, "zz", "k")], "i int, city string, key string")
    got = vocabularies.translate(df, "city", vocabularies.vocabulary(entries, "city"), "value", F.lit("?"))
    assert sorted((r.i, r.value, r.key) for r in got.collect()) == [(1, "Wahran", "k"), (2, "?", "k"), (3, "a", "k"), (4, "?", "k"), (5, "?", "k"), (5, "?", "k")]
    old = vocabularies.vocabulary(entries, "city", as_of=0)
    assert {r.key: r.n for r in vocabularies.unknown_keys(df, "city", old).collect()} == {"new": 1, "zz": 2}


@pytest.mark.parametrize("files", [1, 3])
def test_streaks_by_event_time(spark, tmp_path, files):
    """Events that come up to the delay late are counted in their place; one that comes later is kept apart."""
    r = random.Random(8)
    schema = "event_id long, ts timestamp, category string, kind string"
    events = [(i, 1_700_000_000 + 60 * i, r.choice("ab"), "error" if r.random() < 0.7 else r.choice(["success", "block"])) for i in range(250)]
    arriving = sorted(events, key=lambda e: e[1] + r.randrange(1_200))
    made = lambda rows: spark.createDataFrame(rows, "event_id long, s long, category string, kind string").select("event_id", F.timestamp_seconds("s").alias("ts"), "category", "kind")
    step = -(-len(arriving) // files)
    for k in range(files):
        made(arriving[k * step : (k + 1) * step]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        streams.stream_alerts(stream, f"{tmp_path}/t", f"{tmp_path}/log", errors=3, blocks=4, every=5, delay=1_200).awaitTermination()
        return sorted(map(tuple, streams.read_alerts(spark, f"{tmp_path}/t", errors=3, blocks=4, every=5).select("category", "event_id", "kind", "reached").collect()))

    want = sorted(map(tuple, metrics.alerts(made(events), 3, 4, every=5).select("category", "event_id", "kind", "reached").collect()))
    assert run() == want and len(want) > 30
    made([(9_999, events[0][1], "a", "success")]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == want
    late = spark.read.schema("event_id long").parquet(f"{tmp_path}/t/late/batch={files}")
    assert [x.event_id for x in late.collect()] == [9_999]
