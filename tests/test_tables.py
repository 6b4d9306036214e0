"""Readers and writers, upsert properties, html parsing."""

from pyspark.sql import functions as F

from annonia import schemas
from annonia.operators import frontier, metrics, rows, upsert
from annonia.sources import html, io


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("t1", "https://x/1", "voiture", "s1", ["a", "b"]), ("t, \"2\"\nx", "https://x/2", "emploi", "s2", [])], "titre string, url string, category string, site string, images array<string>")
    io.write_jsonl(df, f"{tmp_path}/j")
    io.write_jsonl(df, f"{tmp_path}/j")
    back = io.read_listings_jsonl(spark, f"{tmp_path}/j", "voiture")
    assert [r._corrupt_record for r in back.select("titre", "_corrupt_record").collect()] == [None] * 4
    io.write_by_category_site(df, f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").where("category = 'emploi' and site = 's2'").count() == 1
    io.write_csv(df, f"{tmp_path}/c", ["titre", "images"])
    csv = io.read_listings_csv(spark, f"{tmp_path}/c", ["images"])
    assert {(r.titre, tuple(r.images)) for r in csv.collect()} == {("t1", ("a", "b")), ('t, "2"\nx', ())}


def test_corrupt_and_multiline(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"titre": "x"}\nnot json\n')
    got = io.read_listings_jsonl(spark, f"{tmp_path}/a.json", "emploi").select("titre", "_corrupt_record").collect()
    assert [(r.titre, r._corrupt_record) for r in got] == [("x", None), (None, "not json")]
    (tmp_path / "b.json").write_text('[\n {"titre": "x",\n "prix_dec": 2.5}, {"titre": "y"}]')
    assert [r.prix_dec for r in io.read_listings_json(spark, f"{tmp_path}/b.json", "voiture").collect()] == [2.5, None]


def test_log_events_and_failed(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"timestamp": "t", "level": "INFO", "category": "emploi", "site": "s"}\n{"level": "ERROR", "category": "emploi", "site": "s"}\n')
    counts = metrics.scrape_log_counts(io.read_log_events(spark, f"{tmp_path}/l.json")).first()
    assert (counts.ok, counts.failed) == (1, 1)
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, t string")
    good, bad = io.split_failed(df, F.col("t") != "")
    assert (good.count(), bad.count()) == (1, 1)
    io.write_dead_letter(bad, f"{tmp_path}/dead")
    assert spark.read.json(f"{tmp_path}/dead").count() == 1


def test_log_text(spark):
    df = spark.createDataFrame([("[2026-01-02 03:04:05] [ERROR] [core] it broke",), ("plain",)], "value string")
    a, b = io.parse_log_text(df).collect()
    assert (str(a.ts), a.level, a.logger, a.message) == ("2026-01-02 03:04:05", "ERROR", "core", "it broke")
    assert (b.ts, b.level, b.message) == (None, None, "plain")


def test_conform(spark):
    df = spark.createDataFrame([("x", "extra")], "titre string, other string")
    for c in schemas.FIELDS:
        out = rows.conform(df, c)
        assert out.schema.fieldNames() == schemas.schema(c).fieldNames()
        assert out.first().images == []


def test_upsert_is_idempotent(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 2, "y"), ("b", 3, 1, None)], "doc_id string, row_id int, date_crawl int, date_depot string")
    once = upsert.upsert(df.limit(0), df, tie=["row_id"])
    twice = upsert.upsert(once, df, tie=["row_id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 2, 2, "y"), ("b", 3, 1, None)]


def test_keep_first_date(spark):
    old = spark.createDataFrame([("a", 1, 1, "first"), ("b", 2, 1, "")], "doc_id string, row_id int, date_crawl int, date_depot string")
    new = spark.createDataFrame([("a", 3, 2, "second"), ("b", 4, 2, "later"), ("c", 5, 2, "new")], "doc_id string, row_id int, date_crawl int, date_depot string")
    out = upsert.upsert_keep_first_date(old, new, F.lit(True), tie=["row_id"])
    assert sorted((r.doc_id, r.row_id, r.date_depot) for r in out.collect()) == [("a", 3, "first"), ("b", 4, "later"), ("c", 5, "new")]


def test_new_plus_seen_is_frontier(spark):
    front = spark.createDataFrame([("1",), ("2",), (None,)], "listing_id string")
    seen = spark.createDataFrame([("2",)], "listing_id string")
    new = frontier.new_listings(front, seen)
    assert [r.listing_id for r in new.collect()] == ["1"]
    assert sorted(r.listing_id for r in frontier.extend_seen(seen, new).collect()) == ["1", "2"]


def test_streak_alert_resets(spark):
    kinds = ["error"] * 9 + ["success"] + ["error"] * 10
    df = spark.createDataFrame([(i, 1000 * i, "c", k) for i, k in enumerate(kinds)], "event_id int, t long, category string, kind string").withColumn("ts", F.timestamp_seconds("t"))
    assert [r.event_id for r in metrics.error_streaks(df).where("alert").collect()] == [len(kinds) - 1]


def test_parse_pages(spark):
    doc = "<title>T</title><table><tr><td>Prix</td><td>5</td></tr><tr><td>Prix</td><td>6</td></tr></table><dl><dt>Km</dt><dd>7</dd></dl><p class='a b'>x <b>y</b></p><img src='i.png'><a href='/l'>z"
    df = spark.createDataFrame([(1, "u", doc), (2, "v", None), (3, "w", "")], "page_id long, url string, html string")
    p = html.parse_pages(df).select("*", html.spec_map(F.col("pairs")).alias("m"), html.extract_text(F.col("elements"), "p", "b").alias("t")).orderBy("page_id").collect()
    assert (p[0].title, p[0].links, p[0].images, p[0].m, p[0].t) == ("T", ["/l"], ["i.png"], {"Prix": "6", "Km": "7"}, "x y")
    assert (p[1].title, p[1].links, p[2].m, p[2].t) == ("", [], {}, "")


def test_vehicles_of_three_model_years(spark):
    from annonia.plans import jobs

    cars = spark.createDataFrame([(y, "Essence", "MT", "10 000 km", f"1.6 TSI {y}") for y in range(2014, 2027)], "id int, energie_text string, boite string, km_text string, moteur_text string")
    kept = jobs.normalize_vehicles(cars, F.lit("2026-01-15").cast("date"))
    assert sorted(r.id for r in kept.collect()) == [2023, 2024, 2025, 2026]
