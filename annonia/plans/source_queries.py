"""Queries that write the composed inputs in each format, read them back and use the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pages
from ..operators import metrics, rows
from ..sources import html, io
from . import registry
from .compose import frame
from .registry import C, query

_LISTING = "row_id long, url string, category string, prix_text string"


# A2, A5
@query(
    """ SELECT row_id, url, prix_text, CAST(NULL AS VARCHAR) AS broken FROM listings_raw
 UNION ALL SELECT NULL, NULL, NULL, concat('{broken ', CAST(row_id AS STRING)) FROM listings_raw WHERE row_id % 97 = 0""",
    "listings_raw",
)
def listings_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines appended in two batches, among lines that don't parse."""
    df, place = frame(spark, sf_dir, "listings_raw"), io.new_folder(spark)
    for part in (0, 1):
        io.write_jsonl(df.where(C("row_id") % 2 == part).select("row_id", "url", "category", "prix_text"), place)
    df.where("row_id % 97 = 0").select(F.concat(F.lit("{broken "), C("row_id").cast("string")).alias("value")).write.mode("append").text(place)
    return io.read_listings_jsonl(spark, place, _LISTING).select("row_id", "url", "prix_text", C("_corrupt_record").alias("broken"))


# A3
@query(" SELECT row_id, url, prix_text FROM listings_raw", "listings_raw")
def listings_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pretty-printed array of up to 1,000 listings a file."""
    df, place = frame(spark, sf_dir, "listings_raw"), io.new_folder(spark)
    whole = F.to_json(F.collect_list(F.struct("row_id", "url", "category", "prix_text")), {"pretty": "true"})
    arrays = df.groupBy(F.floor(C("row_id") / 1000).alias("part")).agg(whole.alias("value"))
    arrays.write.partitionBy("part").text(place)
    return io.read_listings_json(spark, place, _LISTING).select("row_id", "url", "prix_text")


# A4, A7
@query(" SELECT row_id, prix_text, concat('say \"', site, '\",', chr(10), category) AS note, concat(site, '.jpg|', category, '.png') AS images FROM listings_raw", "listings_raw")
def listings_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with quotes, commas and line breaks in fields, and lists as text."""
    df, place = frame(spark, sf_dir, "listings_raw"), io.new_folder(spark)
    note = F.concat(F.lit('say "'), C("site"), F.lit('",\n'), C("category"))
    images = F.array(F.concat(C("site"), F.lit(".jpg")), F.concat(C("category"), F.lit(".png")))
    io.write_csv(df.withColumns({"note": note, "images": images}), place, ["row_id", "prix_text", "note", "images"])
    back = io.read_listings_csv(spark, place, ["images"])
    return back.select(C("row_id").cast("long").alias("row_id"), "prix_text", "note", F.array_join("images", "|").alias("images"))


# A6, J5
@query(" SELECT category, site, count(*) AS n, CAST(sum(row_id) AS BIGINT) AS ids FROM listings_raw GROUP BY category, site", "listings_raw")
def routed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory for each category and site; reads of one category open no other."""
    df, place = frame(spark, sf_dir, "listings_raw"), io.new_folder(spark)
    io.write_by_category_site(df.select("row_id", "url", "category", "site"), place)
    return spark.read.parquet(place).groupBy("category", "site").agg(F.count("*").alias("n"), F.sum("row_id").alias("ids"))


# A8
@query(" SELECT row_id, category, prix_text FROM listings_raw WHERE prix_text = '' OR prix_text = 'Prix sur demande'", "listings_raw")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings without an amount, on their own path."""
    df, place = frame(spark, sf_dir, "listings_raw"), io.new_folder(spark)
    _, bad = io.split_failed(df.select("row_id", "url", "category", "prix_text"), C("prix_text").rlike("[0-9]"))
    io.write_dead_letter(bad, place)
    return spark.read.schema(_LISTING).json(place).select("row_id", "category", "prix_text")


# A9
@query(registry.ORACLE["log_counts"])
def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as JSON lines, read back and counted."""
    place = io.new_folder(spark)
    level = F.when(C("kind") == "success", "INFO").when(C("kind") == "error", "ERROR").otherwise("WARNING").alias("level")
    io.write_jsonl(frame(spark, sf_dir, "run_events").select(C("ts").cast("string").alias("timestamp"), level, "category", "site"), place)
    return metrics.scrape_log_counts(io.read_log_events(spark, place))


# C1, C3, C5
@query(
    """ SELECT o_orderkey AS page_id, concat('Annonce ', CAST(o_custkey AS STRING)) AS title, o_orderstatus AS marque, concat(CAST(o_custkey % 300 AS STRING), ' 000') AS km,
 CAST(year(o_orderdate) AS STRING) AS mise, concat('Prix ', CAST(o_custkey AS STRING), ' DA') AS lead FROM orders"""
)
def spec_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label/value rows of tables and lists as a map; the last of equal labels counts."""
    p = html.parse_pages(frame(spark, sf_dir, "spec_pages", wide=True), "title", "elements", "strings", "pairs")
    specs = p.select("page_id", "title", html.extract_text(C("elements"), "p", "lead").alias("lead"), F.transform_keys(html.spec_map(C("pairs")), lambda k, _: pages.normalize_spec_key(k)).alias("m"))
    return specs.select("page_id", "title", C("m")["marque"].alias("marque"), C("m")["km"].alias("km"), C("m")["date_mise"].alias("mise"), "lead")


# I2
@query(
    f""" SELECT row_id, concat('Bmw Serie ', upper(substr(site, 1, 1)), substr(site, 2)) AS titre, 2000 + CAST(row_id % 20 AS INTEGER) AS annee, CAST(concat(CAST(row_id % 300 AS STRING), '000') AS INTEGER) AS km,
 CASE WHEN prix_unit = 'EUR' THEN 'true' ELSE 'false' END AS export, CASE row_id % 2 WHEN 0 THEN 'Manuelle' ELSE 'Automatique' END AS transmission, {registry.ORACLE["prices"].split(" AS display, ")[1].split(" AS unit, ")[1].split(" AS vehicle")[0]} AS prix_dec FROM listings_raw""",
    "listings_raw",
)
def unified_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw vehicle texts in the standard form."""
    raw = frame(spark, sf_dir, "listings_raw").select(
        "row_id",
        F.concat(F.lit("bmw SERIE "), C("site")).alias("titre"),
        F.lit("bmw").alias("marque"),
        F.lit("x").alias("model"),
        F.concat(F.lit("mise en circulation "), (2000 + C("row_id") % 20).cast("string")).alias("annee"),
        F.concat((C("row_id") % 300).cast("string"), F.lit(" 000 km")).alias("km"),
        C("prix_text").alias("prix"),
        "prix_unit",
        C("energie_text").alias("energie"),
        F.when(C("row_id") % 2 == 0, "MT").otherwise("dct").alias("transmission"),
    )
    return rows.unify_vehicle(raw).select("row_id", "titre", "annee", "km", "export", "transmission", "prix_dec")


# I12
@query(
    """ SELECT row_id, concat('Poste ', domaine) AS titre, concat('https://jobs.example.com/', CAST(row_id AS STRING)) AS url, strftime(d, '%Y-%m-%dT00:00:00') AS date_depot, regexp_replace(regexp_extract(salaire_text, '(\\d[\\d\\s]*)DA', 1), '\\s', '', 'g') AS prix, 'Avec prix' AS as_prix FROM words""",
    "words",
)
def job_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw job pages as records."""
    raw = frame(spark, sf_dir, "words").select(
        "row_id", F.concat(F.lit("<b>Poste</b> "), C("domaine")).alias("title"), F.concat(F.lit("https://jobs.example.com/"), C("row_id").cast("string")).alias("url"), C("titre").alias("description"), C("diplome").alias("diploma"), F.date_format("d", "dd/MM/yyyy").alias("posted"), C("salaire_text").alias("salary")
    )
    made = rows.format_job_record(raw)
    return made.select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("row_id"), "titre", "url", "date_depot", "prix", "as_prix")
