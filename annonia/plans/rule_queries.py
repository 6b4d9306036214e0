"""Text rules over composed rows with several spellings of each rule, and the save job end to end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money, pages, specs
from ..operators import rows, upsert, vocabularies
from ..sources import io
from . import jobs, registry
from .compose import INPUTS, frame

C = F.col


def _cases(n: str, *values: str) -> str:
    """CASE over the remainder of ``n`` by the number of values; values are SQL expressions."""
    return f"CASE {n} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _texts(n: str, *values: str) -> str:
    """As ``_cases`` with plain text, in which ``#`` stands for the number."""
    return _cases(n, *("concat(" + f", CAST({n} AS STRING), ".join(f"'{p}'" for p in v.split("#")) + ", '')" for v in values))


_K = "o_custkey"
INPUTS["rule_rows"] = f"""SELECT o_orderkey AS row_id, {_K} AS k,
 concat({_texts(_K, "10 km|", "", "99 KM THP|")}, {_texts(_K, "2019", "19", "2021", "20211")}, '|', {_texts(_K, "BVM6", "bvm 5", "x", "y", "z")}, '|', {_texts(_K, "Essence", "DIESEL ")}, {_texts(_K, "|THP #", "", "", "")}) AS bullets,
 concat({_texts(_K, "Sur site|", "REMOTE|", "")}, 'Bac +', CAST({_K} % 5 AS STRING), '|', {_texts(_K, "2 ans exp|", "")}, {_texts(_K, "3 postes", "z", "1 Poste")}) AS tags,
 concat({_texts(_K, "Villa", "zz", "appartements")}, '|', {_texts(_K, "Terrain agricole", "qq")}) AS crumbs,
 concat({_texts(_K, "vente", "LOCATION", "cherche achat", "other")}, '|zzz') AS crumb_links,
 {_texts(_K, "Echange", "")} AS crumb, {_texts(_K, "a louer F2", "Vente F#", "Divers")} AS title, concat('x|', {_texts(_K, "Location", "", "", "", "")}) AS chips,
 concat('https://www.example.com', {_texts(_K, "/p/audio/#", "/memoires-#", "/x?page=tV&n=#", "/TV/#", "/none/#")}) AS url,
 {_texts(_K, "Capacité : #.5 L", "capacity #kg, 3 L", "frigo # Litres", "rien")} AS capacity_text,
 {_texts(_K, "Puissance : # KW", "# Watts", "#w 2 kw", "rien")} AS power_text,
 {_texts(_K, "Garantie : # Mois", "warranty # Years", "#", "garantie # ans")} AS warranty_text,
 {_texts(_K, "RAM : # Go", "#GB DDR5, 9 TB SSD", "# TB SSD", "Stockage : # GB", "Capacité: # TB")} AS memory_text,
 concat({_texts(_K, "RAM : # GB|", "")}, {_texts(_K, "CPU : Ryzen # (3.1 GHz)|", "octa-core|", "")}, 'x') AS lines,
 {_texts(_K, "RAM 64 GB, garantie 2 ans, windows 10", "noir, poids 3 kg")} AS whole,
 {_texts(_K, "#", " ", "")} AS table_ram
 FROM {{orders}}"""
INPUTS["rule_urls"] = f"""SELECT o_orderkey AS row_id, {_K} AS k, concat('https://www.example.com/a-', CAST({_K} AS STRING), '-b') AS dashes, concat('https://www.example.com/a/', CAST({_K} AS STRING)) AS last_number,
 concat('https://www.example.com/v?x=1', {_texts(_K, "&id=#&y=2", "&iid=#")}) AS query_id, concat('https://www.example.com/', {_texts(_K, "sku-ab-X#", "usedcar-c-#", "sku-#")}) AS sku,
 concat('https://www.example.com/', {_texts(_K, "job/j#?x=1", "job-apply/#", "jobs/#")}) AS job, concat('https://www.example.com/a/', CAST({_K} AS STRING), {_texts(_K, "/", "")}) AS last_part FROM {{orders}}"""


def _list(name: str) -> Column:
    return F.split(C(name), r"\|")


_N = "CAST(k AS STRING)"
# B15, C6, C8, C9, C26, C27
registry._columns(
    "page_rules",
    "rule_rows",
    "row_id",
    {
        "km": (lambda: pages.classify_bullets(_list("bullets"))["km"], _cases("k", "'10 km'", "''", "'99 KM THP'")),
        "year": (lambda: pages.classify_bullets(_list("bullets"))["year"], _cases("k", "'2019'", "''", "'2021'", "''")),
        "gearbox": (lambda: pages.classify_bullets(_list("bullets"))["gearbox"], _cases("k", "'BVM6'", "'bvm 5'", "''", "''", "''")),
        "fuel": (lambda: pages.classify_bullets(_list("bullets"))["fuel"], _cases("k", "'Essence'", "''")),
        "engine": (lambda: pages.classify_bullets(_list("bullets"))["engine"], _cases("k", f"concat('THP ', {_N})", "''", "''", "''")),
        "contract": (lambda: pages.classify_requirement_tags(_list("tags"))["contract"], _cases("k", "'Sur site'", "'REMOTE'", "''")),
        "diplomas": (lambda: F.array_join(pages.classify_requirement_tags(_list("tags"))["diplomas"], ","), "concat('Bac +', CAST(k % 5 AS STRING))"),
        "experience": (lambda: pages.classify_requirement_tags(_list("tags"))["experience"], _cases("k", "'2 ans exp'", "''")),
        "positions": (lambda: pages.classify_requirement_tags(_list("tags"))["positions"], _cases("k", "'3 postes'", "'1 poste'", "'1 Poste'")),
        "bien": (lambda: pages.breadcrumb_fields(_list("crumbs"), _list("crumb_links"))["bien"], f"CASE WHEN k % 2 = 0 THEN 'Terrain agricole' ELSE {_cases('k', "'Villa'", "''", "'Appartement'")} END"),
        "crumb_transaction": (lambda: pages.breadcrumb_fields(_list("crumbs"), _list("crumb_links"))["transaction"], _cases("k", "'Vente'", "'Location'", "'Cherche-achat'", "''")),
        "transaction": (
            lambda: pages.resolve_transaction(C("crumb"), C("title"), _list("chips")),
            f"CASE WHEN k % 2 = 0 THEN 'Echange' WHEN k % 3 = 0 THEN 'Location' WHEN k % 3 = 1 THEN 'Vente' WHEN k % 5 = 0 THEN 'Location' ELSE 'Non spécifié' END",
        ),
        "category": (lambda: pages.category_from_url(C("url")), _cases("k", "'Audio'", "'Memoires'", "'Tv'", "'Téléviseurs'", "''")),
        "known": (lambda: pages.split_specs(F.create_map(F.lit("a"), C("title"), F.lit("b"), C("crumb"), F.lit("c"), C("url")), {"a": "x", "z": "y"})[0]["x"], "title"),
        "rest": (
            lambda: F.array_join(F.map_keys(pages.split_specs(F.create_map(F.lit("a"), C("title"), F.lit("b"), C("crumb"), F.lit("c"), C("url")), {"a": "x", "z": "y"})[1]), ","),
            _cases("k", "'b,c'", "'c'"),
        ),
    },
)

# G1, G3, G7, G8, G9, G10, G15, G16
registry._columns(
    "figure_rules",
    "rule_rows",
    "row_id",
    {
        "capacity": (lambda: specs.extract_capacity(C("capacity_text"))["value"], _cases("k", f"concat({_N}, '.5')", _N, _N, "''")),
        "capacity_unit": (lambda: specs.extract_capacity(C("capacity_text"))["unit"], _cases("k", "'L'", "'kg'", "'L'", "''")),
        "power": (lambda: specs.extract_power(C("power_text"))["value"], _cases("k", _N, _N, _N, "''")),
        "power_unit": (lambda: specs.extract_power(C("power_text"))["unit"], _cases("k", "'KW'", "'W'", "'W'", "''")),
        "warranty": (lambda: specs.extract_warranty(C("warranty_text"))["value"], _cases("k", _N, _N, "''", _N)),
        "warranty_unit": (lambda: specs.extract_warranty(C("warranty_text"))["unit"], _cases("k", "'mois'", "'ans'", "''", "'ans'")),
        "ram": (lambda: specs.extract_ram(C("memory_text"))["value"], _cases("k", _N, _N, "''", "''", "''")),
        "storage": (lambda: specs.extract_storage(C("memory_text"))["value"], _cases("k", "''", "'9'", _N, _N, _N)),
        "storage_unit": (lambda: specs.extract_storage(C("memory_text"))["unit"], _cases("k", "''", "'TB'", "'TB'", "'GB'", "'TB'")),
        "processor": (lambda: specs.specs_from_lines(_list("lines"), C("whole"))["processor"], _cases("k", f"concat('Ryzen ', {_N}, ' (3.1 GHz)')", "'octa-core'", "''")),
        "line_ram": (lambda: specs.specs_from_lines(_list("lines"), C("whole"))["ram"], _cases("k", _N, "''")),
        "line_warranty": (lambda: specs.specs_from_lines(_list("lines"), C("whole"))["warranty"], _cases("k", "'2'", "''")),
        "line_weight": (lambda: specs.specs_from_lines(_list("lines"), C("whole"))["weight"], _cases("k", "''", "'3'")),
        "line_os": (lambda: specs.specs_from_lines(_list("lines"), C("whole"))["os"], _cases("k", "'Windows'", "''")),
        "override": (lambda: specs.specs_table_override(F.create_map(F.lit("RAM"), C("table_ram")), "RAM", C("whole")), _cases("k", _N, "whole", "whole")),
        "fill": (lambda: specs.specs_table_override(F.create_map(F.lit("RAM"), C("table_ram")), "RAM", C("crumb"), False), f"CASE WHEN k % 2 = 0 THEN 'Echange' WHEN k % 3 = 0 THEN {_N} ELSE '' END"),
    },
)

# B8
registry._columns(
    "url_numbers",
    "rule_urls",
    "row_id",
    {
        "dashes": (lambda: pages.numero_from_url(C("dashes"), "dashes"), _N),
        "last_number": (lambda: pages.numero_from_url(C("last_number"), "last_number"), _N),
        "query_id": (lambda: pages.numero_from_url(C("query_id"), "query_id"), _cases("k", _N, "''")),
        "sku": (lambda: pages.numero_from_url(C("sku"), "sku"), _cases("k", f"concat('X', {_N})", _N, "''")),
        "job": (lambda: pages.numero_from_url(C("job"), "job"), _cases("k", f"concat('j', {_N})", _N, "''")),
        "last_part": (lambda: pages.numero_from_url(C("last_part"), "last_part"), _N),
    },
)


def _half_without_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """listings_raw; every seventh row has no url, and so no id."""
    df = frame(spark, sf_dir, "listings_raw").withColumn("url", F.when(C("row_id") % 7 != 0, C("url")).otherwise(F.when(C("row_id") % 2 == 0, "")))
    return df.withColumns({"doc_id": F.when(C("url") != "", rows.doc_id(C("url"), C("site"), C("category"))), "date_depot": C("date_text")})


_OF = "(SELECT row_id, category, site, date_crawl, date_text, CASE WHEN row_id % 7 <> 0 THEN url END AS url FROM listings_raw)"
_NEWEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY date_crawl DESC, row_id DESC) AS rn FROM {0} WHERE url IS NOT NULL AND {1}) WHERE rn = 1"


# M8, J5, A8: save, routed by category, with dead letters
@registry.query(
    f""", cur AS ({_NEWEST.format(_OF, "row_id % 2 = 0")}), bat AS ({_NEWEST.format(_OF, "row_id % 2 = 1")})
 SELECT coalesce(b.category, c.category) AS category, coalesce(b.row_id, c.row_id) AS row_id, CASE WHEN b.url IS NULL THEN c.date_text WHEN b.site = 'site1' THEN coalesce(NULLIF(c.date_text, ''), b.date_text) ELSE b.date_text END AS date_depot, false AS failed
 FROM cur c FULL JOIN bat b ON b.url = c.url UNION ALL SELECT category, row_id, date_text, true FROM listings_raw WHERE row_id % 7 = 0 AND row_id % 2 = 1""",
    "listings_raw",
)
def saved_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The save job end to end: first dates kept, the state written by category, rows without a url written as dead letters; both read back."""
    df, place = _half_without_url(spark, sf_dir), io.new_folder(spark)
    current = upsert.latest_per_doc(df.where("row_id % 2 = 0 and doc_id is not null"), "doc_id", ["date_crawl"], ["row_id"])
    state, bad = jobs.save_listings(current, df.where("row_id % 2 = 1"), C("site") == "site1")
    upsert.route_to_table(state.select("category", "row_id", "date_depot", "doc_id"), f"{place}/table")
    io.write_dead_letter(bad.select("category", "row_id", "date_depot"), f"{place}/bad")
    saved = spark.read.schema("row_id long, date_depot string, category string").parquet(f"{place}/table")
    failed = spark.read.schema("row_id long, date_depot string, category string").json(f"{place}/bad")
    return saved.withColumn("failed", F.lit(False)).unionByName(failed.withColumn("failed", F.lit(True)))


# J1, J2 with rows that have no id
@registry.query(
    f""", cur AS ({_NEWEST.format(_OF, "row_id % 2 = 0")}), bat AS ({_NEWEST.format(_OF, "row_id % 2 = 1")})
 SELECT row_id FROM bat UNION ALL SELECT row_id FROM cur WHERE url NOT IN (SELECT url FROM bat) UNION ALL SELECT row_id FROM listings_raw WHERE row_id % 7 = 0""",
    "listings_raw",
)
def upserted_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an id are no versions of each other: all stay."""
    df = _half_without_url(spark, sf_dir)
    current = upsert.latest_per_doc(df.where("row_id % 2 = 0"), "doc_id", ["date_crawl"], ["row_id"])
    return upsert.upsert(current, df.where("row_id % 2 = 1")).select("row_id")


INPUTS["open_rows"] = f"""SELECT o_orderkey AS row_id, {_K} AS k, CASE {_K} % 5 WHEN 0 THEN 'immobilier' WHEN 1 THEN 'voiture' WHEN 2 THEN 'emploi' WHEN 3 THEN 'electromenager' ELSE 'multimedia' END AS category,
 {_texts(_K, "#.5", "n/a", "#", "")} AS prix_dec, {_texts(_K, "200", "gone", "404")} AS status, {_K} % 6 AS doors, {_texts(_K, "#", "none")} AS seats,
 {_texts(_K, "Vente par Facilité : 12 000 DA / 10 mois", "1500 DA / mois jusqu''à # mois, 900 DA / mois jusqu''à 36 mois. Premier Versement 5 000 DA", "Vente par facilité: 7#", "Prix : # DA")} AS plan_text,
 {_texts(_K, "Automobile", "Achats", "site word #", "Juridique ", "extra")} AS domaine FROM {{orders}}"""


# C6, I1: all five categories, with what doesn't fit kept apart
@registry.query(
    f""" SELECT category, count(*) AS n, count(*) FILTER (WHERE k % 4 IN (1, 3)) AS bad_prices, count(*) FILTER (WHERE k % 3 = 1) AS bad_status, CAST(sum(CASE k % 4 WHEN 0 THEN k + 0.5 WHEN 2 THEN k ELSE 0 END) AS DOUBLE) AS prices,
 CAST(sum(k % 6) AS BIGINT) AS doors, CAST(sum(CASE WHEN k % 2 = 0 THEN k ELSE 0 END) AS BIGINT) AS seats FROM open_rows GROUP BY category""",
    "open_rows",
)
def open_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns, counts of rejected values, and undeclared fields read from the variant."""
    df = frame(spark, sf_dir, "open_rows")
    parts = [rows.conform_open(df.where(C("category") == c), c) for c in ("immobilier", "voiture", "emploi", "electromenager", "multimedia")]
    same = [p.select("category", "prix_dec", "rejected", "other_information") for p in parts]
    read = lambda path, kind: F.try_variant_get("other_information", path, kind)
    return upsert.union_sites(same).groupBy("category").agg(
        F.count("*").alias("n"),
        F.count_if(F.map_contains_key("rejected", "prix_dec")).alias("bad_prices"),
        F.count_if(F.map_contains_key("rejected", "status")).alias("bad_status"),
        F.coalesce(F.sum("prix_dec"), F.lit(0.0)).alias("prices"),
        F.sum(read("$.doors", "long")).alias("doors"),
        F.coalesce(F.sum(read("$.seats", "long")), F.lit(0)).alias("seats"),
    )


# D8 from text
@registry.query(
    """ SELECT row_id, k % 4 <> 3 AS par_facilite, CASE k % 4 WHEN 0 THEN '10=12000' WHEN 1 THEN concat(CASE WHEN k = 36 THEN '' ELSE concat(CAST(k AS STRING), '=1500,') END, '36=900') ELSE '' END AS plans, k % 4 = 1 AS premier_versement, CAST(CASE WHEN k % 4 = 1 THEN 5000.0 ELSE 0.0 END AS DOUBLE) AS first_sum,
 CAST(CASE k % 4 WHEN 0 THEN 120000.0 WHEN 1 THEN (CASE WHEN k = 36 THEN 1500.0 * 36 ELSE 1500.0 * k END) WHEN 2 THEN CAST(concat('7', CAST(k AS STRING)) AS DOUBLE) ELSE 0.0 END AS DOUBLE) AS total FROM open_rows""",
    "open_rows",
)
def instalment_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instalments of each text, with several plans."""
    got = frame(spark, sf_dir, "open_rows").select("row_id", money.parse_instalments(C("plan_text")).alias("i"))
    plans = F.array_join(F.transform(F.map_entries("i.prix_facilite"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("int").cast("string"))), ",")
    return got.select("row_id", "i.par_facilite", plans.alias("plans"), "i.premier_versement", C("i.premier_versement_value").alias("first_sum"), "i.total")


# E6, E14: vocabulary tables, with an entry of a site's own
@registry.query(
    """ SELECT row_id, CASE k % 5 WHEN 0 THEN 'Achat & Logistique' WHEN 1 THEN 'Own' WHEN 3 THEN 'Juridique' ELSE 'Autre' END AS domain FROM open_rows""",
    "open_rows",
)
def vocabulary_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains from the table; a later version of an entry counts."""
    return vocabularies.translate(frame(spark, sf_dir, "open_rows"), "domaine", _domains(spark), "domain", F.lit("Autre")).select("row_id", "domain")


@registry.query(" SELECT lower(trim(domaine)) AS key, count(*) AS n FROM open_rows WHERE k % 5 IN (2, 4) GROUP BY 1", "open_rows")
def unknown_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that the table lacks, with their numbers of rows."""
    return vocabularies.unknown_keys(frame(spark, sf_dir, "open_rows"), "domaine", _domains(spark))


def _domains(spark: SparkSession) -> DataFrame:
    own = spark.createDataFrame([("domain", "achats", "Own", 1), ("domain", "extra", "Later", 2)], vocabularies.SCHEMA)
    return vocabularies.vocabulary(vocabularies.built_in(spark).unionByName(own), "domain", as_of=1)
