"""Whole records: the jobs with all the columns that their tables offer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import details
from ..sources import html
from . import jobs
from .compose import INPUTS, frame
from .registry import AS_OF, C, query
from .rule_queries import _texts

_K = "o_custkey"
INPUTS["record_rows"] = f"""SELECT o_orderkey AS row_id, {_K} AS k, {_texts(_K, "Vente F3", "Divers", "Poste de chef de cuisine", "Recherche comptable")} AS titre,
 {_texts(_K, "Villa|zz", "zz|Studio", "zz")} AS crumbs, {_texts(_K, "x|vente", "location|y", "z")} AS crumb_links, {_texts(_K, "louer", "")} AS chips,
 {_texts(_K, "02/03/2024 10:20:30", "2024-05-06", "soon")} AS date_text, {_texts(_K, "http://i.example.com/a-300x300.jpg|https://i.example.com/a.jpg|https://i.example.com/logo.png", "data:x|", "https://i.example.com/b.png|https://i.example.com/b.jpg")} AS images,
 {_texts(_K, "1 200,5", "3.000.000", "45000 DA", "")} AS prix_text, {_texts(_K, "Millions", "DA", "EUR")} AS prix_unit, {_texts(_K, "billet noir", "bon etat")} AS description,
 {_texts(_K, "Automobile", "Inconnu")} AS domaine, {_texts(_K, "Licence", "")} AS diplome, {_texts(_K, "de 40 000 - 60 000 DA net", "salaire 30 000 DA", "a discuter")} AS salaire_text,
 {_texts(_K, "1 a 3 ans", "Chef", "autre")} AS experience, {_texts(_K, "remote", "CDD", "")} AS contrat, {_texts(_K, "hassi messaoud", "ville #", "")} AS city, {_texts(_K, "il y a 3 jours", "il y a 2 mois")} AS since, {_texts(_K, "Bac Ou Licence, Master", "")} AS niveau_text,
 {_texts(_K, "Titulaire d''un master en gestion; motive", "Bac + 3 exige", "rien a signaler")} AS job_text,
 {_texts(_K, "Vente par Facilité : 12 000 DA / 10 mois", "1500 DA / mois jusqu''à 24 mois", "comptant")} AS plan_text,
 {_texts(_K, "Galaxy A5# OLED Garantie: 2 Ans 60 x 55 x 85 cm A++ ", "iPhone 12 Pro noir Garantie : 6 Mois")} AS txt, {_texts(_K, "RAM : 8 GB|CPU : Ryzen 5 (3.1 GHz)", "x")} AS lines FROM {{orders}}"""


# M3 with breadcrumbs, dates, images and parsed elements
@query(
    """, r AS (SELECT r.*, d.wilaya, d.commune FROM record_rows r JOIN (SELECT page_id, CASE k % 4 WHEN 0 THEN 'Alger' WHEN 1 THEN 'Oran' WHEN 2 THEN 'Blida' ELSE 'Setif' END AS wilaya,
 CASE k % 4 WHEN 0 THEN concat('Hydra-', CAST(k AS STRING)) WHEN 1 THEN concat('Es Senia ', CAST(k AS STRING)) WHEN 3 THEN 'Ville' ELSE 'Ville' END AS commune FROM detail_pages) d ON d.page_id = r.row_id)
 SELECT row_id, CASE k % 3 WHEN 0 THEN 'Villa' WHEN 1 THEN 'Studio' ELSE '' END AS bien,
 CASE WHEN k % 3 = 0 THEN 'Vente' WHEN k % 3 = 1 THEN 'Location' WHEN k % 4 = 0 THEN 'Vente' WHEN k % 2 = 0 THEN 'Location' ELSE 'Non spécifié' END AS transaction,
 CASE k % 3 WHEN 0 THEN '2024-03-02T10:20:30' WHEN 1 THEN '2024-05-06T00:00:00' ELSE '' END AS date_depot, CASE k % 3 WHEN 0 THEN 'https://i.example.com/a.jpg' WHEN 1 THEN '' ELSE 'https://i.example.com/b.png' END AS images,
 CASE WHEN k % 3 = 1 THEN 'Sans photo' ELSE 'Avec photo' END AS as_photo, wilaya, commune, concat('Rue ', CAST(k AS STRING)) AS adresse, concat('u', CAST(k AS STRING), '@x.org') AS email FROM r""",
    "record_rows",
    "detail_pages",
)
def real_estate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    # pages and rows are made of orders that are dealt and sorted by the join's key beforehand: no page is shuffled or sorted, nor its elements
    made = lambda name: frame(spark, sf_dir, name, wide=True, key="o_orderkey")
    found = made("detail_pages").select(C("page_id").alias("row_id"), "html").hint("merge")
    rows = made("record_rows").select("row_id", "titre", "crumbs", "crumb_links", "chips", "date_text", "images", "prix_text", "prix_unit")  # what passes the parser can't be pruned
    raw = html.with_found(rows.join(found, "row_id"), details.PLACE | details.CONTACT, "href")
    raw = _listed(raw, "crumbs", "crumb_links", "chips", "images")
    raw = raw.withColumns({"bien_text": F.lit(""), "lot_text": F.lit("F2 50 m2"), "adresse": F.lit("Setif-Ville")})
    out = jobs.normalize_real_estate(raw)
    return out.select("row_id", "bien", "transaction", "date_depot", F.array_join("images", "|").alias("images"), "as_photo", "wilaya", "commune", "adresse", F.array_join("contact.email", ",").alias("email"))


def _listed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.split(n, r"\|") for n in names})


# M5 with diplomas, ranges, experience, contract, region
@query(
    f""" SELECT row_id, CASE WHEN k % 2 = 0 THEN 'Achat & Logistique' WHEN k % 4 = 1 THEN 'Autre' ELSE 'Recherche & developpement' END AS domaine_norm,
 CASE k % 3 WHEN 0 THEN '40000-60000' WHEN 1 THEN '30000' ELSE '' END AS prix_value, CASE k % 3 WHEN 2 THEN 'Sans prix' ELSE 'Avec prix' END AS as_prix,
 CASE k % 3 WHEN 0 THEN 'Junior' WHEN 1 THEN 'Senior' ELSE 'autre' END AS experience, CASE k % 3 WHEN 0 THEN 'Teletravail' WHEN 1 THEN 'CDD' ELSE 'Non specifie' END AS contrat,
 CASE k % 3 WHEN 0 THEN 'Ouargla' WHEN 1 THEN concat('Ville ', CAST(k AS STRING)) ELSE 'N/A' END AS wilaya, strftime(DATE '{AS_OF}' - (CASE k % 2 WHEN 0 THEN INTERVAL 3 DAY ELSE INTERVAL 60 DAY END), '%Y-%m-%d') AS date_depot,
 CASE k % 2 WHEN 0 THEN 'Bac|Licence|Master' ELSE '' END AS niveau, CASE k % 3 WHEN 0 THEN 'Titulaire d''un master en gestion|master en gestion' WHEN 1 THEN '3|Bac + 3 exige' ELSE '' END AS diplome_src,
 concat(CASE k % 2 WHEN 0 THEN 'Diplome universitaire' ELSE '' END, CASE WHEN k % 2 = 0 AND k % 3 < 2 THEN '|' ELSE '' END, CASE k % 3 WHEN 0 THEN 'Titulaire d''un master en gestion|master en gestion' WHEN 1 THEN '3|Bac + 3 exige' ELSE (CASE k % 2 WHEN 0 THEN '' ELSE 'Non spécifié' END) END) AS diplomes FROM record_rows""",
    "record_rows",
)
def job_records_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frame(spark, sf_dir, "record_rows", wide=True).withColumns({"description": C("job_text"), "adresse": F.lit("x"), "quand": F.lit("")})
    out = jobs.normalize_jobs(raw, F.to_date(F.lit(AS_OF)))
    lists = {c: F.array_join(c, "|").alias(c) for c in ("niveau", "diplome_src", "diplomes")}
    return out.select("row_id", C("domaine_complet").alias("domaine_norm"), "prix_value", "as_prix", "experience", "contrat", "wilaya", "date_depot", *lists.values())


# M4 with prices, standard names and status
@query(
    """ SELECT row_id, CASE k % 4 WHEN 0 THEN 'Vente F3' WHEN 1 THEN 'Divers' WHEN 2 THEN 'Poste De Chef De Cuisine' ELSE 'Recherche Comptable' END AS titre, CASE WHEN k % 2 = 0 THEN 404 ELSE 200 END AS status, CASE k % 3 WHEN 2 THEN 'true' ELSE 'false' END AS export,
 CAST(CASE WHEN k % 4 = 3 THEN 0.0 WHEN k % 3 = 1 THEN CASE k % 4 WHEN 0 THEN 12005.0 WHEN 1 THEN 3000000.0 ELSE 45000.0 END WHEN k % 3 = 0 THEN CASE k % 4 WHEN 0 THEN 1200.5 * 10000 WHEN 1 THEN 3000000.0 ELSE 45000.0 END
 ELSE CASE k % 4 WHEN 0 THEN 1200.5 WHEN 1 THEN 3000000.0 ELSE 45000.0 END END AS DOUBLE) AS prix_dec FROM record_rows""",
    "record_rows",
)
def vehicle_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frame(spark, sf_dir, "record_rows").withColumns({"energie_text": F.lit("Essence"), "boite": F.lit("MT"), "km_text": F.lit("10 km"), "moteur_text": F.lit("1.6 TSI 2025")})
    return jobs.normalize_vehicles(raw, F.to_date(F.lit(AS_OF))).select("row_id", "titre", "status", "export", "prix_dec")


# M6, M7 with prices, instalments, models, warranty
@query(
    """ SELECT row_id, CASE WHEN k % 2 = 0 THEN 'A++' ELSE '' END AS energie, CASE WHEN k % 2 = 0 THEN '60 x 55 x 85 cm' ELSE '' END AS dimension, CAST(CASE k % 4 WHEN 0 THEN 12005.0 WHEN 1 THEN 0.0 WHEN 2 THEN 45000.0 ELSE 0.0 END AS DOUBLE) AS prix_dec,
 CAST(CASE k % 3 WHEN 0 THEN 120000.0 WHEN 1 THEN 36000.0 ELSE 0.0 END AS DOUBLE) AS total_facilite, CASE WHEN k % 2 = 0 THEN concat('Galaxy A5', CAST(k AS STRING)) ELSE 'iPhone 12 Pro' END AS modele, CASE WHEN k % 2 = 0 THEN '2' ELSE '6' END AS garantie, CASE WHEN k % 2 = 0 THEN 'Ryzen 5 (3.1 GHz)' ELSE '' END AS processor FROM record_rows""",
    "record_rows",
)
def shop_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _listed(frame(spark, sf_dir, "record_rows"), "lines", "images")
    a = jobs.normalize_appliances(df).select("row_id", "energie", "dimension", "prix_dec", "total_facilite")
    e = jobs.normalize_electronics(df, as_of=F.to_date(F.lit(AS_OF))).select("row_id", "modele", "garantie", "processor")
    return a.join(e, "row_id")
