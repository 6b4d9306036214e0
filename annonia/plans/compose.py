"""Inputs composed from the given tables, in SQL that Spark and DuckDB read alike.

The given text is invented words, so prices, spellings and markup are put together from keys.
``{name}`` stands for a table; ``frame`` runs one in Spark, ``cte`` gives it to DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

INPUTS = {
    "listings_raw": """SELECT o_orderkey AS row_id,
 concat('https://www.example.com/', CASE o_orderkey % 3 WHEN 0 THEN 'vente' WHEN 1 THEN 'location' ELSE 'echange' END, '-annonce-d', CAST(o_custkey AS STRING)) AS url,
 concat('site', CAST(o_custkey % 7 AS STRING)) AS site,
 CASE o_custkey % 5 WHEN 0 THEN 'immobilier' WHEN 1 THEN 'voiture' WHEN 2 THEN 'emploi' WHEN 3 THEN 'electromenager' ELSE 'multimedia' END AS category,
 CASE o_orderkey % 6 WHEN 0 THEN concat(CAST(CAST(floor(o_totalprice/1000) AS BIGINT) AS STRING), ' Millions')
  WHEN 1 THEN concat(CAST(CAST(floor(o_totalprice/100000) AS BIGINT) AS STRING), ',5 Milliards')
  WHEN 2 THEN concat(CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING), ' DA')
  WHEN 3 THEN '1.200.000 DA' WHEN 4 THEN '' ELSE 'Prix sur demande' END AS prix_text,
 CASE o_orderkey % 6 WHEN 0 THEN 'Millions' WHEN 1 THEN 'Milliards' WHEN 2 THEN 'DA' WHEN 3 THEN 'DZD' WHEN 4 THEN '' ELSE 'EUR' END AS prix_unit,
 CASE o_custkey % 9 WHEN 0 THEN 'Essence' WHEN 1 THEN 'Petrol' WHEN 2 THEN 'Diesel' WHEN 3 THEN 'Essence / GPL' WHEN 4 THEN 'Hybrid (gasoline/electric)' WHEN 5 THEN 'essence hybride rechargeable' WHEN 6 THEN 'Electric' WHEN 7 THEN '' ELSE 'hydrogene' END AS energie_text,
 CASE o_orderkey % 3 WHEN 0 THEN concat(lpad(CAST(day(o_orderdate) AS STRING),2,'0'),'/',lpad(CAST(month(o_orderdate) AS STRING),2,'0'),'/',CAST(year(o_orderdate) AS STRING),' 10:20:30')
  WHEN 1 THEN concat(CAST(year(o_orderdate) AS STRING),'-',lpad(CAST(month(o_orderdate) AS STRING),2,'0'),'-',lpad(CAST(day(o_orderdate) AS STRING),2,'0')) ELSE 'Date' END AS date_text,
 o_orderdate AS date_crawl FROM {orders}""",
    "run_events": """SELECT event_id, ts, CASE user_id % 5 WHEN 0 THEN 'immobilier' WHEN 1 THEN 'voiture' WHEN 2 THEN 'emploi' WHEN 3 THEN 'electromenager' ELSE 'multimedia' END AS category,
 concat('site', CAST(user_id % 7 AS STRING)) AS site,
 CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'block' WHEN event_type = 'signup' THEN 'captcha' ELSE 'success' END AS kind FROM {events}""",
    "requests": """SELECT event_id, concat('ep', CAST(user_id % 40 AS STRING)) AS endpoint, event_type <> 'error' AS ok, CAST(event_id % 700 AS DOUBLE) / 100.0 AS latency, event_id % 97 = 0 AS blocked FROM {events}""",
    "spec_text": """SELECT p_partkey AS row_id, concat(CASE p_partkey % 4 WHEN 0 THEN 'SAMSUNG ' WHEN 1 THEN 'Refrigerateur LG ' WHEN 2 THEN 'Laptop HP ' ELSE 'Produit ' END, p_name,
 ' RAM: ', CAST(p_size AS STRING), ' GB ', CAST(p_size * 8 AS STRING), ' GB SSD Garantie: ', CAST(1 + p_size % 3 AS STRING), CASE p_size % 2 WHEN 0 THEN ' Ans ' ELSE ' Mois ' END, CAST(p_size * 100 AS STRING), ' mAh ', CAST(p_size AS STRING), ' kg',
 CASE p_partkey % 3 WHEN 0 THEN ' Puissance: 1500 Watts Windows 11' WHEN 1 THEN ' 7 L noir Android 13 15.6 pouces' ELSE ' 60 x 55 x 85 cm A++ OLED selfie: 12 MP' END) AS txt FROM {part}""",
    "seen": """SELECT DISTINCT CAST(o_custkey AS STRING) AS listing_id FROM {orders} WHERE o_custkey % 3 = 0""",
    "words": """SELECT o_orderkey AS row_id, o_custkey AS k, o_orderdate AS d,
 CASE o_custkey % 8 WHEN 0 THEN 'appartements' WHEN 1 THEN 'Villa avec jardin' WHEN 2 THEN 'niveau' WHEN 3 THEN 'xyz' WHEN 4 THEN 'Terrain agricole' WHEN 5 THEN 'commerce, local' WHEN 6 THEN '' ELSE 'Studio' END AS bien_text,
 CASE o_custkey % 7 WHEN 0 THEN 'Location vacances mer' WHEN 1 THEN 'Cherche achat villa' WHEN 2 THEN 'Vente F3' WHEN 3 THEN 'a louer F2' WHEN 4 THEN 'recherche location' WHEN 5 THEN 'Divers' ELSE '' END AS titre,
 CASE o_custkey % 6 WHEN 0 THEN 'dct' WHEN 1 THEN 'Semi auto' WHEN 2 THEN 'MT' WHEN 3 THEN 'BV6' WHEN 4 THEN 'Boite automatique' ELSE '' END AS boite,
 CASE o_custkey % 5 WHEN 0 THEN 'Doctorat' WHEN 1 THEN 'Licence' WHEN 2 THEN 'CAP' WHEN 3 THEN 'pas important' ELSE '' END AS diplome,
 CASE o_custkey % 5 WHEN 0 THEN 'Alger, Hydra' WHEN 1 THEN 'Oran' WHEN 2 THEN '' WHEN 3 THEN 'Blida - Centre' ELSE 'Setif-Ville' END AS adresse,
 CASE o_custkey % 4 WHEN 0 THEN 'Automobile' WHEN 1 THEN 'Secteur Public' WHEN 2 THEN 'Achats' ELSE 'Inconnu' END AS domaine,
 concat(CAST(o_custkey % 300 AS STRING), ' 000 km') AS km_text, concat(CAST(1 + o_custkey % 5 AS STRING), '.6 TSI ', CAST(2000 + o_custkey % 25 AS STRING)) AS moteur_text,
 concat('F', CAST(1 + o_custkey % 6 AS STRING), ' ', CAST(50 + o_custkey % 90 AS STRING), ' m2 R+', CAST(o_custkey % 4 AS STRING)) AS lot_text,
 concat('salaire ', CAST(20 + o_custkey % 80 AS STRING), ' 000 DA net') AS salaire_text,
 concat('il y a ', CAST(1 + o_custkey % 9 AS STRING), CASE o_custkey % 4 WHEN 0 THEN ' jours' WHEN 1 THEN ' semaines' WHEN 2 THEN ' mois' ELSE ' ans' END) AS quand
 FROM {orders}""",
    "engines": """SELECT o_orderkey AS row_id, o_custkey AS k, concat(CAST(1 + o_custkey % 5 AS STRING), '.6 TSI ', CAST(2020 + o_custkey % 7 AS STRING)) AS moteur_text FROM {orders}""",
    "contact_pages": """SELECT o_orderkey AS page_id, concat('https://www.example.com/p/', CAST(o_orderkey AS STRING)) AS url,
 concat('<div><a href="mailto:U', CAST(o_custkey AS STRING), '@X.ORG">m</a><a href="tel:+213 55', lpad(CAST(o_custkey % 10000000 AS STRING), 7, '0'), '">t</a>',
 CASE o_custkey % 3 WHEN 0 THEN concat('<a href="https://wa.me/21366', lpad(CAST(o_custkey % 10000000 AS STRING), 7, '0'), '">w</a>') ELSE '' END,
 CASE o_custkey % 4 WHEN 0 THEN concat('<script>{"userId": ', CAST(o_custkey AS STRING), '}</script>') ELSE '' END, '</div>') AS html FROM {orders}""",
    "ld_pages": """SELECT c_custkey AS page_id, concat('https://www.example.com/l/', CAST(c_custkey AS STRING)) AS url,
 concat('<a href="/annonce-x-d', CAST(c_custkey AS STRING), '">x</a><a href="//cdn.example.com/y">y</a><script type="application/ld+json">', CASE c_custkey % 2 WHEN 0 THEN '[' ELSE '' END,
 '{"@type": "ItemList", "itemListElement": [{"url": "https://www.example.com/annonce-a-d', CAST(c_custkey AS STRING), '"}, {"item": {"url": "https://www.example.com/annonce-b-d', CAST(c_custkey % 50 AS STRING), '"}}, {"url": "ftp://no"}]}',
 CASE c_custkey % 2 WHEN 0 THEN ']' ELSE '' END, '</script>') AS html FROM {customer}""",
    "spec_pages": """SELECT o_orderkey AS page_id, concat('https://www.example.com/s/', CAST(o_orderkey AS STRING)) AS url,
 concat('<html><title> Annonce ', CAST(o_custkey AS STRING), '</title><table><tr><td>Marque :</td><td>', o_orderstatus, '</td></tr><tr><th>Km</th><td>old</td></tr><tr><th>Km</th><td>', CAST(o_custkey % 300 AS STRING),
 ' 000</td></tr></table><dl><dt>Date - Mise :</dt><dd>', CAST(year(o_orderdate) AS STRING), '</dd></dl><p class="lead big">Prix <b>', CAST(o_custkey AS STRING), '</b> DA</p></html>') AS html FROM {orders}""",
    "offers": """SELECT concat('https://shop.example.com/p', CAST(l_partkey AS STRING)) AS product_url, concat('store', CAST(l_suppkey AS STRING)) AS store, l_extendedprice AS price, l_returnflag AS cond FROM {lineitem}""",
    "runs": """SELECT category, CAST(floor(event_id / 500) AS BIGINT) AS cycle, site, SUM(CASE WHEN kind = 'success' THEN 1 ELSE 0 END) AS items, SUM(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) AS errors,
 MAX(ts) AS ended, CAST(MAX(event_id) - MIN(event_id) AS DOUBLE) AS duration FROM {run_events} GROUP BY category, CAST(floor(event_id / 500) AS BIGINT), site""",
}


#: Tasks for each split of a file. A split of 128 MB may hold millions of short rows, or all of them, if the file is one row group.
TASKS_A_SPLIT = 16


def spread(df: DataFrame, key: str = "") -> DataFrame:
    """The rows of a file dealt evenly over more tasks than it has splits, for rules that cost far more than reading a row.

    With ``key``, rows of one key share a task and stand in its order, so that what is made of them is joined by the key without another shuffle or sort."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), TASKS_A_SPLIT * df.rdd.getNumPartitions())
    return df.repartition(n, key).sortWithinPartitions(key) if key else df.repartition(n)


def frame(spark: SparkSession, sf_dir: str, name: str, wide: bool = False, key: str = "") -> DataFrame:
    """The input (or plain table) as a DataFrame; with ``wide``, its tables are spread (by ``key``) before anything is composed, as their own rows are short."""
    if name not in INPUTS:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return spread(table, key) if wide else table
    needed = dict.fromkeys(re.findall(r"\{([a-z_]+)\}", INPUTS[name]))
    # only table names are braces with a word in them; JSON braces are followed by a quote
    sql = INPUTS[name]
    views = {}
    for t in needed:
        view = f"annonia_{t}"
        frame(spark, sf_dir, t, wide, key).createOrReplaceTempView(view)
        views[t] = view
    for t, view in views.items():
        sql = sql.replace("{" + t + "}", view)
    return spark.sql(sql)


def cte(*names: str) -> str:
    """``WITH`` clause that defines the inputs for DuckDB."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done or name not in INPUTS:
            return
        sql = INPUTS[name]
        for t in dict.fromkeys(re.findall(r"\{([a-z_]+)\}", sql)):
            add(t)
            sql = sql.replace("{" + t + "}", t)
        done[name] = sql

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in done.items()) + "\n"
