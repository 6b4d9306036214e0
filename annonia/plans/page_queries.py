"""Queries over parsed pages: selectors, nested detail fields, label/value pairs of any layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import details, dom
from ..operators import frontier
from ..sources import html
from .compose import INPUTS, frame
from .registry import C, query
from .rule_queries import _texts

_K = "o_custkey"
_TEL = f"concat('21355', lpad(CAST({_K} % 10000000 AS STRING), 7, '0'))"
INPUTS["detail_pages"] = f"""SELECT o_orderkey AS page_id, concat('https://www.example.com/d/', CAST(o_orderkey AS STRING)) AS url, {_K} AS k,
 concat('<html><body><ul class="menu"><li><div class="__content"><div class="__title">Menu</div></div></li></ul><ul class="v-list ok-list">',
 '<li><div class="__prepend"><i class="mdi mdi-home-map-marker"></i></div><div class="__content"><div class="__title">Rue <b>', CAST({_K} AS STRING), '</b></div></div></li>',
 '<li><div class=__prepend><span><i class=mdi-map-marker></i></span></div><div class="__content">',
 {_texts(_K, '<div class="__title"><span class="text-wrap">Alger - Hydra-#</span> x</div>', '<div class="__title">Oran-Es Senia #</div>', '<div class="__title">Blida</div>', '<div>no title</div>')}, '</div>',
 '</ul><div id="announcementUserInfo"><a class="v-btn x" href="tel:+', {_TEL}, '">call</a><a class=''ok-list-item''>0 55 ', '12 34 ', lpad(CAST({_K} % 100 AS STRING), 2, '0'), ' or write</a></div><a class="v-btn">0661223344</a>',
 {_texts(_K, '<a href="mailto: U#@X.ORG ">m</a>', "<a rel=x href=''mailto:U#@X.ORG''>m</a>", '<a href=mailto:U#@x.org>m</a><a href="mailto:u#@X.org">m</a>')},
 {_texts(_K, '<a href="https://wa.me/+213#?text=a&amp;b">w</a>', "<a href=''viber://chat?number=#''>v</a>", '<a href=https://t.me/213#>t</a>', '<a data-href="https://wa.me/9">x</a>')}, '</body></html>') AS html FROM {{orders}}"""
INPUTS["grid_pages"] = f"""SELECT o_orderkey AS page_id, concat('https://www.example.com/g/', CAST(o_orderkey AS STRING)) AS url,
 concat('<div class="base-info"><div class="item"><p class="label">Mileage</p><p class="value">', CAST({_K} AS STRING), ' km</p></div><div class="item"><p class="label">City</p><p class="value"><span>A</span> b</p></div></div>',
 '<table class="el-descriptions__table"><tr><td>Engine</td><td>', o_orderstatus, '</td><td>Color</td><td>red ', CAST({_K} % 7 AS STRING), '<tr><td>Fuel</td><td colspan=3>gas</td></tr><tr><td colspan=4>More</td></tr>',
 '<tr><td rowspan="2">Size</td><td>width</td><td>', CAST({_K} % 90 AS STRING), '</td></tr><tr><td>height</td><td>9</td></tr><tr><td>Odd</td><td>1</td><td>left</td></tr></table>',
 '<table><tr><th>Power</th><th>Torque</th></tr><tr><td>', CAST({_K} % 300 AS STRING), ' hp</td><td>200</td></tr></table>',
 '<ul><li><span>Doors</span><span>', CAST(1 + {_K} % 5 AS STRING), '</span></li><li><span>Seats</span><span>5</span></li></ul><dl><dt>Options<dd>abs<dd>gps</dl>',
 '<div class="flat"><b class="k">Year</b><i class="v">', CAST(year(o_orderdate) AS STRING), '</i><b class="k">Engine</b><i class="v">E', CAST({_K} % 3 AS STRING), '</i></div><nav><a>Home</a><a>Cars</a></nav>') AS html FROM {{orders}}"""


# C1 on the given pages
@query(
    """SELECT page_id, len(regexp_extract_all(html, '<li>')) AS nav_links, regexp_extract(html, '<li><a href="([^"]*)">', 1) AS first_href, regexp_extract(html, '<a href="[^"]*">([^<]*)</a></li></ul>', 1) AS last_link,
 trim(regexp_replace(replace(regexp_extract(html, '<div class="ad">([^<]*)</div>', 1), '&amp;', '&'), '\\s+', ' ', 'g')) AS ad, len(regexp_extract_all(html, '<p>')) AS paragraphs, len(regexp_extract_all(html, '<a href="/')) AS own_links FROM pages"""
)
def page_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descendant, child, sibling, order and attribute selectors over the given pages."""
    p = html.parse_pages(frame(spark, sf_dir, "pages", wide=True), "elements", "strings")
    e, s = C("elements"), C("strings")
    count = lambda selector: F.size(dom.select(e, selector)).cast("long")
    return p.select(
        "page_id",
        count("nav ul > li").alias("nav_links"),
        dom.attr(dom.first(dom.select(e, "nav li:first-child > a[href]")), "href").alias("first_href"),
        dom.text(dom.first(dom.select(e, "nav > ul > li:last-child a")), s).alias("last_link"),
        dom.text(dom.first(dom.select(e, "nav ~ div.ad")), s).alias("ad"),
        count("article > h1 ~ p").alias("paragraphs"),
        count("a[href^='/']").alias("own_links"),
    )


# B2, C1, C18-C20: nested and attribute reads
@query(
    f""" SELECT page_id, CASE k % 4 WHEN 0 THEN 'Alger' WHEN 1 THEN 'Oran' WHEN 2 THEN 'Blida' ELSE '' END AS wilaya, CASE k % 4 WHEN 0 THEN concat('Hydra-', CAST(k AS STRING)) WHEN 1 THEN concat('Es Senia ', CAST(k AS STRING)) ELSE '' END AS commune,
 concat('Rue ', CAST(k AS STRING)) AS address, concat('u', CAST(k AS STRING), '@x.org') AS email, concat({_TEL.replace(_K, "k")}, ',0551234', lpad(CAST(k % 100 AS STRING), 2, '0')) AS phones,
 CASE k % 4 WHEN 0 THEN concat('https://wa.me/+213', CAST(k AS STRING)) ELSE '' END AS whatsapp, CASE k % 4 WHEN 2 THEN concat('https://t.me/213', CAST(k AS STRING)) ELSE '' END AS telegram,
 CASE k % 4 WHEN 1 THEN concat('viber://chat?number=', CAST(k AS STRING)) ELSE '' END AS viber FROM detail_pages""",
    "detail_pages",
)
def detail_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, address and contacts of nested detail pages."""
    p = html.with_found(frame(spark, sf_dir, "detail_pages", wide=True).select("page_id", "html"), details.PLACE | details.CONTACT, "href")
    f, s = C("found"), C("strings")
    read = p.select("page_id", details.location_of(f, s).alias("l"), details.contact_of(f, s).alias("c"))
    lists = {"email": "email", "phones": "phones", "whatsapp": "whatsapp", "telegram": "telegram", "viber": "viber"}
    return read.select("page_id", "l.wilaya", "l.commune", "l.address", *(F.array_join(f"c.{c}", ",").alias(n) for n, c in lists.items()))


# B2: hrefs in every spelling
@query(
    """ SELECT page_id, CASE k % 4 WHEN 0 THEN concat('https://wa.me/+213', CAST(k AS STRING), '?text=a&b') WHEN 1 THEN concat('viber://chat?number=', CAST(k AS STRING)) WHEN 2 THEN concat('https://t.me/213', CAST(k AS STRING)) END AS href FROM detail_pages WHERE k % 4 <> 3""",
    "detail_pages",
)
def any_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the pages by the native pattern: in double, single or no quotes; no other attributes."""
    links = frontier.extract_links(frame(spark, sf_dir, "detail_pages"))
    return links.where(~F.col("href").rlike("^(?:tel|mailto):")).select("page_id", "href")


# C3: tables of any width, lists and sibling pairs
@query(
    f""" SELECT o_orderkey AS page_id, concat_ws('|', concat(CAST({_K} AS STRING), ' km'), 'A b', concat('E', CAST({_K} % 3 AS STRING)), concat('red ', CAST({_K} % 7 AS STRING)), 'gas', CAST({_K} % 90 AS STRING), '9', '1', concat(CAST({_K} % 300 AS STRING), ' hp'), '200',
 CAST(1 + {_K} % 5 AS STRING), '5', 'abs, gps', CAST(year(o_orderdate) AS STRING)) AS found, CAST(14 AS BIGINT) AS n FROM orders"""
)
def spec_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One map from four-cell rows, spans, heading rows, lists and repeated siblings."""
    p = html.with_parsed(frame(spark, sf_dir, "grid_pages", wide=True).select("page_id", "html"), "pairs")
    m = html.spec_map(C("pairs"))
    labels = ["Mileage", "City", "Engine", "Color", "Fuel", "Size width", "Size height", "Odd", "Power", "Torque", "Doors", "Seats", "Options", "Year"]
    got = p.select("page_id", m.alias("m"))
    return got.select("page_id", F.concat_ws("|", *(F.try_element_at("m", F.lit(x)) for x in labels)).alias("found"), F.size("m").cast("long").alias("n"))
