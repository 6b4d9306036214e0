"""Link extraction, keys and set work on the frontier of listing urls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pages


#: The href of an anchor, with its quotes if it has any.
_HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def hrefs(html: Column) -> Column:
    """The hrefs of all anchors in order, quoted in either way or not at all."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_HREF), F.lit(1))
    return F.transform(found, lambda h: F.replace(F.regexp_replace(h, "^[\"']|[\"']$", ""), F.lit("&amp;"), F.lit("&")))


def extract_itemlist_urls(df: DataFrame) -> DataFrame:
    """(page_id, pos, url) from the pages' JSON-LD item lists."""
    return df.select("page_id", F.posexplode(pages.itemlist_urls(F.col("html"))).alias("pos", "url"))


def extract_links(df: DataFrame) -> DataFrame:
    """(page_id, page_url, pos, href) of every anchor."""
    return df.select("page_id", F.col("url").alias("page_url"), F.posexplode(hrefs(F.col("html"))).alias("pos", "href"))


def links_with_fallback(df: DataFrame, min_links: int = 5) -> DataFrame:
    """JSON-LD urls, and the html links of pages with fewer than ``min_links`` of them; counted on the array, so without a shuffle."""
    ld = pages.itemlist_urls(F.col("html"))
    links = F.transform(hrefs(F.col("html")), lambda h: pages.resolve_url(F.col("url"), h))
    both = F.when(F.size(ld) < min_links, F.concat(ld, F.filter(links, lambda x: x.isNotNull()))).otherwise(ld)
    return df.select("page_id", F.posexplode(F.array_distinct(both)).alias("pos", "url"))


def filter_listing_links(df: DataFrame, must_contain: list[str] = (), pattern: str | None = None, column: str = "url") -> DataFrame:
    cond: Column = F.col(column).isNotNull()
    for part in must_contain:
        cond = cond & F.contains(F.col(column), F.lit(part))
    return df.where(cond & F.col(column).rlike(pattern) if pattern else cond)


def dedupe_links(df: DataFrame) -> DataFrame:
    """One row a url, the first by page and position; a minimum, so map tasks reduce before the shuffle."""
    first = F.min(F.struct("page_id", "pos")).alias("first")
    return df.groupBy("url").agg(first).select("url", "first.page_id", "first.pos")


def new_listings(frontier: DataFrame, seen: DataFrame) -> DataFrame:
    return frontier.where(F.col("listing_id").isNotNull()).join(seen, "listing_id", "left_anti")


def extend_seen(seen: DataFrame, batch: DataFrame) -> DataFrame:
    return seen.select("listing_id").union(batch.select("listing_id")).where(F.col("listing_id").isNotNull()).distinct()


def page_plan(df: DataFrame, total: str = "total_results", page_size: int = 12) -> DataFrame:
    """One row for each result page."""
    n = F.ceil(F.col(total) / page_size).cast("int")
    return df.withColumn("n_pages", n).where(n > 0).select("*", F.explode(F.sequence(F.lit(1), n)).alias("page"))


def merge_card_and_detail(cards: DataFrame, details: DataFrame, fields: list[str], key: str = "url", order: list[str] = ()) -> DataFrame:
    """Details with their gaps (null or '') filled from the listing card, of several cards the first by ``order``, then by the fields themselves."""
    first = F.min_by(F.struct(*fields), F.struct(*order, *fields)).alias("_card")
    renamed = cards.groupBy(key).agg(first).select(key, *(F.col(f"_card.{f}").alias(f"card_{f}") for f in fields))
    joined = details.join(renamed, key, "left")
    filled = {f: F.coalesce(F.when(F.col(f) != "", F.col(f)), F.col(f"card_{f}")) if f in details.columns else F.col(f"card_{f}") for f in fields}
    return joined.withColumns(filled).drop(*(f"card_{f}" for f in fields))


def product_offers(offers: DataFrame) -> DataFrame:
    """(product_url, offers): each product with its sorted array of offers, gaps filled."""
    offer = F.struct(
        F.coalesce("store", F.lit("Unknown Store")).alias("store"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
        F.coalesce("condition", F.lit("N/A")).alias("condition"),
    )
    return offers.where("product_url is not null").groupBy("product_url").agg(F.array_sort(F.collect_list(offer)).alias("offers"))


def failed_urls(frontier: DataFrame, results: DataFrame) -> DataFrame:
    return frontier.join(results.where("success").select("url").distinct(), "url", "left_anti")
