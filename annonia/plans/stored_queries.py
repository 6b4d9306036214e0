"""Queries over stored tables: bucketed upserts and the seen set, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pages
from ..operators import upsert
from ..sources.bucketed import SeenSet
from ..sources.io import new_folder
from . import registry
from .compose import frame
from .registry import C, query

_FIRSTS = """ SELECT listing_id, min(batch) AS batch FROM (SELECT regexp_extract(url, 'd(\\d+)$', 1) AS listing_id, row_id % 3 AS batch FROM listings_raw) WHERE listing_id <> '' GROUP BY listing_id"""


# J3 on a stored table: two upserts, of which the second exchanges the batch only
@query(registry.ORACLE["upserted_first_date"])
def stored_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after each half of the listings has been upserted into a bucketed table."""
    table = new_folder(spark)
    df = frame(spark, sf_dir, "listings_raw").withColumn("date_depot", C("date_text"))
    for part in (0, 1):
        state = upsert.upsert_stored(table, df.where(C("row_id") % 2 == part), C("site") == "site1", "url", order=["date_crawl"], tie=["row_id"])
    return state.select("url", "row_id", "date_depot")


# B9, B10
@query(_FIRSTS, "listings_raw")
def seen_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch in which each listing was first seen, from a set that grows by three batches."""
    seen = SeenSet(new_folder(spark), buckets=8, shards=8)
    ids = frame(spark, sf_dir, "listings_raw").select((C("row_id") % 3).alias("part"), pages.listing_id_from_url(C("url")).alias("listing_id"))
    for part in range(3):
        seen.add(seen.new_ids(ids.where(C("part") == part), before=part), part)
    return seen.stored(spark).select("listing_id", "batch")
