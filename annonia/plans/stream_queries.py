"""Streaming queries over the events table: run to the end of the input, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pages
from ..sources.bucketed import SeenSet
from ..sources.io import new_folder
from ..streaming import streams
from . import registry
from .compose import INPUTS


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_events as a stream of files."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    # the glob also fits a single file, which a stream takes as a folder's content only by pattern
    spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").createOrReplaceTempView("annonia_event_stream")
    return spark.sql(INPUTS["run_events"].replace("{events}", "annonia_event_stream"))


def _finished(df: DataFrame, place: str) -> DataFrame:
    q = df.writeStream.format("parquet").option("path", f"{place}/out").option("checkpointLocation", f"{place}/log").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{place}/out")


def _alerts(spark: SparkSession, sf_dir: str, start) -> DataFrame:
    place = new_folder(spark)
    start(_events(spark, sf_dir), f"{place}/table", f"{place}/log").awaitTermination()
    return streams.read_alerts(spark, f"{place}/table").select("category", "event_id", "kind", "reached")


# L3, L4
@registry.query(registry.ORACLE["alerts"])
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts with counters by category; equal to the batch answer."""
    return _alerts(spark, sf_dir, streams.stream_alerts)


# L3: every third error of a streak, counted by the events' own time
@registry.query(registry._STREAKS + " SELECT category, event_id, 'error' AS kind, streak AS reached FROM s WHERE streak % 3 = 0", "run_events")
def stream_error_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_folder(spark)
    streams.stream_error_streaks(_events(spark, sf_dir), f"{place}/table", f"{place}/log", threshold=3, delay=3600).awaitTermination()
    return streams.read_alerts(spark, f"{place}/table", errors=3, kinds=["error"]).select("category", "event_id", "kind", "reached")


# L4
@registry.query(f"SELECT * FROM ({registry.ORACLE['alerts']}) WHERE kind <> 'error'")
def stream_threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, streams.stream_threshold_alerts)


# L1, with a watermark that keeps every id as long as the table's time goes
@registry.query("SELECT DISTINCT CAST(user_id AS STRING) AS listing_id FROM events")
def stream_watermarked_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids not seen within the delay, here ten years."""
    stream = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(f"{sf_dir}/events.parquet*")
    ids = stream.select(F.col("user_id").cast("string").alias("listing_id"), F.col("ts").cast("timestamp").alias("ts"))
    return _finished(streams.stream_new_listings(ids, "3650 days"), new_folder(spark)).select("listing_id")


# L1
@registry.query("SELECT DISTINCT CAST(user_id AS STRING) AS listing_id FROM events")
def stream_new_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids never seen before, exactly once each."""
    place = new_folder(spark)
    path = f"{sf_dir}/events.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{sf_dir}/events.parquet*")
    ids = stream.select(F.col("user_id").cast("string").alias("listing_id"))
    seen = SeenSet(f"{place}/seen", buckets=8, shards=8)
    streams.stream_new_listings_exact(ids, seen, f"{place}/log").awaitTermination()
    return streams.read_new_listings(spark, seen).select("listing_id")


# L2
@registry.query(
    "SELECT concat('https://www.example.com/annonce-d', CAST(user_id AS STRING)) AS doc_id, max(event_id) AS event_id, CAST(user_id AS STRING) AS numero FROM events GROUP BY user_id"
)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user's page, upserted batch by batch."""
    place = new_folder(spark)
    path = f"{sf_dir}/events.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{sf_dir}/events.parquet*")

    def normalize(batch: DataFrame) -> DataFrame:
        url = F.concat(F.lit("https://www.example.com/annonce-d"), F.col("user_id").cast("string"))
        return batch.select(url.alias("doc_id"), "event_id", pages.listing_id_from_url(url).alias("numero"), F.col("event_id").alias("date_crawl"))

    streams.stream_normalize_upsert(stream, normalize, f"{place}/table", f"{place}/log").awaitTermination()
    return streams.current_table(spark, f"{place}/table", normalize(spark.read.parquet(path)).schema).select("doc_id", "event_id", "numero")


# L5
@registry.query("SELECT kind, count(*) AS n FROM run_events WHERE kind <> 'success' GROUP BY kind", "run_events")
def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed outcomes, routed to their own path."""
    place = new_folder(spark)
    events = _events(spark, sf_dir)
    streams.stream_dead_letter(events, F.col("kind") == "success", f"{place}/good", f"{place}/bad", f"{place}/log").awaitTermination()
    return spark.read.schema("kind string").json(f"{place}/bad").groupBy("kind").agg(F.count("*").alias("n"))
