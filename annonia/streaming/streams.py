"""Streaming forms of the frontier, the upsert and the alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import metrics, upsert
from ..sources import files, io, versions
from ..sources.bucketed import SeenSet


def stream_new_listings(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drops listings seen within the watermark; ``ts`` is the event time."""
    return stream.where("listing_id is not null").withWatermark("ts", delay).dropDuplicatesWithinWatermark(["listing_id"])


def stream_new_listings_exact(stream: DataFrame, ids: SeenSet, checkpoint: str) -> StreamingQuery:
    """Drops all listings ever seen: each batch is held against the set of those before, and its new ids are added under its number.

    The set (``sources.bucketed.SeenSet``) is neither shuffled nor, where its filter rules all ids of a shard out, read.
    A batch that runs again looks at earlier batches only."""
    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        ids.add(ids.new_ids(batch.select(ids.key), before=number), number)
        batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_new_listings(spark: SparkSession, ids: SeenSet) -> DataFrame:
    """(listing_id, batch): every id once, with the first batch that had it."""
    return ids.stored(spark).groupBy(ids.key).agg(F.min("batch").alias("batch"))


def stream_normalize_upsert(
    stream: DataFrame, normalize: Callable[[DataFrame], DataFrame], table: str, checkpoint: str, key: str = "doc_id", order: list[str] = ("date_crawl",), tie: list[str] = ("event_id",), buckets: int = 64, keep: int = 2
) -> StreamingQuery:
    """Normalises and upserts each batch into a versioned table (``sources.versions``).

    A batch reads and rewrites only the buckets that it touches; ``keep`` versions stay for readers."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if versions.committed(spark, table, number):
            return
        batch.persist()
        new = normalize(batch).withColumn("bucket", versions.bucket_of(key, buckets))
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # at most ``buckets``
        old = versions.current(spark, table, new.drop("bucket").schema, touched, before=number)
        versions.write(upsert.upsert(old, new, key, order, tie), table, number, touched)
        versions.vacuum(spark, table, keep)
        batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_table(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The rows of the last whole batch, with the column ``bucket``."""
    return versions.current(spark, table, schema)


def stream_dead_letter(stream: DataFrame, valid, good: str, bad: str, checkpoint: str) -> StreamingQuery:
    """Rows that fail go to their own path, batch by batch."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        ok, failed = io.split_failed(batch, valid)
        ok.write.mode("overwrite").parquet(f"{good}/batch={number}")
        failed.write.mode("overwrite").json(f"{bad}/batch={number}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_COUNTERS = "category string, errors long, blocks long, captchas long, successes long, batch long"
_EVENTS = "category string, event_id long, ts timestamp, kind string, batch long"
_ALERTS = "category string, event_id long, ts timestamp, kind string, reached long, batch long"


def _of_batch(spark: SparkSession, table: str, name: str, number: int, schema: str) -> DataFrame | None:
    path = f"{table}/{name}/batch={number}"
    return spark.read.schema(schema).parquet(path).drop("batch") if number >= 0 and files.exists(spark, path) else None


def _by_event_time(batch: DataFrame, table: str, number: int, delay: int) -> DataFrame:
    """The events that no later one within ``delay`` seconds can come before. Newer ones wait in ``pending``; events older than what was counted go to ``late``."""
    spark = batch.sparkSession
    events = batch.select("category", "event_id", F.col("ts").cast("timestamp").alias("ts"), "kind")
    waiting = _of_batch(spark, table, "pending", number - 1, _EVENTS)
    before = files.read_text(spark, f"{table}/marks/{number - 1}") if number and files.exists(spark, f"{table}/marks/{number - 1}") else ""
    newest = events.agg(F.max(F.unix_micros("ts"))).first()[0]
    marks = [int(before)] if before else []
    marks += [newest - delay * 1_000_000] if newest is not None else []
    at = F.unix_micros("ts")
    fresh = events.where(at > int(before)) if before else events
    held = fresh if waiting is None else waiting.unionByName(fresh)
    if before:
        events.where(at <= int(before)).write.mode("overwrite").parquet(f"{table}/late/batch={number}")
    if not marks:
        return held.limit(0)
    held.where(at > max(marks)).write.mode("overwrite").parquet(f"{table}/pending/batch={number}")
    files.delete(spark, f"{table}/marks/{number}")
    files.write_text(spark, f"{table}/marks/{number}", str(max(marks)))
    return held.where(at <= max(marks))


def stream_alerts(
    events: DataFrame, table: str, checkpoint: str, errors: int = metrics.ERRORS, blocks: int = metrics.BLOCKS, captchas: int = metrics.CAPTCHAS, every: int = metrics.PROGRESS, kinds: list[str] = ("error", "block", "captcha", "progress"), delay: int | None = None
) -> StreamingQuery:
    """Error streaks, block and captcha thresholds and progress marks, appended to ``table/alerts``; four counters a category go from batch to batch.

    With a ``delay`` in seconds events are counted in the order of their time: each waits until one is seen that is newer by the delay, and
    one that comes later than that is no longer counted but kept in ``table/late``. Without, batches are counted as they arrive.
    Events are counted in slices of time, so no task holds a category's batch. A batch is one directory, overwritten if it runs again."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        ready = batch if delay is None else _by_event_time(batch, table, number, delay)
        carried = _of_batch(spark, table, "counters", number - 1, _COUNTERS)
        due = metrics.alerts(ready, errors, blocks, captchas, every, carried)
        due.where(F.col("kind").isin(list(kinds))).write.mode("overwrite").parquet(f"{table}/alerts/batch={number}")
        metrics.counters(ready, carried).write.mode("overwrite").parquet(f"{table}/counters/batch={number}")
        batch.unpersist()

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_alerts(spark: SparkSession, table: str, errors: int = metrics.ERRORS, blocks: int = metrics.BLOCKS, captchas: int = metrics.CAPTCHAS, every: int = metrics.PROGRESS, kinds: list[str] = ("error", "block", "captcha", "progress")) -> DataFrame:
    """All alerts so far, those of events that still wait included, as if nothing came any more."""
    done = spark.read.schema(_ALERTS).parquet(f"{table}/alerts").drop("batch")
    last = max((int(n.removeprefix("batch=")) for n in files.names(spark, f"{table}/counters") if n.startswith("batch=")), default=-1)
    waiting = _of_batch(spark, table, "pending", last, _EVENTS)
    if waiting is None:
        return done
    due = metrics.alerts(waiting, errors, blocks, captchas, every, _of_batch(spark, table, "counters", last, _COUNTERS))
    return done.unionByName(due.where(F.col("kind").isin(list(kinds))))


def stream_error_streaks(events: DataFrame, table: str, checkpoint: str, threshold: int = metrics.ERRORS, delay: int | None = None) -> StreamingQuery:
    return stream_alerts(events, table, checkpoint, errors=threshold, kinds=["error"], delay=delay)


def stream_threshold_alerts(events: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    return stream_alerts(events, table, checkpoint, kinds=["block", "captcha", "progress"])
