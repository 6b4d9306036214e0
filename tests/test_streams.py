"""Streams over several micro-batches give what one batch gives."""

import random

from pyspark.sql import functions as F

from annonia.operators import metrics
from annonia.streaming import streams

_EVENTS = "event_id long, ts timestamp, category string, kind string"


def _files(spark, rows, schema, path, n):
    step = -(-len(rows) // n)
    for k in range(n):
        spark.createDataFrame(rows[k * step : (k + 1) * step], schema).coalesce(1).write.mode("append").parquet(path)


def test_alerts_over_batches(spark, tmp_path):
    r = random.Random(2)
    rows = spark.range(900).select(F.col("id").alias("event_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 997).alias("ts")).collect()
    rows = [(x.event_id, x.ts, r.choice("ab") if x.event_id < 700 else "c", "error" if r.random() < 0.8 else r.choice(["success", "block", "captcha"])) for x in rows]
    _files(spark, rows, _EVENTS, f"{tmp_path}/in", 4)
    stream = spark.readStream.schema(_EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    streams.stream_alerts(stream, f"{tmp_path}/table", f"{tmp_path}/log", errors=3, blocks=4, captchas=5, every=6).awaitTermination()
    got = sorted(map(tuple, streams.read_alerts(spark, f"{tmp_path}/table").select("event_id", "kind", "reached").collect()))
    want, state = [], {}
    for event, _, category, kind in rows:
        c = state.setdefault(category, dict.fromkeys(("error", "block", "captcha", "success"), 0))
        c[kind] += 1
        if kind == "success":
            c["error"] = 0
        n = {"error": 3, "block": 4, "captcha": 5, "success": 6}[kind]
        if c[kind] % n == 0:
            want.append((event, "progress" if kind == "success" else kind, c[kind]))
    assert got == sorted(want) and len({k for _, k, _ in want}) == 4
    whole = metrics.alerts(spark.createDataFrame(rows, _EVENTS), 3, 4, 5, 6)
    assert sorted(map(tuple, whole.select("event_id", "kind", "reached").collect())) == got


def test_upsert_over_batches(spark, tmp_path):
    r = random.Random(3)
    rows = [(f"d{r.randrange(60)}", i, r.randrange(40)) for i in range(400)]
    schema = "doc_id string, event_id long, date_crawl long"
    _files(spark, rows, schema, f"{tmp_path}/in", 4)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    streams.stream_normalize_upsert(stream, lambda b: b, f"{tmp_path}/table", f"{tmp_path}/log", buckets=8).awaitTermination()
    table = spark.read.parquet(f"{tmp_path}/in")
    got = {x.doc_id: x.event_id for x in streams.current_table(spark, f"{tmp_path}/table", table.schema).collect()}
    want = {}
    for k in range(4):  # the batch's latest takes the place of what was there
        newest = {}
        for doc, event, date in rows[k * 100 : (k + 1) * 100]:
            newest[doc] = max(newest.get(doc, (-1, -1)), (date, event))
        want |= {doc: event for doc, (_, event) in newest.items()}
    assert got == want


def test_new_listings_within_the_delay(spark, tmp_path):
    """A repeat within the delay is dropped, one after it is new again, and an event older than the watermark is late."""
    hour = 3600
    batches = [[("a", 0), ("a", hour // 6), (None, 0)], [("b", 5 * hour)], [("a", 60), ("c", 5 * hour), ("b", 5 * hour + 60)], [("a", 6 * hour)], [("a", 6 * hour + 60)]]
    for rows in batches:
        df = spark.createDataFrame(rows, "listing_id string, at long").select("listing_id", F.timestamp_seconds(1_700_000_000 + F.col("at")).alias("ts"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("listing_id string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    fresh = streams.stream_new_listings(stream, "1 hour").select("listing_id", ((F.unix_timestamp("ts") - 1_700_000_000) / hour).cast("int").alias("hour"))
    out = f"{tmp_path}/out"
    fresh.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/log").trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.read.schema(fresh.schema).parquet(out).collect())) == [("a", 0), ("a", 6), ("b", 5), ("c", 5)]
