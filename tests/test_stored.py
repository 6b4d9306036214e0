"""Stored tables: versions and manifests, buckets without exchange, the seen set, sizes of files."""

import glob
import json
import os
import random
import re

from pyspark.sql import functions as F

from annonia.operators import upsert
from annonia.sources import bucketed, files, io, versions
from annonia.sources.bucketed import SeenSet
from annonia.streaming import streams

ROW = "doc_id string, event_id long, date_crawl long"


def above_scan(df, pattern):
    """Names of the plan's nodes above each scan whose line fits."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(re.match(r"[ :+\-|]*", x)[0]) for x in lines]
    found = []
    for i, line in enumerate(lines):
        if "Scan" in line and re.search(pattern, line):
            at, above = depth[i], []
            for k in range(i - 1, -1, -1):
                if depth[k] < at:
                    at = depth[k]
                    above.append(lines[k].strip(" :+-|"))
            found.append(above)
    return found


def batches(seed, n=8, size=40, ids=60):
    r = random.Random(seed)
    return [[(f"d{r.randrange(ids)}", k * size + i, r.randrange(30)) for i in range(size)] for k in range(n)]


def expected(done):
    want = {}
    for rows in done:
        newest = {}
        for doc, event, date in rows:
            newest[doc] = max(newest.get(doc, (-1, -1)), (date, event))
        want |= {doc: event for doc, (_, event) in newest.items()}
    return want


def write_batch(spark, table, rows, number, buckets=16):
    new = spark.createDataFrame(rows, ROW).withColumn("bucket", versions.bucket_of("doc_id", buckets))
    touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())
    old = versions.current(spark, table, new.drop("bucket").schema, touched, before=number)
    versions.write(upsert.upsert(old, new, tie=["event_id"]), table, number, touched)
    return touched, old


def test_versions_over_many_batches(spark, tmp_path):
    """Only touched buckets are opened, a half-written batch changes nothing, and old versions go."""
    table = str(tmp_path / "t")
    schema = spark.createDataFrame([], ROW).schema
    done = batches(1, n=6, size=6)
    for k, rows in enumerate(done):
        if k == 4:  # a try that fails before its manifest
            half = spark.createDataFrame([("d1", -1, 99)], ROW).withColumn("bucket", F.lit(0))
            half.write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/data/v=4")
            assert {r.doc_id: r.event_id for r in versions.current(spark, table, schema).collect()} == expected(done[:4])
        before = versions.manifest(spark, table)
        touched, old = write_batch(spark, table, rows, k)
        opened = {tuple(re.search(r"v=(\d+)/bucket=(\d+)", f).groups()) for f in old.inputFiles()}
        assert opened == {(str(before[b]), str(b)) for b in touched if b in before}
        versions.vacuum(spark, table, keep=2)
        assert {r.doc_id: r.event_id for r in versions.current(spark, table, schema).collect()} == expected(done[: k + 1])
    named = {(v, b) for n in files.names(spark, f"{table}/manifest") if n.isdecimal() for b, v in json.loads(files.read_text(spark, f"{table}/manifest/{n}")).items()}
    there = {tuple(re.search(r"v=(\d+)/bucket=(\d+)", f).groups()) for f in glob.glob(f"{table}/data/*/*/part-*")}
    assert {(int(v), b) for v, b in there} == named and len(files.names(spark, f"{table}/manifest")) <= 4
    # run again before its commit was known to the stream: same rows, same table
    write_batch(spark, table, done[-1], len(done) - 1)
    assert {r.doc_id: r.event_id for r in versions.current(spark, table, schema).collect()} == expected(done)


def test_stream_that_fails_and_runs_again(spark, tmp_path):
    done = batches(2, n=3)
    for k, rows in enumerate(done):
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    calls = []

    def normalize(b):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return b

    def run():
        stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        return streams.stream_normalize_upsert(stream, normalize, f"{tmp_path}/table", f"{tmp_path}/log", buckets=8)

    try:
        run().awaitTermination()
        raise AssertionError("the second batch should have failed")
    except AssertionError:
        raise
    except Exception as e:
        assert "lost" in str(e)
    run().awaitTermination()
    schema = spark.createDataFrame([], ROW).schema
    assert {x.doc_id: x.event_id for x in streams.current_table(spark, f"{tmp_path}/table", schema).collect()} == expected(done)


def test_seen_set(spark, tmp_path):
    seen = SeenSet(str(tmp_path / "seen"), buckets=8, shards=4, blocks=64)
    r = random.Random(4)
    known = set()
    for k in range(3):
        ids = [str(r.randrange(500)) for _ in range(200)] + [None]
        df = spark.createDataFrame([(i,) for i in ids], "listing_id string")
        new = seen.new_ids(df, before=k)
        got = sorted(x.listing_id for x in new.collect())
        assert got == sorted({i for i in ids if i} - known)
        seen.add(new, k)
        if k == 1:  # the batch is written twice
            assert sorted(x.listing_id for x in seen.new_ids(df, before=k).collect()) == got
            seen.add(seen.new_ids(df, before=k), k)
        known |= {i for i in ids if i}
    assert {x.listing_id for x in seen.stored(spark).collect()} == known
    plan = seen.new_ids(spark.createDataFrame([("5",), ("x",)], "listing_id string").union(seen.stored(spark).select("listing_id")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = spark.createDataFrame([(str(i),) for i in range(300)], "listing_id string")
        stored = above_scan(seen.new_ids(df), r"annonia_.*listing_id")
        assert stored and not any("Exchange" in n for above in stored for n in above)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.where("listing_id = 'x'").count() == 1


def test_filter_rarely_errs(spark, tmp_path):
    """At ten bits an id under two in a hundred new ids are looked up in vain; ids in the set never pass as new."""
    seen = SeenSet(str(tmp_path / "seen"), buckets=4, shards=4, blocks=200)
    ids = spark.range(40_000).select(F.concat(F.lit("https://x/"), F.col("id").cast("string")).alias("listing_id"))
    seen.add(seen.new_ids(ids))
    other = spark.range(40_000, 80_000).select(F.concat(F.lit("https://x/"), F.col("id").cast("string")).alias("listing_id"))
    assert seen.marked(ids).where("not maybe").isEmpty()
    assert seen.marked(other).where("maybe").count() < 800


def test_stored_upsert_moves_the_batch_only(spark, tmp_path):
    r = random.Random(6)
    schema = "doc_id string, row_id long, date_crawl long, date_depot string, site string"
    rows = [(f"d{r.randrange(80)}", i, r.randrange(20), r.choice(["", None, f"t{i}"]), r.choice("ab")) for i in range(300)]
    parts = [spark.createDataFrame(rows[k::3], schema) for k in range(3)]
    keep = F.col("site") == "a"
    table, plain = str(tmp_path / "t"), spark.createDataFrame([], schema)
    for part in parts:
        plain = upsert.upsert_keep_first_date(plain, part, keep, tie=["row_id"])
        state = upsert.upsert_stored(table, part, keep, buckets=8, tie=["row_id"])
        assert sorted(map(repr, map(tuple, state.collect()))) == sorted(map(repr, map(tuple, plain.collect())))
    assert all(len(glob.glob(f"{v}/*_{b:05d}.c*")) <= 1 for v in glob.glob(f"{table}/v=*") for b in range(8))
    assert len(glob.glob(f"{table}/v=*")) == 2
    current = upsert.stored_listings(spark, table, plain.schema, buckets=8)
    joined = upsert.upsert_keep_first_date(current, parts[0], keep, tie=["row_id"])
    stored = above_scan(joined, r"annonia_")
    assert len(stored) == 1 and not any("Exchange" in n for n in stored[0])


def test_bucketed_tables_are_found_again(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), "id")
    bucketed.append(rows.repartition(4, "k"), str(tmp_path / "b"), "k", 4)
    bucketed.append(rows.repartition(4, "k"), str(tmp_path / "b"), "k", 4)
    again = bucketed.opened(spark.newSession(), str(tmp_path / "b"), rows.schema, "k", 4)
    assert again.count() == 200 and again.groupBy("k").count().where("count = 2").count() == 100


def test_files_keep_to_a_size(spark, tmp_path):
    """One site has nine rows in ten: it becomes several files near the advisory size, the small sites one each."""
    words = F.sha2(F.col("id").cast("string"), 256)
    df = spark.range(60_000).select("id", words.alias("text"), F.lit("c").alias("category"), F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 70).cast("string"))).alias("site"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        io.write_by_category_site(df.repartition(16), str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sizes = {}
    for f in glob.glob(f"{tmp_path}/t/category=c/*/part-*"):
        sizes.setdefault(re.search("site=([^/]*)", f)[1], []).append(os.path.getsize(f))
    assert len(sizes) == 8 and len(sizes["hot"]) >= 4 and max(sizes["hot"]) < 1_200_000
    assert all(len(v) <= 2 for k, v in sizes.items() if k != "hot")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000
