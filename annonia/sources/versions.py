"""Versioned tables: a batch rewrites the buckets it touches, and a manifest, written last, makes them current.

    table/data/v=N/bucket=B/...    rows of bucket B as batch N left them
    table/manifest/N               version of every bucket after batch N (JSON, one number a bucket)

A batch reads the buckets it touches from the versions that the last manifest names, writes them as version N
and then its manifest, by a rename. A batch that fails before leaves files that no manifest names; run again it
overwrites them. A batch whose manifest exists is done and is not run again. Readers take the paths from
one manifest, so they open no old file and see whole batches only. ``vacuum`` removes versions that the last
manifests don't name. Buckets are a hash of the key; the manifest has as many numbers as buckets."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from . import files


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, table: str, before: int | None = None) -> dict[int, int]:
    """The version of each bucket after the last batch (before batch ``before``); empty for a new table."""
    done = [int(n) for n in files.names(spark, f"{table}/manifest") if n.isdecimal() and (before is None or int(n) < before)]
    if not done:
        return {}
    return {int(b): v for b, v in json.loads(files.read_text(spark, f"{table}/manifest/{max(done)}")).items()}


def committed(spark: SparkSession, table: str, number: int) -> bool:
    return files.exists(spark, f"{table}/manifest/{number}")


def current(spark: SparkSession, table: str, schema: StructType, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
    """The rows of all or of some buckets, with the column ``bucket``; only their files are opened."""
    versions = manifest(spark, table, before)
    wanted = versions if buckets is None else {b: versions[b] for b in buckets if b in versions}
    full = StructType([*schema.fields, StructField("bucket", IntegerType()), StructField("v", LongType())])
    paths = [f"{table}/data/v={v}/bucket={b}" for b, v in sorted(wanted.items())]
    rows = spark.read.schema(full).option("basePath", f"{table}/data").parquet(*paths) if paths else spark.createDataFrame([], full)
    return rows.drop("v")


def write(rows: DataFrame, table: str, number: int, touched: list[int]) -> None:
    """``rows`` (with ``bucket``) as version ``number`` of the touched buckets; a bucket that has become empty is forgotten."""
    spark = rows.sparkSession
    sized = rows.hint("rebalance", "bucket")  # large buckets become several files, small ones share a task
    sized.write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/data/v={number}")
    written = {int(n.removeprefix("bucket=")) for n in files.names(spark, f"{table}/data/v={number}") if n.startswith("bucket=")}
    versions = {b: v for b, v in manifest(spark, table, number).items() if b not in touched} | {b: number for b in written}
    files.write_text(spark, f"{table}/manifest/{number}", json.dumps(versions))


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Removes what the last ``keep`` manifests don't name. Readers that began before those lose their files."""
    done = sorted(int(n) for n in files.names(spark, f"{table}/manifest") if n.isdecimal())
    if not done:
        return
    named = {(v, b) for n in done[-keep:] for b, v in json.loads(files.read_text(spark, f"{table}/manifest/{n}")).items()}
    for name in files.names(spark, f"{table}/data"):
        v = int(name.removeprefix("v=")) if name.startswith("v=") else None
        if v is None or v > done[-1]:  # a later batch may be at work there
            continue
        inside = [b for b in files.names(spark, f"{table}/data/{name}") if b.startswith("bucket=")]
        old = [b for b in inside if (v, b.removeprefix("bucket=")) not in named]
        for b in [""] if len(old) == len(inside) else [f"/{b}" for b in old]:
            files.delete(spark, f"{table}/data/{name}{b}")
    for n in done[:-keep]:
        files.delete(spark, f"{table}/manifest/{n}")
