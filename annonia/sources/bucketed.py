"""Tables stored in Spark's buckets, which a batch joins without an exchange of what is stored.

A bucketed table is known by its folder; ``opened`` registers it in the session's catalog with its bucketing, so
any session finds it. A join or an anti-join on the key then moves the batch alone.

``SeenSet`` keeps ids, appended batch by batch, with a Bloom filter beside each shard. The filter is
in blocks of eight words: an id has one block and a bit in each of its words, so a probe is one row of a join. Ids that the
filter doesn't know are new; for the others the exact anti-join reads the shards in which they may be."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import files


def register(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int, partition: str | None = None) -> str:
    """The catalog's name of the bucketed table in a folder; its files name their buckets, the catalog gets the rest from here."""
    name = f"annonia_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY (`{partition}`) " if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by}CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    if partition:
        files.make_folder(spark, path)
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return name


def opened(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int, partition: str | None = None) -> DataFrame:
    return spark.table(register(spark, path, schema, key, buckets, partition))


def append(rows: DataFrame, path: str, key: str, buckets: int, partition: str | None = None) -> None:
    """Appends rows that stand together by the key in as many tasks as there are buckets, so that a bucket gets one file (in each partition)."""
    name = register(rows.sparkSession, path, rows.schema, key, buckets, partition)
    writer = rows.write.mode("append").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.partitionBy(partition) if partition else writer).saveAsTable(name)


WORDS = 8


@dataclass
class SeenSet:
    """A set of ids in a folder: ``ids`` in shards and buckets, ``filter`` with the blocks that each batch set."""

    path: str
    key: str = "listing_id"
    buckets: int = 64
    shards: int = 64
    #: Blocks of 512 bits of a shard's filter: at ten bits an id these 2^14 serve 800,000 ids a shard.
    blocks: int = 1 << 14

    def _schema(self) -> StructType:
        return StructType.fromDDL(f"{self.key} string, batch long, shard int")

    def _places(self, ids: DataFrame) -> DataFrame:
        """Each id's shard, block and bits."""
        h, g = F.xxhash64(self.key), F.xxhash64(self.key, F.lit("bits"))
        one = F.lit(1).cast("long")
        words = [F.call_function("shiftleft", one, F.call_function("shiftrightunsigned", g, F.lit(6 * i)).bitwiseAND(F.lit(63)).cast("int")).alias(f"w{i}") for i in range(WORDS)]
        shard = F.pmod(h, F.lit(self.shards)).cast("int").alias("shard")
        block = F.pmod(F.call_function("shiftrightunsigned", h, F.lit(20)), F.lit(self.blocks)).cast("int").alias("block")
        return ids.select("*", shard, block, *words)

    def stored(self, spark: SparkSession, before: int | None = None, shards: list[int] | None = None) -> DataFrame:
        """The ids (of batches before one, in some shards), still in their buckets."""
        if not files.exists(spark, f"{self.path}/ids"):
            return spark.createDataFrame([], self._schema())
        rows = opened(spark, f"{self.path}/ids", self._schema(), self.key, self.buckets, "shard")
        rows = rows if shards is None else rows.where(F.col("shard").isin(shards))
        return rows if before is None else rows.where(F.col("batch") < before)

    def _filter(self, spark: SparkSession, shards: list[int], before: int | None) -> DataFrame:
        kinds = f"block int, {', '.join(f'w{i} long' for i in range(WORDS))}, shard int, batch long"
        if not files.exists(spark, f"{self.path}/filter"):
            return spark.createDataFrame([], kinds)
        rows = spark.read.schema(kinds).parquet(f"{self.path}/filter").where(F.col("shard").isin(shards))
        rows = rows if before is None else rows.where(F.col("batch") < before)
        return rows.groupBy("shard", "block").agg(*(F.bit_or(f"w{i}").alias(f"f{i}") for i in range(WORDS)))

    def marked(self, ids: DataFrame, before: int | None = None) -> DataFrame:
        """Distinct non-null ids with ``maybe``: whether the filter can't rule the id out."""
        spark = ids.sparkSession
        placed = self._places(ids.where(F.col(self.key).isNotNull()).select(self.key).distinct())
        touched = [r.shard for r in placed.select("shard").distinct().collect()]  # at most ``shards``
        blocks = self._filter(spark, touched, before)
        if "f0" not in blocks.columns:
            return placed.withColumn("maybe", F.lit(False))
        known = reduce(Column.__and__, (F.col(f"w{i}").bitwiseAND(F.coalesce(f"f{i}", F.lit(0).cast("long"))) == F.col(f"w{i}") for i in range(WORDS)))
        return placed.join(blocks, ["shard", "block"], "left").withColumn("maybe", known).drop(*(f"f{i}" for i in range(WORDS)))

    def new_ids(self, ids: DataFrame, before: int | None = None) -> DataFrame:
        """Distinct ids that are not in the set, with their places in it."""
        marked = self.marked(ids, before)
        doubtful = [r.shard for r in marked.where("maybe").select("shard").distinct().collect()]
        if not doubtful:
            return marked
        stored = self.stored(ids.sparkSession, before, doubtful).select(self.key)
        # shards without doubt give no stored row, and ids without doubt find none, so one anti-join serves all
        return marked.join(stored, self.key, "left_anti")

    def add(self, new: DataFrame, batch: int = 0) -> None:
        """Appends the result of ``new_ids`` under a batch's number; run again for the same number it adds the same ids, which changes no answer."""
        spark = new.sparkSession
        dealt = new.select(self.key, F.lit(batch).cast("long").alias("batch"), "shard").repartition(self.buckets, self.key)
        append(dealt, f"{self.path}/ids", self.key, self.buckets, "shard")
        added = self._places(self.stored(spark).where(F.col("batch") == batch).select(self.key, "batch"))
        bits = added.groupBy("batch", "shard", "block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))
        bits.write.mode("append").partitionBy("shard").parquet(f"{self.path}/filter")
