"""One record per listing: latest version, upsert, routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import bucketed, files


def latest_per_doc(df: DataFrame, key: str, order: list[str], tie: list[str]) -> DataFrame:
    """Last write wins; ``tie`` settles equal times. A maximum of structs, so hot keys shrink before the shuffle.

    Rows without a key are no versions of each other: all stay."""
    rest = [c for c in df.columns if c != key]
    rank = [F.col(c) for c in (*order, *tie)]
    best = F.max_by(F.struct(*rest), F.struct(*rank)).alias("_row")
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).alias("_alone")
    return df.groupBy(key, alone).agg(best).select(*(F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns))


def upsert(current: DataFrame, batch: DataFrame, key: str = "doc_id", order: list[str] = ("date_crawl",), tie: list[str] = ("row_id",)) -> DataFrame:
    """``current`` with the batch's records in place of those of the same id; of several in the batch the latest. Rows without an id stay as they are."""
    new = latest_per_doc(batch, key, order, tie)
    return current.join(new.select(key), key, "left_anti").select(new.columns).unionByName(new)


def upsert_keep_first_date(current: DataFrame, batch: DataFrame, keep: Column, key: str = "doc_id", date: str = "date_depot", order: list[str] = ("date_crawl",), tie: list[str] = ("row_id",)) -> DataFrame:
    """Upsert where rows for which ``keep`` holds retain the stored date, if that is not empty: one full join on the key does both. Rows without an id stay as they are."""
    new = latest_per_doc(batch, key, order, tie)
    columns = new.columns
    old = current.select(F.col(key).alias("_key"), F.struct(*columns).alias("_old"))
    both = old.join(new.withColumns({"_keep": keep, "_new": F.lit(True)}), F.col("_key") == F.col(key), "full_outer")
    is_new = F.col("_new").isNotNull()
    out = []
    for c in columns:
        value = F.when(is_new, F.col(c)).otherwise(F.col(f"_old.{c}"))
        if c == date:
            stored = F.when(F.col(f"_old.{c}").cast("string") != "", F.col(f"_old.{c}"))
            value = F.when(is_new & F.coalesce("_keep", F.lit(False)), F.coalesce(stored, F.col(c))).otherwise(value)
        out.append(value.alias(c))
    return both.select(*out)


def upsert_stored(table: str, batch: DataFrame, keep: Column, key: str = "doc_id", buckets: int = 64, **order: object) -> DataFrame:
    """``upsert_keep_first_date`` on a table that is stored in buckets by the key, in ``table/v=N``: only the batch is exchanged.

    The new state is written bucket by bucket beside the old one and then named in ``table/versions``; so a batch that
    fails leaves the table as it was. The version before the last stays for its readers; older ones are removed. An
    absent table counts as empty. Gives the new state."""
    spark = batch.sparkSession
    done = [int(n) for n in files.names(spark, f"{table}/versions") if n.isdecimal()]
    last = max(done, default=0)
    current = stored_listings(spark, table, batch.schema, key, buckets)
    state = upsert_keep_first_date(current, batch, keep, key, **order)
    files.delete(spark, f"{table}/v={last + 1}")
    bucketed.append(state if done else state.repartition(buckets, key), f"{table}/v={last + 1}", key, buckets)
    files.write_text(spark, f"{table}/versions/{last + 1}", "")
    for n in sorted(done)[:-1]:
        files.delete(spark, f"{table}/v={n}")
        files.delete(spark, f"{table}/versions/{n}")
    return bucketed.opened(spark, f"{table}/v={last + 1}", state.schema, key, buckets)


def stored_listings(spark: SparkSession, table: str, schema: StructType, key: str = "doc_id", buckets: int = 64) -> DataFrame:
    """The last whole state of a table of ``upsert_stored``."""
    done = [int(n) for n in files.names(spark, f"{table}/versions") if n.isdecimal()]
    return bucketed.opened(spark, f"{table}/v={max(done)}", schema, key, buckets) if done else spark.createDataFrame([], schema)


def first_of(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first record of each key by ``order``: a minimum of structs, which map tasks reduce. Records without a key count as one key."""
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(first).select(*(F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns))


def dedupe_by_name(df: DataFrame, name: str = "titre", order: list[str] = ("pos",)) -> DataFrame:
    """First record of each title in input order."""
    return first_of(df, name, order)


def route_to_table(df: DataFrame, path: str) -> None:
    """Appends to a table by category, in files near the advisory size: a large category is several tasks, small ones share one."""
    df.hint("rebalance", "category").write.mode("append").partitionBy("category").parquet(path)


def union_sites(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
