"""Balanced shards by sampled splitters, in DataFrame operations only.

Rows are put in the order of a key: the hash of the text, then of the id, so that equal texts
stand together and a group of any size can still be cut. A sample of keys, drawn with a
chance in proportion to the rows' sizes, gives splitters at its quantiles, and the splitters
cut the rows into ranges. Ranges that turn out overfull are subdivided at even steps of the
hash. The ranges' exact sizes, summed up in order, then say where each shard begins; within
a range a running sum places each row. So no task sees more than one range (of numbers, not texts: about
40 bytes a row, sorted by Spark, which spills), and shards differ by less than two of the largest rows (law ``bytes``).

Input: ``doc_id``, ``text``. Null and empty texts have size 1; repeated rows, null ids and ties
get places of their own; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

#: Bytes aimed at in a range; bounds on the number of ranges; sampled keys for each range.
RANGE_BYTES, LEAST_RANGES, MOST_RANGES, OVERSAMPLE = 64 << 20, 64, 4096, 24


def _key(text: Column) -> Column:
    """60 bits of a hash that other systems have too, so that the order of the rows can be checked outside of Spark."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, checksum of the text and the two key columns; the texts themselves are left behind."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _key(text).alias("k1"),
        _key(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("null")), F.lit(" order"))).alias("k2"),
    )


def _lookup(spark, splitters: list[tuple[int, int]]) -> tuple[DataFrame, Column]:
    """The splitters in blocks of about the square root of their number: a small table of blocks, and the block of a key."""
    step = max(1, round(len(splitters) ** 0.5))
    blocks = [splitters[i : i + step] for i in range(0, len(splitters), step)]
    heads = F.array(*(F.struct(F.lit(a).cast("long").alias("k1"), F.lit(b).cast("long").alias("k2")) for (a, b), *_ in blocks)) if blocks else None
    block = F.size(F.filter(heads, lambda x: x <= F.struct("k1", "k2"))) if blocks else F.lit(0)
    rows = [(0, 0, [])] + [(i + 1, i * step, b) for i, b in enumerate(blocks)]
    return spark.createDataFrame(rows, "block int, before int, cuts array<struct<k1:long,k2:long>>"), block


def shards(docs: DataFrame, n_shards: int = 8, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: bytes spread evenly over ``n_shards``."""
    spark = docs.sparkSession
    rows = written(sized(docs))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    n_ranges = min(MOST_RANGES, max(LEAST_RANGES, total // range_bytes))
    # a row is drawn with a chance in proportion to its size, decided by its own hash: the same sample each time
    chance = F.col("size") * F.lit(n_ranges * OVERSAMPLE / max(total, 1))
    unit = F.shiftrightunsigned(F.xxhash64("k1", "k2", F.lit("sample")), 11) / F.lit(float(1 << 53))
    sample = sorted((r.k1, r.k2) for r in rows.where(unit < chance).select("k1", "k2").collect())
    step = max(1, len(sample) // n_ranges)
    splitters = sorted(set(sample[step::step]))
    table, block = _lookup(spark, splitters)
    cut = rows.withColumn("block", block).join(F.broadcast(table), "block")
    coarse = (F.col("before") + F.size(F.filter("cuts", lambda x: x <= F.struct("k1", "k2")))).alias("coarse")
    ranged = cut.select("doc_id", "size", "text_crc32", "k1", "k2", coarse)

    # overfull ranges: even steps of k1, or of k2 where the range holds a single text
    stats = ranged.groupBy("coarse").agg(F.sum("size").alias("bytes"), *(f(c).cast("double").alias(f"{n}_{c}") for c in ("k1", "k2") for n, f in (("lo", F.min), ("hi", F.max))))
    parts = F.greatest(F.lit(1.0), F.ceil(F.col("bytes") / F.lit(2.0 * max(total, 1) / n_ranges))).alias("parts")
    overfull = stats.withColumn("parts", parts).where("parts > 1").drop("bytes")  # at most n_ranges / 2 rows

    def step_of(c: str) -> Column:
        width = F.greatest(F.col(f"hi_{c}") - F.col(f"lo_{c}"), F.lit(1.0))
        return F.least(F.floor((F.col(c).cast("double") - F.col(f"lo_{c}")) / width * F.col("parts")), F.col("parts") - 1)

    fine = F.when(F.col("parts").isNull(), 0).when(F.col("lo_k1") < F.col("hi_k1"), step_of("k1")).otherwise(step_of("k2")).cast("int")
    placed = written(ranged.join(F.broadcast(overfull), "coarse", "left").select("doc_id", "size", "text_crc32", "k1", "k2", "coarse", fine.alias("fine")))

    # one row a range, so this window over all of them is small: at most MOST_RANGES * 1.5
    ahead = Window.orderBy("coarse", "fine").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("coarse", "fine").agg(F.sum("size").alias("b"), F.count("*").alias("n")).select("coarse", "fine", *(F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}_before") for c in ("b", "n")))
    own = Window.partitionBy("coarse", "fine").orderBy("k1", "k2", "doc_id", "text_crc32")
    running = placed.join(F.broadcast(offsets), ["coarse", "fine"]).select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("n_before") + F.row_number().over(own) - 1).alias("place"),
        (F.col("b_before") + F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("start"),
    )
    shard = F.least(F.floor((F.col("start") + F.col("size") / 2) * F.lit(n_shards) / F.lit(max(total, 1))), F.lit(n_shards - 1)).cast("int")
    out = written(running.withColumn("shard", shard))
    begins = out.groupBy("shard").agg(F.min("place").alias("first"))
    return out.join(F.broadcast(begins), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
