"""Vocabularies as tables: entries with versions, to which a site can add its own as data.

``kind, key, value, version``; of equal keys the latest version counts, of equal versions the least value. A table is
joined on its distinct keys, so no row is lost or doubled; Spark's own size check decides whether it is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.base import text

SCHEMA = "kind string, key string, value string, version int"
#: Entries that come with the library, by kind; keys are compared trimmed and in lower case.
BUILT_IN = {"fuel": vocab.FUEL, "domain": vocab.DOMAINS | vocab.DOMAINS_2, "diploma": vocab.DIPLOMAS, "contract": vocab.CONTRACTS, "city": vocab.CITIES, "experience": vocab.EXPERIENCE_A | vocab.EXPERIENCE_B, "property": vocab.PROPERTY_ALIASES | {t: t for t in vocab.PROPERTY_TYPES}}


def key_of(col: Column) -> Column:
    return F.lower(F.trim(text(col)))


def built_in(spark: SparkSession) -> DataFrame:
    """The library's own entries, as version 0."""
    return spark.createDataFrame([(kind, k, v, 0) for kind, table in BUILT_IN.items() for k, v in table.items()], SCHEMA)


def vocabulary(entries: DataFrame, kind: str, as_of: int | None = None) -> DataFrame:
    """(key, value) of a kind; entries later than version ``as_of`` are left out. An entry without a value takes its key out."""
    of_kind = entries.where((F.col("kind") == kind) & F.col("key").isNotNull())
    of_kind = of_kind if as_of is None else of_kind.where(F.col("version") <= as_of)
    best = F.min_by("value", F.struct(-F.coalesce("version", F.lit(0)), "value")).alias("value")
    return of_kind.groupBy(key_of(F.col("key")).alias("key")).agg(best).where("value is not null")


def translate(df: DataFrame, column: str, words: DataFrame, out: str, default: Column | None = None) -> DataFrame:
    """``df`` with the value of ``column`` in a vocabulary as ``out``; for unknown keys the default, or else null."""
    named = words.select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    joined = df.join(named, key_of(df[column]) == F.col("_key"), "left")
    return joined.withColumn(out, F.coalesce("_value", F.lit(None) if default is None else default)).drop("_key", "_value")


def unknown_keys(df: DataFrame, column: str, words: DataFrame) -> DataFrame:
    """(key, n) of the keys that a vocabulary lacks, with how many rows have each: what a site may want to add."""
    counted = df.groupBy(key_of(df[column]).alias("key")).agg(F.count("*").alias("n")).where("key <> ''")
    return counted.join(words.select("key"), "key", "left_anti")
