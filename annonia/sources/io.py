"""Readers and writers of pages, listings and logs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import pages
from ..functions.base import take

LOG_SCHEMA = "timestamp string, level string, logger string, message string, category string, site string, url string"


def new_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared one; a temporary one only where none is set on a single machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = f"file://{tempfile.mkdtemp(prefix='annonia-')}"
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page snapshots: Parquet, or JSON lines where the path says so."""
    return spark.read.schema("page_id long, url string, html string").json(path) if path.rstrip("/").endswith((".json", ".jsonl")) else spark.read.parquet(path)


def _schema(category_or_schema) -> T.StructType:
    return schemas.schema(category_or_schema) if category_or_schema in schemas.FIELDS else T._parse_datatype_string(category_or_schema) if isinstance(category_or_schema, str) else category_or_schema


def read_listings_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    """One object a line; lines that don't parse are kept in ``_corrupt_record``."""
    wanted = T.StructType([*_schema(schema).fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(wanted).option("mode", "PERMISSIVE").json(path)


def read_listings_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """One pretty-printed document or array a file."""
    return spark.read.schema(_schema(schema)).option("multiLine", True).json(path)


def read_listings_csv(spark: SparkSession, path: str, list_columns: list[str] = ()) -> DataFrame:
    """CSV with header; lists written as text (``['a', "l'eau"]`` or JSON) are arrays again. A quoted empty field is empty text, an unquoted one null."""
    df = spark.read.option("header", True).option("nullValue", "\0").option("multiLine", True).option("escape", '"').csv(path)
    return df.withColumns({c: pages.list_items(F.col(c)) for c in list_columns})


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_by_category_site(df: DataFrame, path: str) -> None:
    """A directory for each category and site, in files near the advisory size: adaptive execution splits a hot site by bytes and lets small ones share a task."""
    df.hint("rebalance", "category", "site").write.mode("append").partitionBy("category", "site").parquet(path)


def write_csv(df: DataFrame, path: str, fields: list[str]) -> None:
    """A fixed list of fields; arrays and maps as JSON text."""
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    df.select(*(F.to_json(f).alias(f) if f in nested else F.col(f) for f in fields)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def split_failed(df: DataFrame, valid) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that fail a condition; unknown counts as failed."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)


def write_dead_letter(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_log_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).json(path)


def parse_log_text(df: DataFrame, column: str = "value", keep: list[str] = ()) -> DataFrame:
    """'[time] [level] [logger] message' lines as columns; other lines have nulls and their whole text as message."""
    pattern = r"^\[([^\]]+)\] \[([^\]]+)\] \[([^\]]+)\] (.*)$"
    line = F.col(column)
    return df.select(
        *keep, F.try_to_timestamp(take(line, pattern, 1), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"), take(line, pattern, 2).alias("level"), take(line, pattern, 3).alias("logger"), F.coalesce(take(line, pattern, 4), line).alias("message")
    )
