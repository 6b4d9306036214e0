"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of sessions without ``spark.checkpoint.dir``, by application.
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only where that is unset on a single machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = f"file://{tempfile.mkdtemp(prefix='annonia-')}"
    return _own[app]


def _new_path(df: DataFrame) -> str:
    return f"{shared_folder(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder and read back, which cuts its lineage.

    Unlike a local checkpoint it survives the loss of any executor."""
    path = _new_path(df)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, n: int, key: str, name: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder with ``n`` buckets by ``key``: groups by that key need no shuffle of it.

    With the ``name`` of such a table, the rows are appended to it."""
    name = name or new_name()
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}"
    df.write.mode("append").bucketBy(n, key).option("path", path).option("compression", "zstd").saveAsTable(name)
    return df.sparkSession.table(name)


def new_name() -> str:
    return f"annonia_{uuid.uuid4().hex}"
