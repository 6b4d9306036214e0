"""Small files and folders of a table, in whatever file system Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is absent."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """A whole file or none: written under another name, then renamed. False if the name is taken."""
    fs, p = _at(spark, path)
    if fs.exists(p):
        return False
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    return fs.rename(aside, p)
