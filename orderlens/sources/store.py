"""Questions to the file system that holds a path (any scheme Spark can reach)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scheme(spark: SparkSession, path: str) -> str:
    """Scheme of the file system that holds a path."""
    return _at(spark, path)[0].getUri().getScheme()


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none if it is missing."""
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path and what is below it; a missing path is no error."""
    fs, at = _at(spark, path)
    fs.delete(at, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file in one step: it is there whole or not at all."""
    fs, at = _at(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, at):
        raise FileExistsError(path)


def date_in_order(spark: SparkSession, folder: str, files: list[str]) -> None:
    """Give the files of a folder modification times a second apart, the last one now."""
    fs, at = _at(spark, folder)
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    for k, name in enumerate(reversed(files)):
        fs.setTimes(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at, name), now - 1000 * k, -1)
