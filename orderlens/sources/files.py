"""Parquet lake scans (S3-S6, S9) and the time-range scan with partition pruning."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, prefix: str) -> DataFrame:
    """The Parquet files below `prefix`: source_file, length. Contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(prefix)
            .select(F.col("path").alias("source_file"), "length"))


def first_files(spark: SparkSession, prefix: str, n: int) -> list[str]:
    """The first N file names; only these N come to the driver."""
    return [r[0] for r in list_files(spark, prefix).orderBy("source_file").limit(n).select("source_file").collect()]


def _reader(spark: SparkSession, prefix: str, ignore_corrupt: bool):
    return (spark.read.option("pathGlobFilter", "*.parquet").option("basePath", prefix)
            .option("ignoreCorruptFiles", str(ignore_corrupt).lower()))


def scan_valid(spark: SparkSession, prefix: str, lineage: bool = False,
               limit_files: int | None = None, ignore_corrupt: bool = False, files: list[str] | None = None) -> DataFrame:
    """S3: every `*.parquet` file below `prefix`, with year/month/day recovered
    from the folder names (S9).

    lineage (S4) adds `source_file` (the file each row came from),
    `row_index` (its place there) and `loaded_at`; `limit_files` (S6) reads
    only the first N files in name order, `files` the named ones. A damaged file fails the scan;
    `ignore_corrupt` (S5) reads what can be read of it, for callers that
    compare with `load_summary` and drop such files whole.
    """
    reader = _reader(spark, prefix, ignore_corrupt)
    if limit_files is not None:
        files = first_files(spark, prefix, limit_files)
    if files is not None:
        df = reader.parquet(*files) if files else reader.parquet(prefix).limit(0)
    else:
        df = reader.parquet(prefix)
    if lineage:
        df = df.select("*", F.col("_metadata.file_path").alias("source_file"),
                       F.col("_metadata.row_index").alias("row_index"),
                       F.current_timestamp().alias("loaded_at"))
    return df


def footer_counts(spark: SparkSession, prefix: str, files: list[str] | None = None) -> DataFrame:
    """(source_file, expected): rows that each file's footer promises; no column is read."""
    df = _reader(spark, prefix, True).parquet(*(files or [prefix]))
    return df.groupBy(F.col("_metadata.file_path").alias("source_file")).agg(F.count(F.lit(1)).alias("expected"))


def _norm_path(col: str):
    """Local-file URIs come as file:/x or file:///x depending on the API."""
    return F.regexp_replace(F.col(col), "^file:/+", "file:///")


def load_summary(loaded: DataFrame, listed_files: DataFrame, footers: DataFrame | None = None) -> DataFrame:
    """S5 summary: files listed, rows read per file, and the files that failed.

    `loaded` carries `source_file` (lineage) and must be the rows as written
    (a lazy scan that only counts reads no column and sees no damage);
    `listed_files` has a column `source_file` with every file that was meant
    to load. A file failed if
    it gave no rows, or (with `footers`) fewer rows than its footer promises:
    a partly damaged file.
    """
    per_file = loaded.groupBy(_norm_path("source_file").alias("source_file")).agg(
        F.count(F.lit(1)).alias("rows"))
    out = listed_files.select(_norm_path("source_file").alias("source_file")).join(per_file, "source_file", "left")
    bad = F.col("rows").isNull()
    if footers is not None:
        out = out.join(footers.select(_norm_path("source_file").alias("source_file"), "expected"), "source_file", "left")
        bad = bad | F.col("expected").isNull() | (F.col("rows") < F.col("expected"))
    return out.select("source_file", F.coalesce(F.col("rows"), F.lit(0)).alias("rows"), bad.alias("failed"))


def whole_files(loaded: DataFrame, summary: DataFrame) -> DataFrame:
    """The rows of the files that did not fail."""
    good = summary.where("NOT failed").select(F.col("source_file").alias("_whole"))
    return loaded.join(good, _norm_path("source_file") == F.col("_whole"), "left_semi")


def partition_predicate(start: dt.datetime, end: dt.datetime):
    """Predicate on year/month/day only, true for every day touching [start, end).

    Evaluated against folder values, it lets the scan skip other days.
    """
    day = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    last = end - dt.timedelta(microseconds=1)
    return (day >= F.lit(start.date().isoformat()).cast("date")) & (
        day <= F.lit(last.date().isoformat()).cast("date"))


def scan_range(df: DataFrame, start: dt.datetime, end: dt.datetime, ts: str = "event_time") -> DataFrame:
    """Rows with start <= ts < end, plus the matching partition predicate.

    A filter on the event time alone does not prune year=/month=/day=
    folders; adding the derived partition predicate does.
    """
    lo = F.to_timestamp(F.lit(start.isoformat(sep=" ")))
    hi = F.to_timestamp(F.lit(end.isoformat(sep=" ")))
    return df.filter(partition_predicate(start, end)).filter((F.col(ts) >= lo) & (F.col(ts) < hi))
