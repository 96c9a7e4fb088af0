"""The batch load (one Spark job per step, no per-file driver loop):

files the ledger has not seen (S5, `load_new_files`) or the whole lake (`load_lake`)
-> scan lake (S3, S4 lineage) -> drop damaged files whole and report them (S5)
-> conform to raw.orders (P9-P11) -> constraint gate (Q13)
-> insert-if-absent on order_id (K5) -> totals (A9).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import conform, load, profile
from orderlens.schemas import RAW_ORDERS
from orderlens.session import scratch_path
from orderlens.sinks import writers
from orderlens.sources.files import first_files, footer_counts, list_files, load_summary, scan_valid, whole_files


@dataclass
class LoadResult:
    """Rows inserted, rows rejected (with reasons), totals of the target, and the file summary."""

    inserted: int
    rejected: DataFrame
    totals: DataFrame
    files: DataFrame


def load_lake(spark: SparkSession, lake_prefix: str, target_path: str | None = None, limit_files: int | None = None,
              partition_by=None, target_table: str | None = None, buckets: int | None = None,
              quarantine: str | None = None, analyze: bool = False) -> LoadResult:
    """Load the lake into raw.orders: a Parquet path (a new one is partitioned by
    day) or a catalog table bucketed by order_id (`target_table`).

    An existing target keeps its own layout. Each file is read once into the
    work folder and counts only if it gave all rows its footer promises.
    Rejected rows are kept in the Parquet folder `quarantine` (the work
    folder's, if none is named). `analyze` refreshes the table's statistics.
    """
    scanned = scan_valid(spark, lake_prefix, lineage=True, limit_files=limit_files, ignore_corrupt=True)
    listed = list_files(spark, lake_prefix)
    if limit_files is not None:
        chosen = [(f,) for f in first_files(spark, lake_prefix, limit_files)]
        listed = spark.createDataFrame(chosen, "source_file string")
    return _load(spark, scanned, listed, footer_counts(spark, lake_prefix), target_path, partition_by, target_table, buckets,
                 quarantine or scratch_path(spark, "load_rejected"), "append", analyze)


def _load(spark: SparkSession, scanned: DataFrame, listed: DataFrame, footers: DataFrame, target_path, partition_by, target_table,
          buckets, kept: str, kept_mode: str, analyze: bool) -> LoadResult:
    staged_path = scratch_path(spark, "load_staged")
    scanned.write.parquet(staged_path)
    staged = spark.read.schema(scanned.schema).parquet(staged_path)
    summary_path = scratch_path(spark, "load_summary")
    load_summary(staged, listed, footers).write.parquet(summary_path)
    summary = spark.read.parquet(summary_path)

    rows = conform.to_warehouse(whole_files(staged, summary), columns=RAW_ORDERS.fieldNames(), keep=("row_index",), unfit=True)
    accepted, rejected = load.split_gate(rows, not_null=load.RAW_NOT_NULL, checks=load.CHECKS + load.WIDTHS)
    rejected.write.mode(kept_mode).parquet(kept)
    if target_table:
        inserted = load.insert_if_absent_table(spark, accepted, target_table, buckets=buckets, partition_by=partition_by)
        target = spark.table(target_table)
        if analyze:
            writers.analyze(spark, target_table)
    else:
        if partition_by is None and load.target_layout(spark, target_path) is None:
            partition_by = load.RAW_LAYOUT
        inserted = load.insert_if_absent(spark, accepted, target_path, partition_by=partition_by)
        target = spark.read.parquet(target_path)
    return LoadResult(inserted=inserted, rejected=spark.read.schema(rejected.schema).parquet(kept),
                      totals=profile.order_totals(target), files=summary)


#: Columns of the file listing; the content is never read.
_LISTING = "path string, modificationTime timestamp, length long, content binary"
_FILES = "source_file string, rows long, failed boolean, load_batch long"


def load_new_files(spark: SparkSession, lake_prefix: str, ledger: str, target_path: str | None = None, target_table: str | None = None,
                   buckets: int | None = None, max_files: int = 10_000) -> LedgerLoad:
    """Load the files of the lake that no earlier load has taken; each is read once.

    The ledger is the log that Spark's file stream keeps in its checkpoint: a
    stream over the folder's listing (names and lengths) hands each new file to
    one micro-batch, at most `max_files` names at a time, and a batch that a
    crash left unfinished comes again with the same files. Such a delivery inserts nothing twice
    (insert-if-absent) and replaces its summary and its rejected rows, which
    stay below the ledger: `files/load_batch=N` and `rejected/load_batch=N`.
    A damaged file is dropped whole, listed as failed and not tried again
    until it is replaced under another name.
    """
    listing = (spark.readStream.format("binaryFile").schema(_LISTING).option("pathGlobFilter", "*.parquet")
               .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(max_files)).load(lake_prefix).select("path"))
    done: list[LoadResult] = []
    batches: list[int] = []

    def take(batch: DataFrame, batch_id: int) -> None:
        files = [r.path for r in batch.collect()]  # at most max_files names
        if not files:
            return
        listed = spark.createDataFrame([(f,) for f in files], "source_file string")
        rejected = f"{ledger}/rejected/load_batch={batch_id}"
        try:
            scanned = scan_valid(spark, lake_prefix, lineage=True, ignore_corrupt=True, files=files)
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            found = listed.select("source_file", F.lit(0).cast("long").alias("rows"), F.lit(True).alias("failed"))  # no file has a footer
        else:
            res = _load(spark, scanned, listed, footer_counts(spark, lake_prefix, files), target_path, None, target_table, buckets,
                        rejected, "overwrite", False)
            done.append(res)
            found = res.files
        found.write.mode("overwrite").parquet(f"{ledger}/files/load_batch={batch_id}")
        batches.append(batch_id)

    query = listing.writeStream.foreachBatch(take).option("checkpointLocation", f"{ledger}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    files = spark.read.schema(_FILES).parquet(f"{ledger}/files") if batches else spark.createDataFrame([], _FILES)
    return LedgerLoad(inserted=sum(r.inserted for r in done), files=files.where(F.col("load_batch").isin(batches)),
                      progress=list(query.recentProgress))


@dataclass
class LedgerLoad:
    """What one load added: rows inserted, the files it took with their rows, the stream's reports."""

    inserted: int
    files: DataFrame
    progress: list


def file_totals(files: DataFrame) -> DataFrame:
    """The load summary in one row: files listed, rows read from whole files, files that failed."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum(F.when(F.col("failed"), 0).otherwise(F.col("rows"))).alias("rows"),
                     F.count_if("failed").alias("failed_files"))
