"""Large window state and what can be seen of it (W3, W6, W8), and quick checkpoints.

`large_state` starts queries with the RocksDB state store and changelog
checkpoints: state lies on the executors' disks, not in their heaps, and a commit uploads
what changed instead of a snapshot. `open_windows` reads a query's checkpoint
with the state data source, `late_groups` counts what the watermark
dropped by the progress reports, so both can be held against the rows.
`quick_checkpoints` is for queries of very many micro-batches on a local disk.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.store import scheme

LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_FILE_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
_BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


def large_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; a query takes its settings when it starts."""
    return _settings(spark, LARGE_STATE)


def quick_checkpoints(spark: SparkSession, checkpoint: str):
    """Queries started inside write a checkpoint on a local disk by the file system's own rename.

    Spark's default manager starts several processes a log file there (25 ms each of two files
    a micro-batch). Other file systems, a manager that the session names and Sparks without this one keep theirs.
    """
    ours = (scheme(spark, checkpoint) == "file" and not spark.conf.get(_FILE_MANAGER, None)
            and spark.sparkContext._jvm.org.apache.spark.util.Utils.classIsLoadable(_BY_FILE_SYSTEM))
    return _settings(spark, {_FILE_MANAGER: _BY_FILE_SYSTEM} if ours else {})


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(window_start, window_end, product_category) of the windows that a query still holds in state."""
    state = spark.read.format("statestore").load(checkpoint)
    window, category = state.schema["key"].dataType.fieldNames()
    return state.select(F.col("key")[window]["start"].alias("window_start"), F.col("key")[window]["end"].alias("window_end"),
                        F.col("key")[category].alias("product_category"))


def late_groups(progress: Iterable[dict]) -> int:
    """Groups of late rows, (window, category) by micro-batch and task, that the watermark dropped."""
    return sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])
