"""Session defaults and the shared work folder.

Results depend on the session time zone (partition days, hours), so it is
pinned to UTC. ANSI mode stays on; the edges use try_* functions.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}



def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings results depend on (safe on a live session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(key, "true")
    _let_workers_import(spark)
    return spark


def use_statistics(spark: SparkSession) -> SparkSession:
    """Let the optimizer plan by the statistics of analyzed tables (K17), join order included."""
    for key in ("spark.sql.cbo.enabled", "spark.sql.cbo.planStats.enabled", "spark.sql.cbo.joinReorder.enabled"):
        spark.conf.set(key, "true")
    return spark


def _let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, whatever their working folder.

    On a cluster whose nodes lack that folder, pass the package with --py-files.
    """
    sc = getattr(spark, "_sc", None)
    if sc is not None:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        known = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in known:
            sc.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "orderlens") -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ORDERLENS_DRIVER_MEMORY", "8g"))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables and checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (shared
    storage). Only when the session names none, as in local tests, a local
    folder is created and registered as the checkpoint dir.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext (e.g. a Connect session)
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="orderlens-ckpt-")
        if sc:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
