import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from orderlens.session import SESSION_DEFAULTS, configure

    base = tempfile.mkdtemp(prefix="orderlens-tests-")
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("orderlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", os.path.join(base, "warehouse"))
        .config("spark.driver.memory", "4g")
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(os.path.join(base, "checkpoints"))
    configure(session)
    yield session
    session.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
