"""The ledger of loaded files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from orderlens.plans.load_job import file_totals, load_new_files
from orderlens.plans.order_flow import lake_rows
from orderlens.sinks.writers import write_partitioned
from orderlens.sources import fixtures
from orderlens.sources.store import put_text
from tests.conftest import SF_SMALL

RULE = fixtures.F1_RULE


@pytest.fixture()
def lake(spark, scratch):
    rows = lake_rows(fixtures.order_topic(spark, SF_SMALL), RULE)
    return lambda share: write_partitioned(rows.filter(share), f"{scratch}/lake", mode="append")


def totals(done):
    return tuple(file_totals(done.files).select("files", F.coalesce("rows", F.lit(0)), "failed_files").first())


def test_a_second_load_reads_no_old_file(spark, scratch, lake):
    lake("day <= 10")
    one = load_new_files(spark, f"{scratch}/lake", f"{scratch}/ledger", f"{scratch}/raw")
    old = glob.glob(f"{scratch}/lake/**/*.parquet", recursive=True)
    assert totals(one) == (len(old), one.inserted, 0) and one.inserted > 0
    for f in old:  # nobody reads them again: what they hold now would fail
        os.chmod(f, 0o644)
        with open(f, "w") as g:
            g.write("gone")
    lake("day > 10")
    new = set(glob.glob(f"{scratch}/lake/**/*.parquet", recursive=True)) - set(old)
    two = load_new_files(spark, f"{scratch}/lake", f"{scratch}/ledger", f"{scratch}/raw")
    assert totals(two) == (len(new), two.inserted, 0) and two.inserted > 0
    three = load_new_files(spark, f"{scratch}/lake", f"{scratch}/ledger", f"{scratch}/raw")
    assert totals(three) == (0, 0, 0) and three.inserted == 0 and not sum(p["numInputRows"] for p in three.progress)
    assert spark.read.parquet(f"{scratch}/raw").count() == one.inserted + two.inserted


def test_damaged_files_are_listed_and_the_others_load(spark, scratch, lake):
    lake("true")
    put_text(spark, f"{scratch}/lake/year=2024/month=1/day=1/part-bad.parquet", "no Parquet")
    done = load_new_files(spark, f"{scratch}/lake", f"{scratch}/ledger", f"{scratch}/raw")
    files, rows, failed = totals(done)
    assert failed == 1 and rows == done.inserted == lake_rows(fixtures.order_topic(spark, SF_SMALL), RULE).count()
    assert done.files.where("failed").first().source_file.endswith("part-bad.parquet")


def test_a_load_of_damaged_files_only(spark, scratch):
    put_text(spark, f"{scratch}/lake/year=2024/month=1/day=1/part-bad.parquet", "no Parquet")
    done = load_new_files(spark, f"{scratch}/lake", f"{scratch}/ledger", f"{scratch}/raw")
    assert totals(done) == (1, 0, 1) and done.inserted == 0


def test_files_are_taken_a_few_at_a_time(spark, scratch, lake):
    lake("true")
    n = len(glob.glob(f"{scratch}/lake/**/*.parquet", recursive=True))
    done = load_new_files(spark, f"{scratch}/lake", f"{scratch}/ledger", f"{scratch}/raw", max_files=-(-n // 2))
    assert totals(done)[0] == n and done.files.select("load_batch").distinct().count() == 2
    assert spark.read.parquet(f"{scratch}/raw").count() == done.inserted


def test_an_unfinished_load_is_taken_up_again(spark, scratch, lake, monkeypatch):
    from orderlens.operators import load

    lake("true")
    with monkeypatch.context() as m:
        m.setattr(load, "insert_if_absent", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            load_new_files(spark, f"{scratch}/lake", f"{scratch}/ledger", f"{scratch}/raw")
    done = load_new_files(spark, f"{scratch}/lake", f"{scratch}/ledger", f"{scratch}/raw")
    assert done.inserted == spark.read.parquet(f"{scratch}/raw").count() == lake_rows(fixtures.order_topic(spark, SF_SMALL), RULE).count()
