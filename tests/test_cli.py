"""The command line: the one-read stream over a topic of files, the load with a ledger, the stream load."""

import json

from pyspark.sql import functions as F

from orderlens.__main__ import main
from orderlens.plans.order_flow import clean_orders
from orderlens.sources import fixtures
from orderlens.sources.topic_log import append_topic
from orderlens.streaming import fanout
from tests.conftest import SF_SMALL


def test_one_read_then_ledger_load(spark, scratch, capsys):
    records = fixtures.order_topic(spark, SF_SMALL)
    topic, out = append_topic(records, f"{scratch}/topic"), f"{scratch}/out"
    stream = ["stream", "--topic-log", topic, "--one-read", "--out", out, "--starting-offsets", "earliest", "--max-offsets", "400", "--once"]
    assert main(stream) == 0
    paths = fanout.FanoutPaths.below(out)
    orders = clean_orders(records).count()
    assert fanout.marks(spark, paths).agg(F.sum("orders")).first()[0] == orders
    load = ["load", "--lake", f"{out}/valid", "--ledger", f"{scratch}/ledger", "--target", f"{scratch}/raw"]
    assert main(load) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["inserted"] == first["rows"] == fanout.lake_orders(spark, paths).count() and first["failed_files"] == 0
    assert main(load) == 0
    again = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert again["files"] == again["inserted"] == 0
    # the stream load brings the alerts' orders too; what the lake brought is there already
    assert main(["load-stream", "--topic-log", topic, "--starting-offsets", "earliest", "--max-offsets", "0", "--target", f"{scratch}/raw",
                 "--checkpoint", f"{scratch}/c", "--once"]) == 0
    assert spark.read.parquet(f"{scratch}/raw").count() == orders
