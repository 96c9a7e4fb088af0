"""All stages in one flow: topic records -> stream load into raw.orders -> models -> verification."""

from pyspark.sql import functions as F

from orderlens.operators import quality
from orderlens.plans.models import build_models
from orderlens.sources import fixtures
from orderlens.sources.topic import file_topic_stream
from orderlens.streaming.pipeline import start_warehouse_load
from tests.conftest import SF_SMALL


def test_stream_to_models_to_verification(spark, scratch):
    rule = fixtures.F1_RULE
    src, raw_path = f"{scratch}/topic", f"{scratch}/raw_orders"
    fixtures.order_topic(spark, SF_SMALL).write.parquet(src)
    q = start_warehouse_load(file_topic_stream(spark, src), raw_path, f"{scratch}/ckpt", rule,
                             rejects=f"{scratch}/rejects", available_now=True)
    q.awaitTermination()
    raw = spark.read.parquet(raw_path)
    events = fixtures.order_events(spark, SF_SMALL)
    assert raw.count() == events.count()
    assert raw.filter("is_fraud").count() == events.filter(
        (F.col("amount") > rule.amount_threshold) & (F.col("customer_tenure_days") < rule.tenure_days)).count()

    frames = build_models(spark, raw)
    daily = frames["mart_daily_revenue"]
    assert daily.agg(F.sum("fraud_orders")).first()[0] == raw.filter("is_fraud").count()
    assert frames["int_customer_360"].count() == raw.select("customer_id").distinct().count()

    verdicts = {r.check: r for r in quality.warehouse_summary(raw, rule).collect()}
    assert len(verdicts) == 11
    assert all(v.passed for v in verdicts.values()), [v for v in verdicts.values() if not v.passed]
