"""Command line: run the pipeline's jobs on an existing Spark deployment.

    python -m orderlens stream (--topic-log DIR | --source DIR | --servers HOST:PORT) --out DIR [--one-read] [--once]
    python -m orderlens load   --lake DIR (--target DIR | --table NAME [--buckets N] [--analyze]) [--ledger DIR | --limit-files N] [--rejects DIR]
    python -m orderlens load-stream (--source DIR | --servers HOST:PORT) (--target DIR | --table NAME) --checkpoint DIR [--rejects DIR] [--once]
    python -m orderlens models (--raw DIR | --raw-table NAME) [--write-tables]
    python -m orderlens verify (--raw DIR | --raw-table NAME) [--store-failures]

Thresholds and windows come from FRAUD_AMOUNT_THRESHOLD, FRAUD_TENURE_THRESHOLD,
WINDOW_DURATION, WATERMARK_DELAY and TRIGGER_INTERVAL when set, topics from
KAFKA_INPUT_TOPIC, KAFKA_OUTPUT_TOPIC, KAFKA_STARTING_OFFSETS and
MAX_OFFSETS_PER_TRIGGER (flags go first; 0 offsets: no cap). Intermediate
data goes below spark.checkpoint.dir.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from orderlens.config import FraudRule, TopicSpec, WindowSpec
from orderlens.session import configure, work_dir


def _session() -> SparkSession:
    return configure(SparkSession.builder.appName("orderlens").getOrCreate())


def _topics(args) -> TopicSpec:
    flags = {"input_topic": args.topic, "alert_topic": getattr(args, "alert_topic", None),
             "starting_offsets": args.starting_offsets, "max_offsets_per_trigger": args.max_offsets}
    return replace(TopicSpec.from_env(), **{k: v for k, v in flags.items() if v is not None})


def _records(spark: SparkSession, args, checkpoint: str | None = None):
    from orderlens.sources.topic import file_topic_stream, topic_stream_reader
    from orderlens.sources.topic_log import topic_stream

    if args.topic_log:
        topics = _topics(args)
        return topic_stream(spark, args.topic_log, checkpoint, topics.starting_offsets, topics.max_offsets_per_trigger)
    if args.servers:
        return topic_stream_reader(spark, args.servers, _topics(args)).load()
    return file_topic_stream(spark, args.source, args.max_files_per_trigger)


def _raw(spark: SparkSession, args):
    from orderlens.sources.tables import declared_source

    return declared_source(spark, args.raw_table) if args.raw_table else spark.read.parquet(args.raw)


def cmd_stream(args) -> int:
    from orderlens.streaming.pipeline import PipelinePaths, start_pipeline

    spark = _session()
    if args.one_read:
        return _stream_one_read(spark, args)
    if args.topic_log:
        raise SystemExit("--topic-log needs --one-read: its cap on offsets follows one query's checkpoint")
    records = _records(spark, args)
    paths = PipelinePaths(lake=f"{args.out}/valid", alerts=f"{args.out}/fraud_alerts",
                          window_log=f"{args.out}/window_updates", checkpoints=f"{args.out}/_checkpoints")
    queries = start_pipeline(records, paths, FraudRule.from_env(), WindowSpec.from_env(),
                             available_now=args.once, bootstrap_servers=args.servers,
                             window_to_console=args.console, topics=_topics(args))
    if args.once:
        for q in queries.values():
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    return 0


def _stream_one_read(spark: SparkSession, args) -> int:
    from orderlens.sources.topic_log import drain
    from orderlens.streaming.fanout import FanoutPaths, start_fanout

    paths = FanoutPaths.below(args.out)
    own = bool(args.topic_log)  # admits by itself, so the end of the topic is found by draining it
    q = start_fanout(_records(spark, args, paths.checkpoint), paths, FraudRule.from_env(), WindowSpec.from_env(),
                     available_now=args.once and not own, bootstrap_servers=args.servers, topics=_topics(args))
    if args.once and own:
        drain(q)
    else:
        q.awaitTermination()
    return 0


def cmd_load(args) -> int:
    from orderlens.plans.load_job import file_totals, load_lake, load_new_files

    spark = _session()
    if args.ledger:
        done = load_new_files(spark, args.lake, args.ledger, args.target, args.table, args.buckets)
        files = file_totals(done.files).first().asDict()
        print(json.dumps({"inserted": done.inserted, **files}))
        return 0 if not files["failed_files"] else 1
    res = load_lake(spark, args.lake, args.target, limit_files=args.limit_files, target_table=args.table,
                    buckets=args.buckets, quarantine=args.rejects, analyze=args.analyze)
    totals = res.totals.first().asDict()
    files = file_totals(res.files).first().asDict()
    print(json.dumps({"inserted": res.inserted, "rejected": res.rejected.count(), **files,
                      **{k: str(v) for k, v in totals.items()}}))
    return 0 if not files["failed_files"] else 1


def cmd_load_stream(args) -> int:
    from orderlens.sources.topic_log import drain
    from orderlens.streaming.pipeline import start_warehouse_load

    spark = _session()
    q = start_warehouse_load(_records(spark, args, args.checkpoint), args.target, args.checkpoint, FraudRule.from_env(), rejects=args.rejects,
                             available_now=args.once and not args.topic_log, spec=WindowSpec.from_env(), table=args.table, buckets=args.buckets)
    if args.once and args.topic_log:
        drain(q)
    else:
        q.awaitTermination()
    return 0


def cmd_models(args) -> int:
    from orderlens.plans.models import build_models

    spark = _session()
    frames = build_models(spark, _raw(spark, args), write_tables=args.write_tables)
    for name in ("mart_daily_revenue", "mart_fraud_analysis"):
        frames[name].write.format("noop").mode("overwrite").save()
    print(json.dumps({"built": sorted(frames), "work_dir": work_dir(spark)}))
    return 0


def cmd_verify(args) -> int:
    from orderlens.operators import quality

    spark = _session()
    raw = _raw(spark, args)
    summary = quality.warehouse_summary(raw, FraudRule.from_env())
    rows = [r.asDict() for r in summary.collect()]
    if args.store_failures:
        from orderlens.sinks.writers import store_failures

        failing = quality.failing_rows(raw, FraudRule.from_env())
        for r in rows:
            if not r["passed"] and not r["error"] and r["check"] in failing:
                store_failures(failing[r["check"]](), r["check"])
    print(json.dumps(rows))
    return 0 if all(r["passed"] for r in rows) else 1


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="orderlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--source", help="folder of staged topic records (offline stand-in)")
    source.add_argument("--topic-log", help="folder of a topic kept as files, with offsets")
    source.add_argument("--servers", help="topic bootstrap servers (needs the connector package)")
    source.add_argument("--topic", help="input topic")
    source.add_argument("--starting-offsets", help="earliest or latest")
    source.add_argument("--max-offsets", type=int, help="offsets per micro-batch at most, 0 for no cap")
    source.add_argument("--max-files-per-trigger", type=int, help="rate limit of the file stand-in")
    raw = argparse.ArgumentParser(add_help=False)
    which = raw.add_mutually_exclusive_group(required=True)
    which.add_argument("--raw", help="Parquet path of raw.orders")
    which.add_argument("--raw-table", help="declared catalog table of raw.orders")
    s = sub.add_parser("stream", parents=[source])
    s.add_argument("--alert-topic", help="topic of the fraud alerts")
    s.add_argument("--out", required=True, help="folder for the lake, alerts, window updates, checkpoints")
    s.add_argument("--one-read", action="store_true", help="one query writes the three outputs from one read")
    s.add_argument("--once", action="store_true", help="process what is available, then stop")
    s.add_argument("--console", action="store_true", help="window updates to the console")
    s.set_defaults(fn=cmd_stream)
    ld = sub.add_parser("load")
    ld.add_argument("--lake", required=True, help="prefix of the year/month/day Parquet lake")
    target = ld.add_mutually_exclusive_group(required=True)
    target.add_argument("--target", help="Parquet path of raw.orders (partitioned by day)")
    target.add_argument("--table", help="catalog table of raw.orders, bucketed by order_id")
    ld.add_argument("--buckets", type=int, help="buckets of a new table (default: 64)")
    ld.add_argument("--analyze", action="store_true", help="refresh the table's statistics after the load")
    ld.add_argument("--rejects", help="Parquet folder that keeps the rejected rows")
    ld.add_argument("--ledger", help="folder that records loaded files: only new ones are read; rejected rows stay below it")
    ld.add_argument("--limit-files", type=int, help="load only the first N files in name order")
    ld.set_defaults(fn=cmd_load)
    ls = sub.add_parser("load-stream", parents=[source])
    where = ls.add_mutually_exclusive_group(required=True)
    where.add_argument("--target", help="Parquet path of raw.orders")
    where.add_argument("--table", help="catalog table of raw.orders, bucketed by order_id")
    ls.add_argument("--buckets", type=int, help="buckets of a new table")
    ls.add_argument("--checkpoint", required=True, help="checkpoint folder of the query")
    ls.add_argument("--rejects", help="folder that keeps the rejected rows by batch")
    ls.add_argument("--once", action="store_true", help="process what is available, then stop")
    ls.set_defaults(fn=cmd_load_stream)
    m = sub.add_parser("models", parents=[raw])
    m.add_argument("--write-tables", action="store_true", help="save tables / rollups and register views")
    m.set_defaults(fn=cmd_models)
    v = sub.add_parser("verify", parents=[raw])
    v.add_argument("--store-failures", action="store_true", help="keep the failing rows in test_results.<check>")
    v.set_defaults(fn=cmd_verify)
    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
