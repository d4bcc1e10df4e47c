"""Run a job: ``spark-submit ... clickloom/__main__.py session --params '{...}' ...``."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame

from clickloom.params import TaskParams, new_task_id
from clickloom.plans.reports import page_report, product_report, session_report, write_report
from clickloom.session import build_session
from clickloom.sinks.batch import append_files, append_jdbc, jdbc_publisher
from clickloom.sources import tables
from clickloom.sources.jdbc import JdbcTarget
from clickloom.streaming.ad_clicks import AdSettings, AdStore, start_ad_stats, start_click_trend
from clickloom.streaming.sources import file_lines, kafka_lines


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    for job in ("session", "page", "product"):
        batch = jobs.add_parser(job)
        batch.add_argument("--params", required=True, help="task parameters as JSON text")
        batch.add_argument("--task-id", default=None)
        batch.add_argument("--actions", default="user_visit_action", help="table name or path")
        batch.add_argument("--out", help="folder the result tables are appended to")
        if job == "session":
            batch.add_argument("--users", default="user_info", help="table name or path")
        if job == "product":
            batch.add_argument("--products", default="product_info", help="table name or path")
            batch.add_argument("--cities", help="table name or path; the built-in ten if absent")
        _add_jdbc(batch)
    ads = jobs.add_parser("ads")
    ads.add_argument("--store", required=True, help="folder of the result tables")
    ads.add_argument("--checkpoint", required=True)
    ads.add_argument("--brokers", help="Kafka brokers; needs --topic")
    ads.add_argument("--topic")
    ads.add_argument("--files", help="folder of log files, instead of Kafka")
    ads.add_argument("--threshold", type=int, default=AdSettings.threshold)
    ads.add_argument("--top", type=int, default=AdSettings.top)
    ads.add_argument("--trigger", default=AdSettings.trigger, help="time between batches")
    ads.add_argument("--compact-every", type=int, default=AdSettings.compact_every)
    ads.add_argument("--source-partitions", type=int, help="deal a batch over so many partitions")
    ads.add_argument("--group-prefix", help="start of the Kafka group names")
    ads.add_argument("--offsets-per-batch", type=int, help="Kafka messages of a batch at most")
    ads.add_argument("--available-now", action="store_true", help="stop when all is read")
    _add_jdbc(ads)
    return parser


def _add_jdbc(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--jdbc-password-file", help="file whose text is the password")


def _target(args: argparse.Namespace) -> JdbcTarget | None:
    if not args.jdbc_url:
        return None
    password = None
    if args.jdbc_password_file:
        password = Path(args.jdbc_password_file).read_text().strip()
    return JdbcTarget(args.jdbc_url, args.jdbc_user, password)


def _writer(args: argparse.Namespace) -> Callable[[DataFrame, str], None]:
    target = _target(args)
    if target is None and not args.out:
        raise SystemExit("name --out or --jdbc-url")

    def write(df: DataFrame, table: str) -> None:
        if args.out:
            append_files(df, args.out, table)
        if target is not None:
            append_jdbc(df, target, table)

    return write


def main(argv: list[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark = build_session(f"clickloom-{args.job}")
    if args.job == "ads":
        if args.files:
            lines = file_lines(spark, args.files)
        else:
            lines = kafka_lines(
                spark, args.brokers, args.topic, args.group_prefix, args.offsets_per_batch
            )
        target = _target(args)
        publish = None if target is None else jdbc_publisher(target)
        settings = AdSettings(
            args.threshold, args.top, args.trigger, args.compact_every, args.source_partitions
        )
        store = AdStore(args.store)
        running = [
            start(lines, store, f"{args.checkpoint}/{name}", settings, publish, args.available_now)
            for name, start in (("stats", start_ad_stats), ("trend", start_click_trend))
        ]
        for query in running:
            query.awaitTermination()
        return
    write = _writer(args)
    params = TaskParams.from_json(args.params)
    task_id = args.task_id or new_task_id()
    actions = tables.user_visit_actions(spark, args.actions)
    if args.job == "session":
        report = session_report(actions, tables.users(spark, args.users), params, task_id)
    elif args.job == "page":
        report = page_report(actions, params, task_id)
    else:
        cities = tables.cities(spark, args.cities) if args.cities else None
        goods = tables.products(spark, args.products)
        report = product_report(actions, goods, params, cities, task_id)
    write_report(report, write)


if __name__ == "__main__":
    main()
