"""Command line for spark-submit: the stream job, the Gold export, and the monitoring report."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cardtide.operators import panels
from cardtide.schema import BRONZE_DIR, CORRECTIONS_DIR, GOLD_DIR, SAMPLE_DIR, TOPIC, WATERMARK, WINDOW, WINDOWS_DIR
from cardtide.session import configure
from cardtide.sources.gold import load_gold
from cardtide.sources.transactions import FolderSource, KafkaSource
from cardtide.streaming.pipeline import run_pipeline
from cardtide.streaming.reconcile import reconcile
from cardtide.streaming.sinks import export_snapshot, finish


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Land Bronze and Gold until a query ends, or until the input present now is read."""
    options = _options(args.option)
    if args.batch_limit:
        options.setdefault("maxBytesPerTrigger" if args.folder else "maxOffsetsPerTrigger", args.batch_limit)
    if args.folder:
        source = FolderSource(args.folder, args.format, options)
    else:
        source = KafkaSource(args.bootstrap_servers, args.topic, options=options)
    queries = run_pipeline(
        spark,
        source,
        args.data_dir,
        window=args.window,
        delay=args.watermark,
        state_partitions=args.state_partitions,
        console=args.console,
        available_now=args.once,
        bronze_by_date=args.bronze_by_date,
        windows_by_date=args.windows_by_date,
        rocksdb=args.rocksdb,
        minor_units=args.minor_units,
    )
    if args.once:
        finish(*queries)
    else:
        spark.streams.awaitAnyTermination()


def export(spark: SparkSession, args: argparse.Namespace) -> None:
    """Consolidate Gold into the snapshot folder."""
    root = args.data_dir.rstrip("/")
    sample = f"{root}/{SAMPLE_DIR}"
    report = export_snapshot(spark, f"{root}/{GOLD_DIR}", sample, files=args.files)
    print(f"{report['windows']} windows, {report['bytes'] / 1024:.1f} KB in {sample}")


def correct(spark: SparkSession, args: argparse.Namespace) -> None:
    """Put stored windows right with rows that came too late (needs --bronze-by-date and --windows-by-date)."""
    root = args.data_dir.rstrip("/")
    before = None if args.closed_before is None else F.lit(args.closed_before).cast("timestamp")
    dates = reconcile(
        spark, f"{root}/{BRONZE_DIR}", f"{root}/{WINDOWS_DIR}", f"{root}/{CORRECTIONS_DIR}", duration=args.window, closed_before=before
    )
    print(f"{len(dates)} dates corrected: {', '.join(dates)}" if dates else "nothing was late")


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Headline figures, latest windows and their alert levels."""
    root = args.data_dir.rstrip("/")
    # Used by three actions: read and deduplicated once.
    gold = load_gold(spark, f"{root}/{GOLD_DIR}", f"{root}/{SAMPLE_DIR}").persist()
    recent = panels.recent_windows(gold)
    panels.display_kpis(panels.kpi_summary(gold, minor_units=args.minor_units)).show(truncate=False)
    panels.display_recent(recent).show(truncate=False)
    panels.window_alerts(recent).where("severity <> ''").show(truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cardtide", description=__doc__)
    commands = parser.add_subparsers(required=True)

    run = commands.add_parser("stream", help=stream.__doc__)
    source = run.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap-servers")
    source.add_argument("--folder")
    run.add_argument("--topic", default=TOPIC)
    run.add_argument("--format", choices=("parquet", "text"), default="parquet")
    run.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="passed to the source")
    run.add_argument("--window", default=WINDOW)
    run.add_argument("--watermark", default=WATERMARK)
    run.add_argument("--state-partitions", type=int, default=4)
    run.add_argument("--console", action="store_true", help="echo closed windows")
    run.add_argument("--once", action="store_true", help="read what is there now, then end")
    run.add_argument("--bronze-by-date", action="store_true")
    run.add_argument("--windows-by-date", action="store_true", help="land statistics that can be corrected and rolled up")
    run.add_argument("--rocksdb", action="store_true")
    run.add_argument("--minor-units", type=int, metavar="N", help="add amounts exactly, in N parts of the unit (100: cents)")
    run.add_argument("--batch-limit", metavar="N", help="most that one micro-batch reads: offsets of a topic, or bytes of files")
    run.set_defaults(run=stream)

    for action in (export, correct, report):
        commands.add_parser(action.__name__, help=action.__doc__).set_defaults(run=action)
    commands.choices["export"].add_argument("--files", type=int, help="number of files; left to Spark by default")
    commands.choices["correct"].add_argument("--window", default=WINDOW)
    commands.choices["correct"].add_argument("--closed-before", metavar="INSTANT", help="the watermark, where the stream goes on")
    commands.choices["report"].add_argument("--minor-units", type=int, metavar="N")
    for command in commands.choices.values():
        command.add_argument("--data-dir", required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName("cardtide").getOrCreate())
    spark.sparkContext.setLogLevel("WARN")
    args.run(spark, args)


if __name__ == "__main__":
    main()
