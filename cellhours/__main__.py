"""Jobs for spark-submit.

    features       rebuild, check and publish the feature table
    capture        take landed feed answers into the report table, as a stream
    stream-cells   cell hours of what lands, as a stream
    repair-cells   compute the cell hours again that late reports reopened
    import-landed  take in at once what was landed as text
    import-legacy  bring the earlier Parquet history into the report table
    report         coverage gaps, completeness and sweep health
    clean          delete feature folders that no recent build needs

A job that could not do its work exits with 1.
"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from cellhours.functions.timeslots import utc_date
from cellhours.operators import coverage, health
from cellhours.plans.build import run_feature_build
from cellhours.plans.incremental import run_incremental_build
from cellhours.schemas import LANDED_TEXT
from cellhours.session import START_SETTINGS, apply_settings
from cellhours.sources import legacy
from cellhours.sources.feature_store import drop_unreferenced, export_features, read_features
from cellhours.sources.observations import append_if_absent, stored_observations
from cellhours.sources.runs import recent_runs, run_state, runs_by_status
from cellhours.sources.scratch import materialise
from cellhours.sources.snapshots import broken_answers, flatten_snapshots, parse_bodies
from cellhours.streaming.capture import snapshot_stream, start_capture
from cellhours.streaming.cells import start_cell_hourly
from cellhours.streaming.reopened import repair_cell_hours

logger = logging.getLogger("cellhours")


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("cellhours")
    for key, value in START_SETTINGS.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def features(spark: SparkSession, args: argparse.Namespace) -> int:
    now = args.now or datetime.now(UTC)
    if args.incremental:
        result = run_incremental_build(spark, args.observations, args.store, now)
        if args.out and result.published:
            export_features(read_features(spark, args.store), args.out)
    else:
        result = run_feature_build(
            stored_observations(spark, args.observations),
            args.store,
            now,
            export_to=args.out,
            store=not args.no_store,
        )
    if result.capture_problem:
        logger.error("capture watchdog: %s", result.capture_problem)
    for problem in result.problems:
        logger.error("build refused: %s", problem)
    if not result.problems:
        logger.info("run %s over %d cell hours", result.run_id, result.cell_slots)
    return 1 if result.problems else 0


def capture(spark: SparkSession, args: argparse.Namespace) -> int:
    """Take in what has landed since the last run, or go on doing so."""
    stream = snapshot_stream(spark, args.landing)
    query = start_capture(
        stream, args.observations, args.checkpoint, continuous=args.every, late=args.late
    )
    query.awaitTermination()
    return 0


def stream_cells(spark: SparkSession, args: argparse.Namespace) -> int:
    reports = flatten_snapshots(snapshot_stream(spark, args.landing))
    query = start_cell_hourly(
        reports, args.cell_hours, args.checkpoint, continuous=args.every
    )
    query.awaitTermination()
    return 0


def repair_cells(spark: SparkSession, args: argparse.Namespace) -> int:
    count = repair_cell_hours(spark, args.observations, args.late, args.repairs)
    logger.info("%d cell hours were computed again", count)
    return 0


def import_landed(spark: SparkSession, args: argparse.Namespace) -> int:
    """Answers landed as text, all at once: reports into the table, broken answers on the log."""
    landed = parse_bodies(spark.read.schema(LANDED_TEXT).json(args.landing))
    unread = broken_answers(landed).collect()  # a row per sweep and disc
    for row in unread:
        logger.error("%s, %s: %d answers could not be read", *row)
    added = append_if_absent(flatten_snapshots(landed), args.observations)
    logger.info("%d rows were new to the table", added)
    return 1 if unread else 0


def clean(spark: SparkSession, args: argparse.Namespace) -> int:
    for path in drop_unreferenced(spark, args.store, args.keep):
        logger.info("deleted %s", path)
    return 0


def import_legacy(spark: SparkSession, args: argparse.Namespace) -> int:
    rows = legacy.staged_history(spark, args.raw_root)
    stored = stored_observations(spark, args.observations)
    summary = legacy.import_summary(rows, stored).first().asDict()
    logger.info("history holds %s", summary)
    if not args.dry_run:
        added = append_if_absent(rows, args.observations)
        logger.info("%d rows were new to the table", added)
    return 0


def _show_all(table: DataFrame) -> None:
    """Print every row; the reports have a row per day, edge or status."""
    table.show(max(1, table.count()), truncate=False)


def report(spark: SparkSession, args: argparse.Namespace) -> int:
    reports = stored_observations(spark, args.observations)
    hours = materialise(coverage.slot_coverage(reports, ordered=False), "coverage")
    _show_all(coverage.gap_report(hours).orderBy("date"))
    _show_all(coverage.completeness(hours))
    if args.run_log:
        runs = run_state(spark.read.parquet(args.run_log))
        _show_all(health.health_transitions(runs).orderBy("slot_start"))
        _show_all(runs_by_status(runs, utc_date("slot_start")))
        _show_all(recent_runs(runs))
    return 0


def _instant(text: str) -> datetime:
    value = datetime.fromisoformat(text)
    return value if value.tzinfo else value.replace(tzinfo=UTC)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cellhours", description=__doc__)
    jobs = top.add_subparsers(required=True)

    build = jobs.add_parser("features")
    build.add_argument("--observations", required=True, help="raw report table")
    build.add_argument("--store", required=True, help="root of the feature store")
    build.add_argument("--out", help="also write the table as plain Parquet")
    build.add_argument("--no-store", action="store_true", help="build and check only")
    build.add_argument(
        "--incremental", action="store_true", help="build anew only what new reports can change"
    )
    build.add_argument("--now", type=_instant, help="clock of the run (ISO, default: now)")
    build.set_defaults(job=features)

    take = jobs.add_parser("capture")
    take.add_argument("--landing", required=True, help="folder of landed answers (JSON lines)")
    take.add_argument("--observations", required=True, help="raw report table")
    take.add_argument("--checkpoint", required=True, help="folder of the stream's progress")
    take.add_argument("--late", help="folder that notes the cell hours of late reports")
    take.add_argument("--every", help="interval to go on at (default: stop when all is taken in)")
    take.set_defaults(job=capture)

    flow = jobs.add_parser("stream-cells")
    flow.add_argument("--landing", required=True, help="folder of landed answers (JSON lines)")
    flow.add_argument("--cell-hours", required=True, help="table of the cell hours")
    flow.add_argument("--checkpoint", required=True, help="folder of the stream's progress")
    flow.add_argument("--every", help="interval to go on at (default: stop when all is taken in)")
    flow.set_defaults(job=stream_cells)

    mend = jobs.add_parser("repair-cells")
    mend.add_argument("--observations", required=True, help="raw report table")
    mend.add_argument("--late", required=True, help="folder that the capture notes late hours in")
    mend.add_argument("--repairs", required=True, help="table of the repaired cell hours")
    mend.set_defaults(job=repair_cells)

    landed = jobs.add_parser("import-landed")
    landed.add_argument("--landing", required=True, help="answers as text in JSON lines")
    landed.add_argument("--observations", required=True, help="raw report table")
    landed.set_defaults(job=import_landed)

    sweep = jobs.add_parser("clean")
    sweep.add_argument("--store", required=True, help="root of the feature store")
    sweep.add_argument("--keep", type=int, default=24, help="newest builds to keep whole")
    sweep.set_defaults(job=clean)

    bring = jobs.add_parser("import-legacy")
    bring.add_argument("--raw-root", required=True, help="folder with date=*/ partitions")
    bring.add_argument("--observations", required=True, help="raw report table")
    bring.add_argument("--dry-run", action="store_true", help="report only")
    bring.set_defaults(job=import_legacy)

    show = jobs.add_parser("report")
    show.add_argument("--observations", required=True, help="raw report table")
    show.add_argument("--run-log", help="run records of the sweeps")
    show.set_defaults(job=report)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    return args.job(_session(), args)


if __name__ == "__main__":
    sys.exit(main())
