"""Streaming capture: landed feed answers into the raw report table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.schemas import SNAPSHOT
from cellhours.sources.appends import REPORT_FILES
from cellhours.sources.commits import remove
from cellhours.sources.observations import append_if_absent
from cellhours.sources.scratch import run_folder
from cellhours.sources.snapshots import flatten_snapshots
from cellhours.streaming.reopened import note_late


def snapshot_stream(spark: SparkSession, landing: str, files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(SNAPSHOT)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(landing)
    )


def start_capture(
    envelopes: DataFrame,
    table: str,
    checkpoint: str,
    rules: Rules = DEFAULT_RULES,
    continuous: str | None = None,
    late: str | None = None,
) -> StreamingQuery:
    """Append every new report of a stream of feed answers, see `start_reports`."""
    reports = flatten_snapshots(envelopes, rules=rules)
    return start_reports(reports, table, checkpoint, rules, continuous, late)


def start_reports(
    reports: DataFrame,
    table: str,
    checkpoint: str,
    rules: Rules = DEFAULT_RULES,
    continuous: str | None = None,
    late: str | None = None,
) -> StreamingQuery:
    """Append every new report of a stream.

    No watermark and no state: the sink keeps one row per key of a batch and skips stored keys,
    so a report of any lateness is kept, a replayed batch adds nothing, and how files are dealt
    to triggers does not matter. Where a folder `late` is named, the cell hours that a batch
    reaches after their end are noted there, once its reports are stored.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # The sink looks at the batch more than once. As Parquet it takes a fraction of the disk
        # that a cache would, and a look reads its own columns only.
        spark = batch.sparkSession
        folder = run_folder(spark, "capture")
        batch.write.options(**REPORT_FILES).parquet(folder)
        try:
            rows = spark.read.schema(batch.schema).parquet(folder)
            append_if_absent(rows, table)
            if late:
                note_late(rows, batch_id, late, rules)
        finally:
            remove(spark, folder)

    writer = reports.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()
