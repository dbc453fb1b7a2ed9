"""Closed cell hours that late reports reopen, and their repair from the stored reports.

The stream of cell hours drops what lies behind its watermark. The capture stores such reports all
the same and notes the cell hours they belong to; `repair_cell_hours` computes just these again,
and `read_cell_hours` puts the repaired rows in place of the streamed ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.grid import cell_name, with_cell_key
from cellhours.functions.timeslots import utc_date
from cellhours.operators.cells import (
    CELL_KEY,
    cruise_filter,
    summarise_cells,
    with_slot,
    worst_reports,
)
from cellhours.schemas import CELL, CELL_HOURS, CELL_VALUES, KEYS, SLOT
from cellhours.sources.commits import (
    COMMIT,
    Entry,
    children,
    log_entries,
    publish,
    read_commits,
    remove,
    stage,
)
from cellhours.sources.observations import DATE, stored_observations
from cellhours.sources.scratch import materialise

BATCH = "batch_id"
REPAIR = "repair"
_LATE_KEYS = f"{CELL_KEY} bigint, {SLOT} timestamp"


def _located(reports: DataFrame, rules: Rules) -> DataFrame:
    needed = cruise_filter(reports, rules).filter(F.col("hex").isNotNull())
    columns = ["observed_at", "hex", "lat", "lon", "nic", "nac_p"]
    return with_cell_key(
        with_slot(needed.select(*columns), rules), rules.grid_resolution, CELL_KEY
    )


def _newest_before(spark: SparkSession, clock: str, batch_id: int) -> int | None:
    """Time of the newest report up to the batch before, in microseconds."""
    path = f"{clock}/{BATCH}={batch_id - 1}"
    if not children(spark, path):
        return None
    return spark.read.schema("newest bigint").parquet(path).agg(F.max("newest")).first()[0]


def note_late(
    reports: DataFrame, batch_id: int, ledger: str, rules: Rules = DEFAULT_RULES
) -> None:
    """Note the cell hours of a batch that may have been closed when its reports came.

    A stream that takes the same files in the same order, in batches of whatever size, drops a
    report only if its hour ends a sweep deadline or more before the newest report of an earlier
    batch of its own. All of those are in this batch or before it, so every dropped report's cell
    hour is noted. A batch that spans hours notes more than that; computing them again does no
    harm. The ledger belongs to the checkpoint of the stream, whose batches follow one another: the
    newest time is handed on from one to the next, and a replayed batch replaces its own notes.
    """
    spark = reports.sparkSession
    clock = f"{ledger}/clock"
    located = _located(reports, rules)
    here = located.agg(F.max(F.unix_micros("observed_at"))).first()[0]
    times = [t for t in (here, _newest_before(spark, clock, batch_id)) if t is not None]
    newest = max(times, default=None)
    if newest is not None:
        closed = newest - rules.sweep_deadline_minutes * 60_000_000 - rules.slot_micros
        late = located.filter(F.unix_micros(SLOT) <= closed).select(CELL_KEY, SLOT).distinct()
        late.write.mode("overwrite").parquet(f"{ledger}/late/{BATCH}={batch_id}")
    state = spark.range(0, 1, 1, 1).select(F.lit(newest).cast("bigint").alias("newest"))
    state.write.mode("overwrite").parquet(f"{clock}/{BATCH}={batch_id}")
    remove(spark, f"{clock}/{BATCH}={batch_id - 2}")


def repair_cell_hours(
    spark: SparkSession,
    observations: str,
    ledger: str,
    repairs: str,
    rules: Rules = DEFAULT_RULES,
) -> int:
    """Compute the noted cell hours again from all stored reports; returns how many there were.

    Of the report table only the dates of these hours are read, and of their rows only those of
    the noted cells are shuffled. The result is one commit of the table at `repairs`: a row for
    every noted cell hour, without values where it still has too few aircraft. Only then are the
    notes taken away, so a repair that broke off is done again, with the same outcome. For one
    repair at a time; a second one that finished later fails and leaves its notes.
    """
    noted = [f"{ledger}/late/{n}" for n in children(spark, f"{ledger}/late")]
    noted = [path for path in noted if "_SUCCESS" in children(spark, path)]  # written to the end
    if not noted:
        return 0
    keys = materialise(spark.read.schema(_LATE_KEYS).parquet(*noted).distinct(), "reopened")
    days = [r[0] for r in keys.select(utc_date(SLOT)).distinct().collect()]  # a row per date
    count = keys.count()
    if days:
        key = [CELL_KEY, SLOT]
        dated = stored_observations(spark, observations).filter(F.col(DATE).isin(days))
        reports = _located(dated, rules).join(keys, key, "left_semi")
        summary = summarise_cells(worst_reports(reports, CELL_KEY, rules), CELL_KEY, rules)
        entries = log_entries(spark, repairs)
        version = entries[-1].version + 1 if entries else 1
        rows = keys.join(summary, key, "left").select(
            cell_name(CELL_KEY, rules.grid_resolution).alias(CELL),
            SLOT,
            *CELL_VALUES,
            F.lit(version).cast("bigint").alias(REPAIR),
            utc_date(SLOT).alias(DATE),
        )
        commit_id, dates = stage(rows.hint("rebalance", F.col(DATE)), repairs, DATE)
        if not publish(spark, repairs, Entry(version, commit_id, count, dates)):
            remove(spark, f"{repairs}/{COMMIT}={commit_id}")
            raise RuntimeError("another repair of these cell hours came first")
    for path in noted:
        remove(spark, path)
    return count


def repaired_cell_hours(spark: SparkSession, repairs: str) -> DataFrame:
    """The newest repair of every cell hour that was ever reopened."""
    schema = StructType([*CELL_HOURS.fields]).add(REPAIR, "long")
    rows = read_commits(spark, repairs, log_entries(spark, repairs), schema, DATE, "date")
    newest = F.max(F.struct(REPAIR, *CELL_VALUES)).alias("_newest")
    return rows.groupBy(*KEYS).agg(newest).select(*KEYS, "_newest.*").drop(REPAIR)


def read_cell_hours(spark: SparkSession, streamed: str, repairs: str) -> DataFrame:
    """The streamed cell hours, with the repaired rows in place of those that were reopened."""
    fixed = repaired_cell_hours(spark, repairs)
    rows = spark.read.schema(CELL_HOURS).parquet(streamed)
    kept = rows.join(fixed.select(*KEYS), KEYS, "left_anti")
    whole = fixed.filter(F.col("aircraft_count").isNotNull())
    return kept.unionByName(whole.select(*CELL_HOURS.names))
