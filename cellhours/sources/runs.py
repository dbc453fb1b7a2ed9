"""The sweep audit: an append-only log of run records, folded into one state per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.timeslots import plus_minutes
from cellhours.schemas import INGEST_RUNS

_FIRST = ["started_at", "slot_start"]
_LAST = [
    "finished_at",
    "points_attempted",
    "points_succeeded",
    "aircraft_written",
    "status",
    "error",
]
# Fixed value: the note left on a run that was closed from outside.
ABANDONED_NOTE = "sweep deadline expired before completion was recorded (pre-fix)"


def run_state(run_log: DataFrame) -> DataFrame:
    """Latest state per run: outcome from the last record, start and slot from the first.

    `seq` orders the records of a run.
    """
    folded = run_log.groupBy("run_id").agg(
        F.min_by(F.struct(*_FIRST), "seq").alias("_first"),
        F.max_by(F.struct(*_LAST), "seq").alias("_last"),
    )
    source = {**{c: f"_first.{c}" for c in _FIRST}, **{c: f"_last.{c}" for c in _LAST}}
    return folded.select(
        *[F.col(source.get(f.name, f.name)).alias(f.name) for f in INGEST_RUNS.fields]
    )


def with_broken_answers(polls: DataFrame, broken: DataFrame) -> DataFrame:
    """Polls, of which those fail whose answer could not be read (see `broken_answers`)."""
    unread = broken.select("run_id", "sample_point", F.lit(True).alias("_unread"))
    bad = F.coalesce("_unread", F.lit(False))
    note = F.concat(F.lit("answer of "), "sample_point", F.lit(" could not be read"))
    return (
        polls.join(unread, ["run_id", "sample_point"], "left")
        .withColumn("error", F.when(bad, F.coalesce("error", note)).otherwise(F.col("error")))
        .withColumn("ok", F.col("ok") & ~bad)
        .select(*polls.columns)
    )


def sweep_status(
    polls: DataFrame, planned: DataFrame, persist_error: str | None = None
) -> DataFrame:
    """Outcome of each sweep from its polls.

    ``planned`` has one row per sweep (run_id, slot_start, points_attempted): a sweep that its
    deadline cut short counts all discs it set out for, and one that polled none is listed too.
    No disc answered: failed. Some did not: partial. The error text is that of the first poll
    that failed. ``persist_error`` names a column with the error of the final write, if any;
    such a sweep is failed whatever its discs said.
    """
    failed = F.when(F.col("error").isNotNull(), F.col("seq"))
    counts = [
        F.count_if("ok").alias("_answered"),
        F.min_by("error", failed).alias("error"),
    ]
    if persist_error is not None:
        counts.append(F.max(persist_error).alias("_write_error"))
    polled = polls.groupBy("run_id").agg(*counts)
    sweeps = planned.select(
        "run_id", "slot_start", F.col("points_attempted").cast("bigint").alias("points_attempted")
    )
    runs = (
        sweeps.join(polled, "run_id", "left")
        .withColumn("points_succeeded", F.coalesce("_answered", F.lit(0)))
        .drop("_answered")
    )
    status = (
        F.when(F.col("points_succeeded") == 0, "failed")
        .when(F.col("points_succeeded") < F.col("points_attempted"), "partial")
        .otherwise("ok")
    )
    if persist_error is not None:
        lost = F.col("_write_error").isNotNull()
        status = F.when(lost, "failed").otherwise(status)
        runs = runs.withColumn("status", status).withColumn(
            "error", F.coalesce("_write_error", "error")
        )
        return runs.drop("_write_error")
    return runs.withColumn("status", status)


def close_stale_runs(runs: DataFrame, now: Column, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Mark runs that can no longer finish as abandoned; applying it twice changes nothing."""
    stale = (F.col("status") == "running") & (
        F.col("started_at") < plus_minutes(now, -rules.stale_run_minutes)
    )
    deadline = plus_minutes(F.col("started_at"), rules.sweep_deadline_minutes)
    return runs.withColumns(
        {
            "finished_at": F.when(stale, deadline).otherwise(F.col("finished_at")),
            "error": F.when(stale, F.coalesce("error", F.lit(ABANDONED_NOTE))).otherwise(
                F.col("error")
            ),
            "status": F.when(stale, "abandoned").otherwise(F.col("status")),
        }
    )


def recent_runs(runs: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The newest sweeps; the limit is the report's size."""
    return runs.orderBy(F.desc("slot_start"), F.desc("run_id")).limit(rules.recent_runs_limit)


def runs_by_status(runs: DataFrame, per_day: Column) -> DataFrame:
    """Runs, requests and written rows per day and status."""
    return runs.groupBy(per_day.alias("date"), "status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("points_attempted").alias("requests"),
        F.sum("points_succeeded").alias("answered"),
        F.sum("aircraft_written").alias("aircraft_written"),
    )
