"""Health edges of the sweep audit: when capture degraded and when it recovered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellhours.functions.timeslots import utc_date, utc_text
from cellhours.operators.ordering import with_previous

_ORDER = ["slot_start", "run_id"]
_STAMP = "yyyy-MM-dd HH:mm"


def health_transitions(runs: DataFrame, outage_since: Column | None = None) -> DataFrame:
    """One row per change between healthy and degraded, as an alert would word it.

    A sweep is healthy if it ended `ok`; a running one has no outcome yet. History starts out
    healthy, or within an outage that began before the runs at hand, at `outage_since`. A
    repeated bad sweep says nothing, and a first bad sweep that captured nothing is urgent. Runs
    are walked in day blocks, so no task sees the whole audit.
    """
    open_since = F.lit(None).cast("timestamp") if outage_since is None else outage_since
    ended = runs.filter(F.col("status") != "running").withColumn(
        "healthy", F.col("status") == "ok"
    )
    day = utc_date("slot_start")
    walked = with_previous(ended, day, _ORDER, F.col("healthy"), "_was_healthy")
    edges = walked.filter(
        F.col("healthy") != F.coalesce(F.col("_was_healthy"), open_since.isNull())
    ).drop("_was_healthy")
    # Edges alternate, so a recovery's predecessor is the edge that began the outage.
    dated = with_previous(edges, day, _ORDER, F.col("slot_start"), "_edge_before")
    since = F.when(F.col("healthy"), F.coalesce("_edge_before", open_since)).otherwise(F.col("slot_start"))
    slot = utc_text("slot_start", _STAMP)
    discs = F.concat(
        F.lit("Slot "),
        slot,
        F.lit(" UTC: "),
        F.col("points_succeeded").cast("string"),
        F.lit("/"),
        F.col("points_attempted").cast("string"),
        F.lit(" discs OK"),
    )
    failing = F.concat(
        discs,
        F.lit("."),
        F.coalesce(F.concat(F.lit(" Error: "), F.col("error")), F.lit("")),
    )
    healed = F.concat(
        discs,
        F.lit(" again (degraded since "),
        utc_text("degraded_since", _STAMP),
        F.lit(" UTC)."),
    )
    return dated.withColumn("degraded_since", since).select(
        "slot_start",
        "run_id",
        F.when(F.col("healthy"), "recovered").otherwise("degraded").alias("transition"),
        F.when(F.col("healthy"), "default")
        .when(F.col("points_succeeded") == 0, "urgent")
        .otherwise("high")
        .alias("priority"),
        "degraded_since",
        F.when(F.col("healthy"), healed).otherwise(failing).alias("body"),
    )
