"""Streaming cell hours: the batch rules as two chained windowed aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.grid import cell_name, with_cell_key
from cellhours.operators.cells import (
    CELL_KEY,
    cruise_filter,
    labelled_columns,
    rank_nac_p_sql,
    report_rank,
)
from cellhours.schemas import CELL, CELL_VALUES, SLOT


def stream_cell_hourly(observations: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Cell hours of a report stream, in append mode.

    First one row per (hour, cell, aircraft), then one per (hour, cell). A row is emitted when
    the watermark, one sweep deadline behind the newest report, passes the end of its hour. What
    comes later is dropped here and left to `streaming.reopened`.
    """
    width = f"{rules.slot_minutes} minutes"
    needed = cruise_filter(observations, rules).select(
        "observed_at", "hex", "lat", "lon", "nic", "nac_p"
    )
    keyed = with_cell_key(
        needed.filter(F.col("hex").isNotNull()), rules.grid_resolution, CELL_KEY
    ).withWatermark("observed_at", f"{rules.sweep_deadline_minutes} minutes")
    worst = keyed.groupBy(F.window("observed_at", width), CELL_KEY, "hex").agg(
        F.min("nic").alias("nic"), F.min(report_rank(rules)).alias("_rank")
    )
    # A third chained aggregation would add state, so the quantiles take the aircraft directly.
    aggregates = {
        "aircraft_count": "cast(count(1) AS int)",
        "degraded_share": f"avg(cast(nic < {rules.nic_degraded_below} AS double))",
        "_nic": "percentile(nic, array(0.5D, 0.25D))",
        "mean_nac_p": f"avg(cast({rank_nac_p_sql('_rank')} AS double))",
    }
    summary = worst.groupBy(
        F.window(F.window_time("window"), width).alias("hour"), CELL_KEY
    ).agg(*[F.expr(sql).alias(name) for name, sql in aggregates.items()])
    labelled = summary.select(
        cell_name(CELL_KEY, rules.grid_resolution).alias(CELL),
        F.col("hour.start").alias(SLOT),
        *[F.expr(sql) for sql in labelled_columns(rules)],
    )
    kept = labelled.filter(f"aircraft_count >= {rules.min_aircraft}")
    return kept.select(CELL, SLOT, *CELL_VALUES)


def start_cell_hourly(
    observations: DataFrame,
    table: str,
    checkpoint: str,
    rules: Rules = DEFAULT_RULES,
    continuous: str | None = None,
) -> StreamingQuery:
    writer = (
        stream_cell_hourly(observations, rules)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start(table)
