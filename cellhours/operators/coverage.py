"""How much history there is, where it has holes, and whether capture is still alive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.timeslots import hour_of_day, hours_between, plus_minutes, utc_date
from cellhours.schemas import SLOT

# A row per (aircraft, disc) as a row of its aircraft and a row of its disc.
SIDES = (
    "inline(array(named_struct('_air', true, '_who', hex),"
    " named_struct('_air', false, '_who', sample_point)))"
)


def slot_coverage(observations: DataFrame, ordered: bool = True) -> DataFrame:
    """Reports, aircraft and discs per hour over all altitudes; a gap is a row of zeros.

    The reports are read once and reduced to a row per (hour, aircraft, disc). Those split into
    their aircraft and their discs, so both distinct counts come from one grouping of reduced
    rows. A report without an address counts under the empty text. The hours missing before the
    next one are made from the counted hours; one task sees a row per hour of history.
    """
    address = "coalesce(hex, '') AS hex"
    seen = observations.selectExpr(SLOT, address, "sample_point").groupBy(
        SLOT, "hex", "sample_point"
    ).agg(F.expr("count(1)").alias("n"))
    sides = seen.selectExpr(SLOT, "n", SIDES)
    counted = sides.groupBy(SLOT, "_air", "_who").agg(F.sum("n").alias("n"))
    hourly = counted.groupBy(SLOT).agg(
        F.expr("sum(if(_air, n, 0L))").alias("observations"),
        F.expr("count_if(_air)").alias("aircraft"),
        F.expr("count_if(NOT _air AND _who IS NOT NULL)").alias("points"),
    )
    after = F.lead(SLOT).over(Window.orderBy(SLOT))
    spread = hourly.filter(F.col(SLOT).isNotNull()).withColumn("_after", after).selectExpr(
        "*",
        f"explode(sequence(0, greatest(0, cast(coalesce((unix_seconds(_after) - "
        f"unix_seconds({SLOT})) div 3600, 1L) AS int) - 1))) AS _gap",
    )
    covered = spread.select(
        plus_minutes(F.col(SLOT), F.col("_gap") * 60).alias(SLOT),
        *[F.expr(f"if(_gap = 0, {c}, 0L)").alias(c) for c in ("observations", "aircraft", "points")],
    )
    return covered.orderBy(SLOT) if ordered else covered


def history_stats(observations: DataFrame) -> DataFrame:
    return observations.agg(
        F.count(F.lit(1)).alias("observations"),
        F.count_distinct(SLOT).alias("slots_covered"),
        F.max(SLOT).alias("latest_slot"),
    )


def capture_lag(observations: DataFrame, now: Column) -> DataFrame:
    """Age of the newest slot in hours; NULL when there is no report at all."""
    return observations.agg(F.max(SLOT).alias("latest_slot")).select(
        "latest_slot", hours_between(F.col("latest_slot"), now).alias("lag_hours")
    )


def capture_watchdog(
    observations: DataFrame, now: Column, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """One row: is capture fresh, and the problem in words if not."""
    lag = F.col("lag_hours")
    limit = F.lit(rules.max_capture_lag_minutes / 60.0)
    problem = F.when(lag.isNull(), F.lit("no observations in the raw table")).when(
        lag > limit,
        F.concat(
            F.lit("newest captured hour is "),
            F.format_string("%.1f", lag),
            F.lit(" h old: capture is behind"),
        ),
    )
    return capture_lag(observations, now).select(
        "latest_slot", "lag_hours", problem.isNull().alias("healthy"), problem.alias("problem")
    )


def gap_report(coverage: DataFrame) -> DataFrame:
    """Days with missing hours and the list of those hours (at most 24 per day)."""
    missing = coverage.filter(F.col("observations") == 0)
    return missing.groupBy(utc_date(SLOT).alias("date")).agg(
        F.count(F.lit(1)).alias("missing_hours"),
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(hour_of_day(SLOT))),
                lambda h: F.lpad(h.cast("string"), 2, "0"),
            ),
            ",",
        ).alias("hours"),
    )


def completeness(coverage: DataFrame) -> DataFrame:
    observed = F.col("observations") > 0
    return coverage.agg(
        F.count_if(observed).alias("observed_hours"),
        F.count(F.lit(1)).alias("expected_hours"),
        F.avg(observed.cast("double")).alias("completeness"),
    )
