"""Chronological splits, baselines and ranking metrics over the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.timeslots import hour_index, hour_index_sql, hour_of_day, plus_minutes, utc_date
from cellhours.operators.ordering import running_totals
from cellhours.schemas import CELL, KEYS, LABEL, SLOT, TARGET


def chrono_split(
    features: DataFrame,
    train_percent: int = 70,
    validation_percent: int = 15,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Add `segment`: train, validation, test, or gap.

    The cuts are positions in the order of the distinct hours, found by running counts over the
    days: one task sees a row per day of history. A row whose target lies beyond its segment's
    end belongs to no segment, so no example straddles a boundary.
    """
    hour = hour_index_sql(SLOT)
    days = features.groupBy(F.expr(f"cast(floor({hour} / 24) AS int)").alias("_day")).agg(
        F.expr(f"bit_or(shiftleft(1, pmod({hour}, 24)))").alias("_hours")  # a bit per hour
    )
    every = Window.orderBy("_day")
    placed = days.where("_day IS NOT NULL").select(
        "_day",
        F.expr("filter(sequence(0, 23), h -> getbit(_hours, h) = 1)").alias("_hours"),
        F.sum(F.bit_count("_hours")).over(every).alias("_upto"),
        F.sum(F.bit_count("_hours")).over(Window.partitionBy()).alias("_total"),
    )

    def at(percent: int) -> Column:
        position = f"greatest(1L, ceil(_total * {percent} / 100))"
        inside = f"cast({position} - _upto + size(_hours) AS int)"
        found = f"if({inside} BETWEEN 1 AND size(_hours), _day * 24 + _hours[{inside} - 1], NULL)"
        return F.expr(f"max({found})")

    cuts = placed.agg(
        F.struct(
            at(train_percent).alias("first"), at(train_percent + validation_percent).alias("second")
        )
    ).scalar()
    now = hour_index(SLOT)
    later = now + F.lit(rules.horizon_hours)
    first, second = cuts.getField("first"), cuts.getField("second")
    segment = (
        F.when(now > second, "test")
        .when((now > first) & (later <= second), "validation")
        .when(later <= first, "train")
        .otherwise("gap")
    )
    return features.withColumn("segment", segment)


def persistence(features: DataFrame) -> DataFrame:
    """Baseline score: the state now, repeated at the horizon."""
    return features.select(*KEYS, LABEL, F.col(LABEL).cast("double").alias("score"), TARGET)


def climatology(train: DataFrame, rows: DataFrame) -> DataFrame:
    """Baseline score: how often this cell was degraded at this hour of day in `train`.

    Falls back to the cell's rate, then to the overall rate. The three levels come from one
    aggregation of the training rows.
    """
    hour = hour_of_day(SLOT).alias("_hour")
    base = train.groupBy(CELL, hour).agg(
        F.sum(TARGET).alias("_pos"), F.count(TARGET).alias("_n")
    )
    per_cell = Window.partitionBy(CELL)
    rates = base.select(
        CELL,
        "_hour",
        (F.col("_pos") / F.col("_n")).alias("_hour_rate"),
        (F.sum("_pos").over(per_cell) / F.sum("_n").over(per_cell)).alias("_cell_rate"),
    )
    # At most 24 entries per cell, so a row meets one table with one entry per cell.
    by_cell = rates.groupBy(CELL).agg(
        F.max("_cell_rate").alias("_cell_rate"),
        F.map_from_entries(F.collect_list(F.struct("_hour", "_hour_rate"))).alias("_by_hour"),
    )
    overall = base.agg((F.sum("_pos") / F.sum("_n")).alias("r")).scalar()
    return (
        rows.withColumn("_hour", hour_of_day(SLOT))
        .join(by_cell, CELL, "left")
        .withColumn(
            "score",
            F.coalesce(
                F.try_element_at("_by_hour", F.col("_hour")), F.col("_cell_rate"), overall
            ),
        )
        .select(*rows.columns, "score")
    )


def average_precision(scored: DataFrame, score: str = "score", target: str = TARGET) -> DataFrame:
    """Area under the precision-recall steps: sum of precision times the gain in recall.

    Rows with equal scores are one step. Unscored rows are left out.
    """
    steps = (
        scored.filter(F.col(score).isNotNull() & F.col(target).isNotNull())
        .groupBy(F.col(score).cast("double").alias("_score"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("pos"))
    )
    ranked = running_totals(steps, "_score", ["n", "pos"], descending=True)
    return ranked.agg(
        F.sum("n").alias("scored_rows"),
        F.sum("pos").alias("positives"),
        (
            F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_n"))
            / F.nullif(F.sum("pos"), F.lit(0))
        ).alias("average_precision"),
    )


def brier(scored: DataFrame, score: str = "score", target: str = TARGET) -> DataFrame:
    error = F.col(score).cast("double") - F.col(target).cast("double")
    return scored.agg(F.count(error).alias("scored_rows"), F.avg(error * error).alias("brier"))


def region_metrics(
    scored: DataFrame, regions: DataFrame, threshold: float, score: str = "score"
) -> DataFrame:
    """Precision and recall per region, over all rows and over state changes only."""
    changes = F.col(LABEL) != F.col(TARGET)
    subsets = F.when(changes, F.array(F.lit("all"), F.lit("transitions"))).otherwise(
        F.array(F.lit("all"))
    )
    judged = scored.join(regions, CELL, "left").select(
        "region",
        F.explode(subsets).alias("subset"),
        F.coalesce(F.col(score) >= F.lit(threshold), F.lit(False)).alias("_said"),
        (F.col(TARGET) == 1).alias("_was"),
    )
    counts = judged.groupBy("region", "subset").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_said") & F.col("_was")).alias("hits"),
        F.count_if(F.col("_said") & ~F.col("_was")).alias("false_alarms"),
        F.count_if(~F.col("_said") & F.col("_was")).alias("misses"),
    )
    said, was = F.col("hits") + F.col("false_alarms"), F.col("hits") + F.col("misses")
    return counts.withColumns(
        {
            "precision": F.col("hits") / F.nullif(said, F.lit(0)),
            "recall": F.col("hits") / F.nullif(was, F.lit(0)),
        }
    )


def lagged_accuracy(
    forecasts: DataFrame,
    cells: DataFrame,
    threshold: float = 0.5,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Accuracy per day of the forecasts whose target hour has been observed by now."""
    due = forecasts.select(
        CELL, plus_minutes(F.col(SLOT), rules.horizon_hours * 60).alias(SLOT), "score"
    )
    outcome = cells.select(*KEYS, F.col(LABEL).alias("_was"))
    error = F.col("score") - F.col("_was")
    right = (F.col("score") >= F.lit(threshold)).cast("int") == F.col("_was")
    return (
        due.join(outcome, KEYS)
        .groupBy(utc_date(SLOT).alias("date"))
        .agg(
            F.count(F.lit(1)).alias("scored_rows"),
            F.avg(right.cast("double")).alias("accuracy"),
            F.avg(error * error).alias("brier"),
        )
    )


def class_weights(features: DataFrame) -> DataFrame:
    """Add `weight`, which makes both classes count the same in total."""
    totals = features.agg(
        F.struct(F.count(TARGET).alias("n"), F.sum(TARGET).alias("pos")).alias("t")
    ).scalar()
    n, pos = totals.getField("n"), totals.getField("pos")
    in_class = F.when(F.col(TARGET) == 1, pos).otherwise(n - pos)
    return features.withColumn("weight", n / (F.lit(2.0) * in_class))
