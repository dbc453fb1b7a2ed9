"""The gate a feature table has to pass before it is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.schemas import KEYS, TARGET


def _row_checks(features: DataFrame, rules: Rules) -> list[tuple[str, Column]]:
    """(message, condition that a row violates it)."""
    shares = [c for c in features.columns if "degraded_share" in c and "delta" not in c]
    checks = [("target is not binary", ~F.coalesce(F.col(TARGET).isin(0, 1), F.lit(False)))]
    checks += [(f"{c} outside [0, 1]", (F.col(c) < 0.0) | (F.col(c) > 1.0)) for c in shares]
    checks += [
        (
            "current-slot degraded_share missing on a training row",
            F.col("degraded_share").isNull(),
        ),
        ("row below the traffic floor", F.col("aircraft_count") < F.lit(rules.min_aircraft)),
    ]
    return checks


def validate_features(
    features: DataFrame,
    rules: Rules = DEFAULT_RULES,
    other_rows: int = 0,
    other_positives: float = 0.0,
) -> DataFrame:
    """Every check with its number of violations, in one pass over the table.

    Rows are first reduced per key, which finds duplicates and counts the row checks in the same
    exchange. A positive rate outside the band, or of an empty table, is one violation. Rows that
    were checked before, at other keys, take part in the rate by their counts.
    """
    checks = _row_checks(features, rules)
    per_key = features.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.col(TARGET).cast("double")).alias("_positive"),
        F.count(TARGET).alias("_labelled"),
        *[F.count_if(bad).alias(f"_c{i}") for i, (_, bad) in enumerate(checks)],
    )
    totals = per_key.agg(
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("_duplicates"),
        F.try_divide(
            F.coalesce(F.sum("_positive"), F.lit(0.0)) + F.lit(float(other_positives)),
            F.coalesce(F.sum("_labelled"), F.lit(0)) + F.lit(other_rows),
        ).alias("_rate"),
        *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(checks))],
    )
    rate = F.col("_rate")
    plausible = F.coalesce(
        (rate >= rules.positive_rate_low) & (rate <= rules.positive_rate_high), F.lit(False)
    )
    rate_message = F.concat(
        F.lit("positive rate "),
        F.when(rate.isNull(), "nan").otherwise(F.format_string("%.3f", rate)),
        F.lit(
            f" outside the plausible {rules.positive_rate_low * 100:g}"
            f"-{rules.positive_rate_high * 100:g}% band"
        ),
    )

    def line(name: str, violations: Column, problem: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            violations.cast("bigint").alias("violations"),
            F.when(violations > 0, problem).alias("problem"),
        )

    lines = [
        line(
            "unique keys", F.col("_duplicates"), F.lit("duplicate (h3_cell, slot_start) keys")
        ),
        *[
            line(message, F.col(f"_c{i}"), F.lit(message))
            for i, (message, _) in enumerate(checks)
        ],
        line("positive rate", (~plausible).cast("bigint"), rate_message),
    ]
    return totals.select(F.inline(F.array(*lines)))


def problems(
    features: DataFrame,
    rules: Rules = DEFAULT_RULES,
    other_rows: int = 0,
    other_positives: float = 0.0,
) -> list[str]:
    """Messages of the violated checks; empty means publishable. At most one per check."""
    report = validate_features(features, rules, other_rows, other_positives).filter(
        F.col("violations") > 0
    )
    return [row.problem for row in report.select("problem").collect()]
