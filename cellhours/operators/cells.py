"""From position reports to one labelled row per cell and hourly slot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.grid import cell_name, with_cell_key
from cellhours.functions.timeslots import slot_floor
from cellhours.schemas import CELL, CELL_VALUES, KEYS, SLOT

CELL_KEY = "cell_key"


def cruise_filter(observations: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Keep reports at or above the altitude floor. An unknown altitude is not cruise."""
    return observations.filter(F.col("altitude_ft") >= F.lit(rules.min_altitude_ft))


def with_slot(observations: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Recompute the slot from the report time; a stored slot is never trusted."""
    return observations.withColumn(SLOT, slot_floor("observed_at", rules))


def assign_cells(
    observations: DataFrame, rules: Rules = DEFAULT_RULES, resolution: int | None = None
) -> DataFrame:
    """Attach the cell id and the hourly slot to the reports that have a position."""
    step = rules.grid_resolution if resolution is None else resolution
    keyed = with_cell_key(with_slot(observations, rules), step, CELL_KEY)
    return keyed.withColumn(CELL, cell_name(CELL_KEY, step)).drop(CELL_KEY)


def report_rank(rules: Rules) -> Column:
    """(nic, time inside the slot, nac_p) as one BIGINT that sorts in that order.

    16 bits of NIC, 32 bits of time, 16 bits of NACp. A BIGINT minimum stays in the
    code-generated hash aggregate; a minimum over a struct would sort every partition first.
    """
    unit = -(-rules.slot_micros // (1 << 32))
    inside = f"pmod(unix_micros(observed_at), {rules.slot_micros}L) div {unit}"
    return F.expr(
        "shiftleft(cast(cast(nic AS smallint) AS bigint), 48)"
        f" + shiftleft({inside}, 16) + cast(nac_p AS smallint) + 32768L"
    )


def rank_nac_p_sql(rank: str) -> str:
    """The NACp inside a packed rank."""
    return f"cast(({rank} & 65535L) - 32768L AS int)"


def worst_reports(
    observations: DataFrame, cell: str = CELL, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """One row per (cell, slot, aircraft): its worst NIC and the NACp that goes with it.

    NACp is the first known value in the order (NIC, report time, NACp). Copies of a report
    collapse on the map side, so an aircraft with very many reports never becomes a hot task.
    """
    nac_rank = F.min(report_rank(rules))  # NULL where NACp is NULL, and min skips NULLs
    return (
        observations.filter(F.col("hex").isNotNull())
        .groupBy(cell, SLOT, "hex")
        .agg(F.min("nic").alias("nic"), nac_rank.alias("_rank"))
        .select(
            cell,
            SLOT,
            "hex",
            "nic",
            F.expr(rank_nac_p_sql("_rank")).alias("nac_p"),
        )
    )


def worst_report_rows(observations: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Like :func:`worst_reports`, with every stored column.

    Each column takes its first non-NULL value in the order (NIC, report time, value), which for
    NACp is the order of the narrow form.
    """
    ahead = ["nic", "observed_at"]
    values = [
        c
        for c in observations.columns
        if c not in {CELL, SLOT, "hex", "nic"}
    ]

    def first_known(name: str) -> Column:
        order = F.struct(*ahead, F.col(name).alias("_value"))
        # A NULL order key is ignored by min_by, which is what "first non-NULL" needs.
        return F.min_by(F.col(name), F.when(F.col(name).isNotNull(), order)).alias(name)

    return (
        observations.filter(F.col("hex").isNotNull())
        .groupBy(CELL, SLOT, "hex")
        .agg(F.min("nic").alias("nic"), *[first_known(c) for c in values])
    )


def labelled_columns(rules: Rules) -> list[str]:
    return [
        "aircraft_count",
        "degraded_share",
        "_nic[0] AS median_nic",
        "_nic[1] AS p25_nic",
        "mean_nac_p",
        f"cast(degraded_share >= {rules.degraded_share_from!r}D AS int) AS is_degraded",
    ]


def summarise_cells(
    reports: DataFrame,
    cell: str = CELL,
    rules: Rules = DEFAULT_RULES,
    traffic_floor: bool = True,
    extra_keys: tuple[str, ...] = (),
) -> DataFrame:
    """Aggregate one-row-per-aircraft reports to (cell, slot) rows with share and label.

    Aircraft are first counted per NIC. That step is a plain hash aggregate with small rows, and
    leaves the quantiles at most one row per distinct NIC. Feeding them every aircraft would
    send one quantile buffer per aircraft through the exchange, since the deduplication before
    has spread the aircraft of a cell over all tasks.
    """
    per_nic = reports.groupBy(*extra_keys, cell, SLOT, "nic").agg(
        F.expr("count(1)").alias("_n"),
        F.expr("sum(nac_p)").alias("_nac_sum"),
        F.expr("count(nac_p)").alias("_nac_n"),
    )
    degraded = f"sum(if(nic < {rules.nic_degraded_below}, _n, 0L))"
    aggregates = {
        "aircraft_count": "cast(sum(_n) AS int)",
        "degraded_share": f"{degraded} / sum(_n)",
        "_nic": "percentile(nic, array(0.5D, 0.25D), _n)",
        "mean_nac_p": "sum(_nac_sum) / nullif(sum(_nac_n), 0L)",
    }
    grouped = per_nic.groupBy(*extra_keys, cell, SLOT).agg(
        *[F.expr(sql).alias(name) for name, sql in aggregates.items()]
    )
    labelled = grouped.selectExpr(*extra_keys, cell, SLOT, *labelled_columns(rules))
    if traffic_floor:
        labelled = labelled.filter(f"aircraft_count >= {rules.min_aircraft}")
    return labelled


def aggregate_cells(
    observations: DataFrame, rules: Rules = DEFAULT_RULES, traffic_floor: bool = True
) -> DataFrame:
    """(cell, slot) rows from reports that already carry a cell id and a slot."""
    return summarise_cells(
        worst_reports(observations, rules=rules), rules=rules, traffic_floor=traffic_floor
    )


def cell_hourly(
    observations: DataFrame,
    rules: Rules = DEFAULT_RULES,
    traffic_floor: bool = True,
    resolution: int | None = None,
) -> DataFrame:
    """Cruise filter, cells, slots and aggregation in one go, straight from raw reports.

    Grouping runs on the BIGINT cell key; the readable id is made on the small result.
    """
    step = rules.grid_resolution if resolution is None else resolution
    needed = cruise_filter(observations, rules).select(
        "observed_at", "hex", "lat", "lon", "nic", "nac_p"
    )
    keyed = with_cell_key(with_slot(needed, rules), step, CELL_KEY)
    summary = summarise_cells(
        worst_reports(keyed, CELL_KEY, rules), CELL_KEY, rules, traffic_floor
    )
    return summary.select(
        cell_name(CELL_KEY, step).alias(CELL), SLOT, *CELL_VALUES
    )


def collapse_runs(cells: DataFrame) -> DataFrame:
    """One row per (cell, slot) when several runs produced the same hour."""
    return cells.groupBy(*KEYS).agg(
        F.max("aircraft_count").alias("aircraft_count"),
        F.avg("degraded_share").alias("degraded_share"),
        # Medians of whole NICs are halves, so the value-count buffer stays small.
        F.median("median_nic").alias("median_nic"),
        F.min("p25_nic").alias("p25_nic"),
        F.avg("mean_nac_p").alias("mean_nac_p"),
        F.max("is_degraded").alias("is_degraded"),
    )
