"""The modelling table: gap-safe lags, trailing means, neighbour state, calendar and target.

Every lag is a RANGE frame over the integer hour, so a missing hour gives NULL and never the
value of an earlier one. Own and neighbour values of a cell are first put on one row per
(cell, hour). An hour in which only the neighbours were observed therefore has a row as well,
which is what makes the neighbour lags right across the cell's own gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.grid import to_adjacent
from cellhours.functions.timeslots import day_of_week, hour_index, hour_of_day
from cellhours.operators.cells import collapse_runs
from cellhours.schemas import CELL, CELL_VALUES, KEYS, LABEL, LINEAGE, SLOT, TARGET

_HOUR = "_hour"
NEIGHBOUR_VALUES = [
    "nbr_observed",
    "nbr_degraded_share_mean",
    "nbr_degraded_share_max",
    "nbr_degraded_count",
]


def _over(first: str, last: str) -> str:
    # A cell has one row per hour, so a window group is bounded by the hours of history.
    return f"OVER (PARTITION BY {CELL} ORDER BY {_HOUR} RANGE BETWEEN {first} AND {last})"


def _past(name: str, hours: int) -> str:
    """Value of a column exactly `hours` ago, NULL if that hour is missing."""
    return f"max({name}) " + _over(f"{hours} PRECEDING", f"{hours} PRECEDING")


def _trailing_mean(name: str, hours: int) -> str:
    """Mean over the observed hours of the last `hours`, the current hour excluded."""
    return f"avg({name}) " + _over(f"{hours} PRECEDING", "1 PRECEDING")


def _with_hour(df: DataFrame) -> DataFrame:
    return df.withColumn(_HOUR, hour_index(SLOT))


def _with_windows(df: DataFrame, *groups: dict[str, str]) -> DataFrame:
    """Add window columns; all share one partitioning and one order, so one sort serves them."""
    return df.selectExpr(
        "*", *[f"{sql} AS {name}" for group in groups for name, sql in group.items()]
    )


def _lag_columns(rules: Rules) -> dict[str, str]:
    out: dict[str, str] = {}
    for k in rules.lag_hours:
        out[f"degraded_share_lag_{k}h"] = _past("degraded_share", k)
        out[f"is_degraded_lag_{k}h"] = _past(LABEL, k)
    return out


def _trailing_columns(rules: Rules) -> dict[str, str]:
    out = {
        f"degraded_share_mean_{n}h": _trailing_mean("degraded_share", n)
        for n in rules.share_window_hours
    }
    for n in rules.count_window_hours:
        out[f"aircraft_count_mean_{n}h"] = _trailing_mean("aircraft_count", n)
    return out


def _neighbour_lag_columns(rules: Rules) -> dict[str, str]:
    return {
        f"nbr_degraded_share_mean_lag_{k}h": _past("nbr_degraded_share_mean", k)
        for k in rules.neighbour_lag_hours
    }


def _target_column(rules: Rules) -> dict[str, str]:
    ahead = f"{rules.horizon_hours} FOLLOWING"
    return {TARGET: f"max({LABEL}) " + _over(ahead, ahead)}


_SPREAD_DELTA = (
    "nbr_degraded_share_mean - nbr_degraded_share_mean_lag_3h AS nbr_degraded_share_delta_3h"
)


def temporal_lags(cells: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Share and label 1, 2, 3, 6, 12, 24 and 168 hours ago."""
    return _with_windows(_with_hour(cells), _lag_columns(rules)).drop(_HOUR)


def trailing_means(cells: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return _with_windows(_with_hour(cells), _trailing_columns(rules)).drop(_HOUR)


def target_ahead(cells: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The state one horizon later; NULL where that hour was not observed."""
    return _with_windows(_with_hour(cells), _target_column(rules)).drop(_HOUR)


def cell_neighbours(cells: DataFrame) -> DataFrame:
    """Ring-1 pairs of every cell that occurs."""
    return to_adjacent(cells.select(CELL).distinct(), CELL, "nbr_cell").drop("_own")


def _send_to_neighbours(cells: DataFrame, pairs: DataFrame | None, *values: str) -> DataFrame:
    """Each row once per adjacent cell, under the key of that cell."""
    slim = cells.select(*KEYS, *values)
    if pairs is None:
        sent = to_adjacent(slim, CELL, "_to")
    else:
        sent = slim.join(
            pairs.select(F.col("nbr_cell").alias(CELL), F.col(CELL).alias("_to")), CELL
        )
    return sent.select(F.col("_to").alias(CELL), SLOT, *values)


_NEIGHBOUR_AGGREGATES = {
    "nbr_observed": "count(1)",
    "nbr_degraded_share_mean": "avg(degraded_share)",
    "nbr_degraded_share_max": "max(degraded_share)",
    "nbr_degraded_count": f"sum({LABEL})",
}


def neighbour_state(cells: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Same-hour state of the observed neighbours, for cells that occur in the input.

    An unobserved neighbour sends nothing, so it is never counted as clean. `pairs`
    (h3_cell, nbr_cell) replaces the grid's own adjacency, for cells of another grid. Whether a
    cell occurs is decided on the panel, which spares a second pass over the input.
    """
    panel = _panel(cells, pairs)
    occurs = f"bool_or(_occurs) OVER (PARTITION BY {CELL})"
    known = panel.selectExpr(*KEYS, *NEIGHBOUR_VALUES, f"{occurs} AS _known")
    return known.filter("_known AND nbr_observed > 0").drop("_known")


def thin_neighbours(
    all_cells: DataFrame, rules: Rules = DEFAULT_RULES, pairs: DataFrame | None = None
) -> DataFrame:
    """Number of adjacent cells seen with too little traffic, per kept cell and hour.

    Takes the cell hours from before the traffic floor.
    """
    thin = f"aircraft_count < {rules.min_aircraft}"
    own = all_cells.selectExpr(*KEYS, f"NOT ({thin}) AS _kept", "0 AS _thin")
    sent = _send_to_neighbours(all_cells.filter(thin), pairs).selectExpr(
        *KEYS, "false AS _kept", "1 AS _thin"
    )
    return (
        own.unionByName(sent)
        .groupBy(*KEYS)
        .agg(F.expr("bool_or(_kept)").alias("_kept"), F.sum("_thin").alias("nbr_thin_count"))
        .filter("_kept")
        .drop("_kept")
    )


def _panel(cells: DataFrame, pairs: DataFrame | None) -> DataFrame:
    """Own values and neighbour state on one row per (cell, hour), in a single exchange.

    Every row goes to its own cell and to the six adjacent ones. At most seven rows meet at a
    key, and the exchange is on the cell, so the windows that follow need none.
    """
    slim = cells.select(*KEYS, *CELL_VALUES)
    if pairs is None:
        sent = to_adjacent(slim, CELL, "_to", with_self=True)
    else:
        own = slim.selectExpr("*", f"{CELL} AS _to", "true AS _own")
        others = slim.join(
            pairs.select(F.col("nbr_cell").alias(CELL), F.col(CELL).alias("_to")), CELL
        ).withColumn("_own", F.lit(False))
        sent = own.unionByName(others)
    # A neighbour is only asked for share and label; NULLs in the rest compress to nothing.
    shared = ["degraded_share", LABEL]
    private = [c for c in CELL_VALUES if c not in shared]
    moved = sent.selectExpr(
        f"_to AS {CELL}",
        SLOT,
        "_own",
        *shared,
        *[f"if(_own, {c}, NULL) AS {c}" for c in private],
    )
    seen = "NOT _own AND degraded_share IS NOT NULL"
    own_values = {c: f"max({c}) FILTER (WHERE _own)" for c in CELL_VALUES}
    received = {
        name: f"{sql} FILTER (WHERE {seen})" for name, sql in _NEIGHBOUR_AGGREGATES.items()
    }
    return (
        moved.repartition(CELL)
        .groupBy(*KEYS)
        .agg(
            F.expr("bool_or(_own)").alias("_occurs"),
            *[F.expr(sql).alias(name) for name, sql in {**own_values, **received}.items()],
        )
    )


def neighbour_lags(
    cells: DataFrame,
    rules: Rules = DEFAULT_RULES,
    unique: bool = False,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Neighbour state now, its lags and its 3 h change, for every observed cell hour."""
    panel = _with_hour(_panel(cells if unique else collapse_runs(cells), pairs))
    lags = _neighbour_lag_columns(rules)
    return (
        _with_windows(panel, lags)
        .filter("degraded_share IS NOT NULL")
        .selectExpr(*KEYS, *NEIGHBOUR_VALUES, *lags, _SPREAD_DELTA)
    )


def build_features(
    cells: DataFrame,
    rules: Rules = DEFAULT_RULES,
    require_target: bool = True,
    unique: bool = False,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Supervised table from cell hours.

    ``unique`` says that (cell, slot) is already a key, as after the aggregation, and saves the
    collapse. ``require_target=False`` keeps the rows whose future is not known yet, which is
    what a forecast scores. ``pairs`` is the adjacency of cells from another grid.
    """
    rules.require_hourly()
    panel = _with_hour(_panel(cells if unique else collapse_runs(cells), pairs))
    lags, trailing = _lag_columns(rules), _trailing_columns(rules)
    nbr_lags, target = _neighbour_lag_columns(rules), _target_column(rules)
    kept = _with_windows(panel, lags, trailing, nbr_lags, target).filter(
        "degraded_share IS NOT NULL"
    )
    if require_target:
        kept = kept.filter(f"{TARGET} IS NOT NULL")
    calendar = [hour_of_day(SLOT).alias("hour_utc"), day_of_week(SLOT).alias("day_of_week")]
    return kept.select(
        *KEYS,
        *CELL_VALUES,
        *lags,
        *trailing,
        *NEIGHBOUR_VALUES,
        *nbr_lags,
        F.expr(_SPREAD_DELTA),
        *calendar,
        TARGET,
    )


def score_rows(
    cells: DataFrame,
    rules: Rules = DEFAULT_RULES,
    unique: bool = False,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Feature rows for inference: no target column and no need for one."""
    rows = build_features(cells, rules, require_target=False, unique=unique, pairs=pairs)
    return rows.drop(TARGET)


def feature_columns(features: DataFrame) -> list[str]:
    """What a model may consume: no keys, no target, no lineage."""
    barred = {*KEYS, TARGET, *LINEAGE}
    return [c for c in features.columns if c not in barred]


def model_matrix(features: DataFrame) -> DataFrame:
    return features.select(*feature_columns(features))


def regular_grid(
    cells: DataFrame, key: str = CELL, slot: str = SLOT, step_hours: int = 1
) -> DataFrame:
    """Every key at every hour between the first and the last hour of the whole input.

    Hours without a row become rows of NULLs. The bounds are a scalar subquery and each key
    generates its own hours, so no pair of tables is multiplied.
    """
    bounds = cells.agg(F.struct(F.min(slot).alias("lo"), F.max(slot).alias("hi"))).scalar()
    hours = F.sequence(
        bounds.getField("lo"),
        bounds.getField("hi"),
        F.make_dt_interval(hours=F.lit(step_hours)),
    )
    spine = cells.select(key).distinct().select(key, F.explode(hours).alias(slot))
    return spine.join(cells, [key, slot], "left").select(*cells.columns)
