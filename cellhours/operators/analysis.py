"""Studies of the label, the thresholds and the drift of the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.grid import side_km, with_cell_key, with_hexagon_key, with_plane_position
from cellhours.operators.cells import (
    CELL_KEY,
    cruise_filter,
    summarise_cells,
    with_slot,
)
from cellhours.operators.coverage import SIDES
from cellhours.operators.ordering import average_ranks
from cellhours.schemas import CELL, LABEL, SLOT, TARGET
from cellhours.sources.scratch import materialise


def transition_rates(features: DataFrame) -> DataFrame:
    """How often the state changes, and how often a clean cell turns bad.

    The last rate is over clean cells with at least one degraded neighbour.
    """
    clean, bad_later = F.col(LABEL) == 0, F.col(TARGET) == 1
    near = clean & (F.col("nbr_degraded_count") >= 1)
    counts = features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(LABEL) != F.col(TARGET)).alias("transitions"),
        F.count_if(clean & bad_later).alias("onsets"),
        F.count_if(clean).alias("clean_rows"),
        F.count_if(near).alias("clean_rows_near"),
        F.count_if(near & bad_later).alias("onsets_near"),
    )
    zero = F.lit(0)
    return counts.withColumns(
        {
            "transition_rate": F.col("transitions") / F.nullif(F.col("rows"), zero),
            "onset_rate": F.col("onsets") / F.nullif(F.col("clean_rows"), zero),
            "onset_rate_near": F.col("onsets_near") / F.nullif(F.col("clean_rows_near"), zero),
        }
    )


def floor_audit(observations: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Per disc: share of its cell hours under the traffic floor, and how degraded those were.

    A cell hour counts for every disc that reported into it. The reports are read once and
    reduced to (cell, hour, aircraft, disc). Those split into their aircraft and their discs, and
    a cell hour takes its label from the former and its few discs from the latter.
    """
    needed = cruise_filter(observations, rules).select(
        "observed_at", "hex", "lat", "lon", "nic", "sample_point"
    )
    placed = with_cell_key(with_slot(needed, rules), rules.grid_resolution, CELL_KEY)
    seen = placed.groupBy(CELL_KEY, SLOT, "hex", "sample_point").agg(F.min("nic").alias("nic"))
    sides = seen.selectExpr(
        CELL_KEY, SLOT, "nic", SIDES
    )
    counted = sides.groupBy(CELL_KEY, SLOT, "_air", "_who").agg(F.min("nic").alias("nic"))
    aircraft = "_air AND _who IS NOT NULL"
    hours = counted.groupBy(CELL_KEY, SLOT).agg(
        F.expr(f"count_if({aircraft})").alias("aircraft_count"),
        F.expr(f"count_if({aircraft} AND nic < {rules.nic_degraded_below})").alias("_degraded"),
        F.expr("collect_list(if(_air, NULL, struct(_who AS sample_point)))").alias("_discs"),
    )
    by_disc = hours.filter("aircraft_count > 0").selectExpr(
        f"aircraft_count < {rules.min_aircraft} AS _dropped",
        f"cast(_degraded / aircraft_count >= {rules.degraded_share_from!r}D AS double) AS _bad",
        "inline(_discs)",
    )
    dropped, bad = F.col("_dropped"), F.col("_bad")
    return by_disc.groupBy("sample_point").agg(
        F.count(F.lit(1)).alias("cell_hours"),
        F.count_if(dropped).alias("dropped"),
        F.avg(dropped.cast("double")).alias("drop_rate"),
        F.avg(bad).alias("degraded_rate"),
        F.avg(F.when(dropped, bad)).alias("dropped_degraded_rate"),
        F.avg(F.when(~dropped, bad)).alias("kept_degraded_rate"),
    )


def floor_by_cell(all_cells: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Drop rate and degraded rate per cell, from the cell hours before the floor."""
    dropped = F.col("aircraft_count") < F.lit(rules.min_aircraft)
    return all_cells.groupBy(CELL).agg(
        F.avg(dropped.cast("double")).alias("drop_rate"),
        F.avg(F.col(LABEL).cast("double")).alias("degraded_rate"),
    )


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson's r, and Spearman's from mean ranks."""
    pairs = df.select(
        F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    ).filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    ranked = pairs.join(average_ranks(pairs, "_x", "_rank_x"), "_x").join(
        average_ranks(pairs, "_y", "_rank_y"), "_y"
    )
    return ranked.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.corr("_x", "_y").alias("pearson"),
        F.corr("_rank_x", "_rank_y").alias("spearman"),
    )


def resolution_sweep(
    observations: DataFrame,
    resolutions: tuple[int, ...] = (1, 2, 3, 4),
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """What each grid resolution would leave: usable cell hours, aircraft per cell, bad cells.

    The reports are read and projected once; only the binning is repeated per resolution.
    """
    steps = ", ".join(
        f"named_struct('resolution', {r}, 'side_km', {side_km(r)!r}D)" for r in resolutions
    )
    needed = cruise_filter(observations, rules).select(
        "observed_at", "hex", "lat", "lon", "nic", "nac_p"
    )
    placed = with_plane_position(with_slot(needed, rules)).filter(F.col("hex").isNotNull())
    binned = with_hexagon_key(
        placed.selectExpr("*", f"inline(array({steps}))"), "side_km", CELL_KEY
    )
    # The report's NACp plays no part in this summary.
    reports = binned.groupBy("resolution", "side_km", CELL_KEY, SLOT, "hex").agg(
        F.min("nic").alias("nic"), F.lit(None).cast("int").alias("nac_p")
    )
    hours = summarise_cells(
        reports, CELL_KEY, rules, traffic_floor=False, extra_keys=("resolution", "side_km")
    )
    usable = F.col("aircraft_count") >= F.lit(rules.min_aircraft)
    return hours.groupBy("resolution", "side_km").agg(
        F.count_distinct(CELL_KEY).alias("cells"),
        F.count(F.lit(1)).alias("cell_hours"),
        F.count_if(usable).alias("usable_cell_hours"),
        # Aircraft counts repeat a lot, so the value-count buffer of the median is small.
        F.median("aircraft_count").alias("median_aircraft"),
        F.count_if(usable & (F.col(LABEL) == 1)).alias("degraded_cell_hours"),
    )


def lag_availability(features: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Share of rows that have each lag."""
    shares = features.agg(
        *[
            F.avg(F.col(f"degraded_share_lag_{k}h").isNotNull().cast("double")).alias(f"_{k}")
            for k in rules.lag_hours
        ]
    )
    lines = [
        F.struct(F.lit(k).alias("lag_hours"), F.col(f"_{k}").alias("available"))
        for k in rules.lag_hours
    ]
    return shares.select(F.inline(F.array(*lines)))


def _quantile_cuts(rows: DataFrame, bins: int, blocks: int = 256) -> DataFrame:
    """Distinct exact quantiles i/bins of `value` per `feature`, as a sorted array `_cuts`.

    A quantile is the first value whose running count reaches its share of the rows, rounded up.
    Equal values are counted first. The values of a feature are then cut into blocks at rough
    quantiles, so that running counts are taken per block, from the count of the blocks before;
    where the blocks are cut does not change the result.
    """
    counted = materialise(
        rows.where("value IS NOT NULL").groupBy("feature", "value").agg(F.count("*").alias("n")),
        "quantile-counts",
    )
    at = [i / blocks for i in range(1, blocks)]
    edges = counted.groupBy("feature").agg(F.percentile_approx("value", at).alias("_edges"))
    # One row of at most `blocks` numbers per feature, whatever the number of rows.
    tagged = counted.join(F.broadcast(edges), "feature").select(
        "feature",
        "value",
        "n",
        F.size(F.filter("_edges", lambda edge: edge < F.col("value"))).alias("_block"),
    )
    whole = Window.partitionBy("feature")
    ahead = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("feature", "_block")
        .agg(F.sum("n").alias("_n"))
        .select(
            "feature",
            "_block",
            F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"),
            F.sum("_n").over(whole).alias("_total"),
        )
    )
    inside = (
        Window.partitionBy("feature", "_block")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    share = f"(_total * i + {bins - 1}) div {bins}"
    reached = (
        f"exists(sequence(1L, {bins - 1}L), i -> _upto >= {share} AND _upto - n < {share})"
    )
    return (
        tagged.join(F.broadcast(offsets), ["feature", "_block"])
        .withColumn("_upto", F.sum("n").over(inside) + F.col("_before"))
        .where(reached)
        .groupBy("feature")
        .agg(F.array_sort(F.collect_list("value")).alias("_cuts"))
    )


def psi_drift(
    reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10
) -> DataFrame:
    """Population stability index of each column between two periods.

    Bins are cut at the exact deciles of the reference period and NULL is a bin of its own.
    """
    floor = F.lit(1e-6)

    def long(df: DataFrame, current_flag: int) -> DataFrame:
        wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        return wide.unpivot([], columns, "feature", "value").withColumn(
            "_current", F.lit(current_flag)
        )

    cuts = _quantile_cuts(long(reference, 0).select("feature", "value"), bins)
    both = long(reference, 0).unionByName(long(current, 1))
    # One row per column of the table, so the broadcast does not grow with the data.
    binned = both.join(F.broadcast(cuts), "feature", "left").withColumn(
        "bin",
        F.when(F.col("value").isNull(), F.lit(-1)).otherwise(
            F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("value"))), F.lit(0))
        ),
    )
    counts = binned.groupBy("feature", "bin").agg(
        F.sum(F.lit(1) - F.col("_current")).alias("_p"), F.sum("_current").alias("_q")
    )
    per_feature = Window.partitionBy("feature")
    shares = counts.select(
        "feature",
        F.greatest(F.col("_p") / F.sum("_p").over(per_feature), floor).alias("p"),
        F.greatest(F.col("_q") / F.sum("_q").over(per_feature), floor).alias("q"),
    )
    return shares.groupBy("feature").agg(
        F.count(F.lit(1)).alias("bins"),
        F.sum((F.col("p") - F.col("q")) * F.ln(F.col("p") / F.col("q"))).alias("psi"),
    )
