"""Discs and regions: which polled disc covers a report, and how the regions compare."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.grid import EARTH_RADIUS_KM, NAUTICAL_MILE_KM, great_circle_km_sql
from cellhours.schemas import CELL


def _disc_tiles(points: DataFrame) -> DataFrame:
    """Each disc once per one-degree tile it can touch."""
    reach = F.col("radius_nm") * F.lit(NAUTICAL_MILE_KM / EARTH_RADIUS_KM)
    south, north = F.col("lat") - F.degrees(reach), F.col("lat") + F.degrees(reach)
    over_pole = (south <= -90.0) | (north >= 90.0)
    # Widest longitude difference on a small circle of this radius.
    half = F.when(over_pole, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), F.sin(reach) / F.cos(F.radians("lat")))))
    )
    banded = points.select(
        F.col("name").alias("disc"),
        F.col("lat").alias("disc_lat"),
        F.col("lon").alias("disc_lon"),
        "radius_nm",
        "control",
        half.alias("_half"),
        F.explode(
            F.sequence(
                F.floor(F.greatest(south, F.lit(-90.0))), F.floor(F.least(north, F.lit(90.0)))
            )
        ).alias("lat_tile"),
    )
    first = F.floor(F.col("disc_lon") - F.col("_half") + 180.0)
    last = F.least(first + 359, F.floor(F.col("disc_lon") + F.col("_half") + 180.0))
    return banded.withColumn(
        "lon_tile", F.explode(F.transform(F.sequence(first, last), lambda t: F.pmod(t, F.lit(360))))
    ).drop("_half")


def disc_membership(observations: DataFrame, points: DataFrame) -> DataFrame:
    """Every report once per disc whose radius covers it.

    Reports and discs meet on one-degree tiles, then the distance decides. That keeps it an
    equi-join: a small disc table is broadcast by its known size, a large one is shuffled, and
    a crowded tile is split by the adaptive skew join.
    """
    tiled = observations.withColumns(
        {
            "lat_tile": F.expr("floor(lat)"),
            "lon_tile": F.expr("pmod(floor(lon + 180D), 360L)"),
        }
    )
    apart = great_circle_km_sql("disc_lat", "disc_lon", "lat", "lon")
    distance = F.expr(f"{apart} / {NAUTICAL_MILE_KM}D")
    return (
        tiled.join(_disc_tiles(points), ["lat_tile", "lon_tile"])
        .withColumn("distance_nm", distance)
        .filter(F.col("distance_nm") <= F.col("radius_nm"))
        .select(*observations.columns, "disc", "control", "distance_nm")
    )


def region_rollup(
    observations: DataFrame, points: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Degraded share per disc over all reports and over cruise reports only.

    The reports are aggregated before the disc attributes are joined on.
    """
    bad = (F.col("nic") < F.lit(rules.nic_degraded_below)).cast("double")
    cruise = F.col("altitude_ft") >= F.lit(rules.min_altitude_ft)
    per_disc = observations.groupBy("sample_point").agg(
        F.count(F.lit(1)).alias("reports"),
        F.avg(bad).alias("degraded_share"),
        F.count_if(cruise).alias("cruise_reports"),
        F.avg(F.when(cruise, bad)).alias("cruise_degraded_share"),
    )
    attributes = points.select(F.col("name").alias("sample_point"), F.col("control"))
    return per_disc.join(attributes, "sample_point", "left").select(
        "sample_point",
        "control",
        "reports",
        "degraded_share",
        "cruise_reports",
        "cruise_degraded_share",
    )


def cell_regions(located: DataFrame) -> DataFrame:
    """Region of a cell: control if at least half of its reports came from control discs."""
    share = F.avg(F.col("is_control_region").cast("double"))
    return located.groupBy(CELL).agg(
        F.when(share >= 0.5, "control").otherwise("interference").alias("region")
    )
