"""The polled discs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RADIUS_NM = 250.0

# Name, latitude, longitude, control region.
POINTS = (
    ("baltic_kaliningrad", 54.7, 20.5, False),
    ("gulf_of_finland", 59.4, 24.8, False),
    ("baltic_south", 55.5, 16.5, False),
    ("finland_north", 65.5, 26.0, False),
    ("black_sea_west", 44.5, 31.0, False),
    ("black_sea_east", 43.0, 38.0, False),
    ("eastern_med", 34.8, 33.5, False),
    ("levant_north", 36.5, 36.5, False),
    ("caucasus", 41.0, 44.0, False),
    ("poland_east", 52.2, 23.0, False),
    ("romania_moldova", 46.5, 27.5, False),
    ("alps_switzerland", 47.0, 8.3, True),
    ("uk_south", 51.5, -0.5, True),
    ("iberia_central", 40.4, -3.7, True),
    ("france_central", 46.5, 2.5, True),
    ("germany_central", 50.5, 9.5, True),
    ("italy_central", 42.5, 12.5, True),
    ("scandinavia_west", 59.9, 10.7, True),
)


def all_points(spark: SparkSession) -> DataFrame:
    """The dimension as a literal, so that its size is known when a join is planned."""
    rows = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(lat).alias("lat"),
            F.lit(lon).alias("lon"),
            F.lit(RADIUS_NM).alias("radius_nm"),
            F.lit(control).alias("control"),
        )
        for name, lat, lon, control in POINTS
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def active_points(points: DataFrame, include_controls: bool = True) -> DataFrame:
    return points if include_controls else points.filter(~F.col("control"))
