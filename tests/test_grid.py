from __future__ import annotations

import math

from pyspark.sql import functions as F

from cellhours.functions.grid import side_km, to_adjacent
from cellhours.operators.cells import assign_cells
from cellhours.operators.discs import disc_membership
from cellhours.sources.points import active_points, all_points
from tests.conftest import EAST, EAST_CELL, HOME, HOME_CELL, T0, observations, report


def test_cells_of_known_positions_and_missing_positions(spark):
    rows = [report("a", 8, T0, HOME), report("b", 8, T0, EAST), report("c", 8, T0, (None, 10.0))]
    cells = {r.hex: r.h3_cell for r in assign_cells(observations(spark, rows)).collect()}
    assert cells == {"a": HOME_CELL, "b": EAST_CELL}


def test_resolution_is_a_read_time_choice(spark):
    located = assign_cells(observations(spark, [report("a", 8, T0, EAST)]), resolution=4)
    assert located.first().h3_cell.startswith("4_")
    assert math.isclose(side_km(2) / side_km(4), 7.0)


def test_adjacency_has_six_cells_and_is_symmetric(spark):
    cells = spark.createDataFrame([("2_-3_5",), ("2_0_0",)], "h3_cell string")
    ring = to_adjacent(cells, "h3_cell", "nbr_cell").select("h3_cell", "nbr_cell")
    assert ring.distinct().count() == 12
    back = to_adjacent(ring.selectExpr("nbr_cell AS c", "h3_cell AS home"), "c", "d")
    assert back.filter("d = home").count() == 12


def test_hexagons_have_the_nominal_area(spark):
    """Random points fall into cells in proportion to equal areas."""
    points = spark.range(40_000).selectExpr(
        "timestamp'2026-01-01' AS observed_at",
        "52D + (rand(1) - 0.5D) * 16D AS lat",
        "10D + (rand(2) - 0.5D) * 20D AS lon",
    )
    # Weighted by cos(lat), because equal steps of longitude shrink to the north.
    weight = F.sum(F.cos(F.radians("lat"))).alias("w")
    counts = assign_cells(points).groupBy("h3_cell").agg(weight)
    inner = [r.w for r in counts.collect() if r.h3_cell in {"2_0_0", "2_1_0", "2_-1_0", "2_0_1"}]
    assert max(inner) / min(inner) < 1.1


def brute_force(rows, points):
    found = set()
    for r in rows:
        for p in points:
            a1, b1, a2, b2 = map(math.radians, (p[1], p[2], r["lat"], r["lon"]))
            h = (
                math.sin((a2 - a1) / 2) ** 2
                + math.cos(a1) * math.cos(a2) * math.sin((b2 - b1) / 2) ** 2
            )
            if 2 * 6371.007 * math.asin(math.sqrt(min(1, h))) / 1.852 <= p[3]:
                found.add((r["hex"], p[0]))
    return found


def test_disc_membership_equals_brute_force_also_at_pole_and_date_line(spark):
    points = [
        ("mid", 50.0, 10.0, 250.0, False),
        ("overlap", 51.0, 12.0, 250.0, True),
        ("pole", 88.0, 0.0, 250.0, False),
        ("line", 10.0, 179.5, 250.0, False),
        ("south", -89.0, 40.0, 120.0, True),
    ]
    places = [
        (a, o)
        for a in (-90.0, -88.5, 6.5, 10.0, 13.9, 46.0, 50.0, 52.5, 84.1, 89.9, 90.0)
        for o in (-180.0, -179.0, -176.0, 0.0, 4.0, 10.0, 14.0, 16.5, 100.0, 178.0, 179.99)
    ]
    rows = [report(f"h{i}", 8, T0, place) for i, place in enumerate(places)]
    discs = spark.createDataFrame(
        points, "name string, lat double, lon double, radius_nm double, control boolean"
    )
    covered = disc_membership(observations(spark, rows), discs).collect()
    assert {(r.hex, r.disc) for r in covered} == brute_force(rows, points)
    assert len(covered) == len({(r.hex, r.disc) for r in covered})


def test_points_dimension(spark):
    points = all_points(spark)
    assert points.count() == 18
    assert active_points(points, include_controls=False).count() == 11
    assert points.select("name").distinct().count() == 18
