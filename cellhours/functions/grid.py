"""A hexagonal equal-area grid as column expressions.

Positions are projected with the spherical Lambert azimuthal equal-area projection (Snyder 1987)
and binned into pointy-top hexagons. Resolution follows an aperture-7 ladder whose step 2 has the
mean hexagon area of the reference product's cells (side 182.78 km); each finer step divides the
side by the square root of 7. A cell id is the text ``<resolution>_<q>_<r>`` of its axial
coordinates; inside the heavy aggregation the same cell travels as one BIGINT.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the grid.
EARTH_RADIUS_KM = 6371.007
CENTRE_LAT = 52.0
CENTRE_LON = 10.0
SIDE_KM_AT_STEP_2 = 182.78
NAUTICAL_MILE_KM = 1.852
AXIAL_STEPS = ((1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1))

_KEY_OFFSET = 1 << 30
_KEY_SPAN = 1 << 31


def side_km(resolution: int) -> float:
    return SIDE_KM_AT_STEP_2 * math.pow(7.0, (2 - resolution) / 2.0)


def with_plane_position(df: DataFrame) -> DataFrame:
    """Add the projected position `_x`, `_y` in km of every row that has `lat` and `lon`.

    The steps are separate projections on purpose: each trigonometric value is computed once per
    row and all of them stay in the scan's code-generated stage.
    """
    sin0, cos0 = math.sin(math.radians(CENTRE_LAT)), math.cos(math.radians(CENTRE_LAT))
    trig = df.filter("lat IS NOT NULL AND lon IS NOT NULL").selectExpr(
        "*",
        "sin(radians(lat)) AS _sl",
        "cos(radians(lat)) AS _cl",
        f"sin(radians(lon - {CENTRE_LON}D)) AS _so",
        f"cos(radians(lon - {CENTRE_LON}D)) AS _co",
    )
    scaled = trig.selectExpr(
        "* EXCEPT (_sl, _cl, _so, _co)",
        "_cl * _so AS _ux",
        f"{cos0!r}D * _sl - {sin0!r}D * _cl * _co AS _uy",
        f"{EARTH_RADIUS_KM}D * sqrt(2D / (1D + {sin0!r}D * _sl + {cos0!r}D * _cl * _co)) AS _k",
    )
    return scaled.selectExpr("* EXCEPT (_ux, _uy, _k)", "_k * _ux AS _x", "_k * _uy AS _y")


def with_hexagon_key(df: DataFrame, side: str, out: str) -> DataFrame:
    """Replace `_x`, `_y` by the BIGINT key of the hexagon around them.

    `side` is the side in km, as SQL: a number or a column.
    """
    axial = df.selectExpr(
        "* EXCEPT (_x, _y)",
        f"({math.sqrt(3.0) / 3.0!r}D * _x - {1.0 / 3.0!r}D * _y) / {side} AS _fq",
        f"{2.0 / 3.0!r}D * _y / {side} AS _fr",
    )
    # Cube rounding. floor(x + 0.5) has the same tie rule in every engine.
    rounded = axial.selectExpr(
        "*",
        "floor(_fq + 0.5D) AS _rq",
        "floor(_fr + 0.5D) AS _rr",
        "floor(-_fq - _fr + 0.5D) AS _rs",
    )
    errors = rounded.selectExpr(
        "* EXCEPT (_fq, _fr)",
        "abs(_rq - _fq) AS _dq",
        "abs(_rr - _fr) AS _dr",
        "abs(_rs + _fq + _fr) AS _ds",
    )
    q = "if(_dq > _dr AND _dq > _ds, -_rr - _rs, _rq)"
    r = "if(NOT (_dq > _dr AND _dq > _ds) AND _dr > _ds, -_rq - _rs, _rr)"
    key = f"({q} + {_KEY_OFFSET}L) * {_KEY_SPAN}L + {r} + {_KEY_OFFSET}L"
    # Rows without a position are gone, so the fallback never shows. It makes the key non-NULL by
    # type: otherwise every join on a cell would add a NULL check, and the optimizer would push
    # that check, with all of the arithmetic above inlined into it, down to the scan.
    return errors.selectExpr(
        "* EXCEPT (_rq, _rr, _rs, _dq, _dr, _ds)", f"coalesce({key}, -1L) AS {out}"
    )


def with_cell_key(df: DataFrame, resolution: int, out: str) -> DataFrame:
    """Add the BIGINT cell key of each position at one resolution."""
    return with_hexagon_key(with_plane_position(df), f"{side_km(resolution)!r}D", out)


def cell_name(key: str, resolution: int) -> Column:
    """Readable id of a cell key."""
    return F.expr(
        f"concat('{resolution}_', cast(shiftright({key}, 31) - {_KEY_OFFSET}L AS string), '_', "
        f"cast(({key} & {_KEY_SPAN - 1}L) - {_KEY_OFFSET}L AS string))"
    )


def to_adjacent(df: DataFrame, cell: str, out: str, with_self: bool = False) -> DataFrame:
    """Each row once per adjacent cell, whose id becomes `out`; `_own` marks the cell itself."""
    steps = (((0, 0),) if with_self else ()) + AXIAL_STEPS
    offsets = ", ".join(f"named_struct('_dq', {dq}, '_dr', {dr})" for dq, dr in steps)
    parts = df.selectExpr(
        "*",
        f"split_part({cell}, '_', 1) AS _step",
        f"cast(split_part({cell}, '_', 2) AS int) AS _q",
        f"cast(split_part({cell}, '_', 3) AS int) AS _r",
        f"inline(array({offsets}))",
    )
    return parts.selectExpr(
        "* EXCEPT (_step, _q, _r, _dq, _dr)",
        "concat(_step, '_', cast(_q + _dq AS string), '_', cast(_r + _dr AS string)) AS " + out,
        "_dq = 0 AND _dr = 0 AS _own",
    )


def great_circle_km_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Haversine distance."""
    half_lat = f"sin(radians({lat2} - {lat1}) / 2D)"
    half_lon = f"sin(radians({lon2} - {lon1}) / 2D)"
    across = f"cos(radians({lat1})) * cos(radians({lat2})) * {half_lon} * {half_lon}"
    return f"{2.0 * EARTH_RADIUS_KM!r}D * asin(sqrt(least(1D, {half_lat} * {half_lat} + {across})))"
