"""Shared CTEs of the check SQL: the same tables as the Spark side, written independently.

`with_ctes("name", ...)` returns the `WITH` clause that defines the named tables and whatever
they build on.
"""

from __future__ import annotations

import math

from cellhours.config import DEFAULT_RULES as R
from cellhours.functions import grid

_SIN0 = repr(math.sin(math.radians(grid.CENTRE_LAT)))
_COS0 = repr(math.cos(math.radians(grid.CENTRE_LAT)))


def _hour(ts: str) -> str:
    return f"CAST(floor(epoch({ts}) / 3600) AS BIGINT)"


EV = f"""
  SELECT event_id, user_id, event_type, ts, event_id % 12 AS site, {_hour('ts')} AS eh
  FROM events"""

FAN = """
  SELECT ev.*, CAST(i AS BIGINT) AS i FROM ev, range(12) AS t(i)"""

# Position, NIC and NACp of report i of an event.
_LAT = "50.0 + (site % 4) * 2.5 + ((event_id * 31 + i * 7) % 100) / 200.0"
_LON = "10.0 + (site // 4) * 4.0 + ((event_id * 17 + i * 3) % 100) / 200.0"
_NIC = """CASE WHEN ((eh // 8) + site) % 7 = 0 AND (event_id + i) % 3 <> 0
              THEN (event_id + i) % 7 ELSE 7 + (event_id + i) % 5 END"""
_NACP = "CASE WHEN (event_id * 5 + i) % 13 <> 0 THEN 8 + i % 4 END"

REP = f"""
  SELECT event_id, site, event_type AS aircraft_type, ts + to_minutes(i) AS observed_at,
         'u' || user_id || '_' || i AS hex,
         CAST({_LAT} AS DOUBLE) AS lat, CAST({_LON} AS DOUBLE) AS lon,
         CASE WHEN (event_id + i) % 11 <> 0
              THEN CAST(15000 + ((event_id * 13 + i * 997) % 250) * 100 AS DOUBLE) END
           AS altitude_ft,
         {_NIC} AS nic, {_NACP} AS nac_p
  FROM fan"""

OBS = f"""
  SELECT observed_at, date_trunc('hour', observed_at) AS slot_start, hex, lat, lon, altitude_ft,
         nic, CASE WHEN disc = site THEN nac_p ELSE nac_p - event_id % 3 END AS nac_p, 3 AS sil,
         aircraft_type, 'p' || disc AS sample_point,
         disc % 3 = 0 AS is_control_region, 'run-' || {_hour('observed_at')} AS ingest_run_id
  FROM (SELECT rep.*, (site + d) % 12 AS disc
        FROM rep, range(2) AS t(d)
        WHERE (d = 0 OR event_id % 10 = 0) AND {_hour('observed_at')} % 37 NOT IN (5, 6))"""

CRUISE = f"""
  SELECT * FROM obs WHERE altitude_ft >= {R.min_altitude_ft}"""


def located(source: str, side: str, step: str) -> str:
    """SQL that adds h3_cell to the rows of `source`; side and step may be column names."""
    return f"""
  SELECT * EXCLUDE (sl, cl, so, co, k, x, y, fq, fr, rq, rr, rs, dq, dr, ds),
         {step} || '_' || CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT)
           AS VARCHAR) || '_' ||
         CAST(CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -rq - rs ELSE rr END
           AS BIGINT) AS VARCHAR) AS h3_cell
  FROM (
   SELECT *, abs(rq - fq) AS dq, abs(rr - fr) AS dr, abs(rs + fq + fr) AS ds
   FROM (
    SELECT *, floor(fq + 0.5) AS rq, floor(fr + 0.5) AS rr, floor(-fq - fr + 0.5) AS rs
    FROM (
     SELECT *, ({math.sqrt(3.0) / 3.0!r}::DOUBLE * x - {1.0 / 3.0!r}::DOUBLE * y) / {side} AS fq,
            {2.0 / 3.0!r}::DOUBLE * y / {side} AS fr
     FROM (
      SELECT *, k * (cl * so) AS x, k * ({_COS0}::DOUBLE * sl - {_SIN0}::DOUBLE * cl * co) AS y
      FROM (
       SELECT *, {grid.EARTH_RADIUS_KM}::DOUBLE
                * sqrt(2.0 / (1.0 + {_SIN0}::DOUBLE * sl + {_COS0}::DOUBLE * cl * co)) AS k
       FROM (
        SELECT *, sin(radians(lat)) AS sl, cos(radians(lat)) AS cl,
               sin(radians(lon - {grid.CENTRE_LON})) AS so,
               cos(radians(lon - {grid.CENTRE_LON})) AS co
        FROM {source}))))))"""


LOCATED = located("cruise", f"{grid.side_km(R.grid_resolution)!r}::DOUBLE", "'2'")

WORST = """
  SELECT h3_cell, slot_start, hex, min(nic) AS nic,
         arg_min(nac_p, row(nic, observed_at, nac_p)) FILTER (WHERE nac_p IS NOT NULL) AS nac_p
  FROM located GROUP BY ALL"""

ALL_CELLS = f"""
  SELECT *, CASE WHEN degraded_share >= {R.degraded_share_from}::DOUBLE THEN 1 ELSE 0 END AS is_degraded
  FROM (SELECT h3_cell, slot_start, count(*) AS aircraft_count,
               avg(CASE WHEN nic < {R.nic_degraded_below} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
                 AS degraded_share,
               quantile_cont(nic, 0.5) AS median_nic, quantile_cont(nic, 0.25) AS p25_nic,
               avg(nac_p) AS mean_nac_p
        FROM worst GROUP BY h3_cell, slot_start)"""

CELLS = f"""
  SELECT *, CAST(epoch(slot_start) / 3600 AS BIGINT) AS h
  FROM all_cells WHERE aircraft_count >= {R.min_aircraft}"""

PAIRS = """
  SELECT c.h3_cell,
         split_part(c.h3_cell, '_', 1) || '_' || (CAST(split_part(c.h3_cell, '_', 2) AS INT) + d.dq)
           || '_' || (CAST(split_part(c.h3_cell, '_', 3) AS INT) + d.dr) AS nbr_cell
  FROM (SELECT DISTINCT h3_cell FROM cells) c,
       (VALUES (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1)) AS d(dq, dr)"""

NBR = """
  SELECT p.h3_cell, c.slot_start, c.h, count(*) AS nbr_observed,
         avg(c.degraded_share) AS nbr_degraded_share_mean,
         max(c.degraded_share) AS nbr_degraded_share_max,
         CAST(sum(c.is_degraded) AS BIGINT) AS nbr_degraded_count
  FROM pairs p JOIN cells c ON c.h3_cell = p.nbr_cell GROUP BY ALL"""

_LAGS = ",\n         ".join(
    f"l{k}.degraded_share AS degraded_share_lag_{k}h, l{k}.is_degraded AS is_degraded_lag_{k}h"
    for k in R.lag_hours
)
_LAG_JOINS = "\n  ".join(
    f"LEFT JOIN cells l{k} ON l{k}.h3_cell = c.h3_cell AND l{k}.h = c.h - {k}"
    for k in R.lag_hours
)
# Lags as self joins, where the Spark side uses RANGE frames.
LAGGED = f"""
  SELECT c.*,
         {_LAGS}
  FROM cells c
  {_LAG_JOINS}"""

TRAILED = """
  SELECT c.h3_cell, c.slot_start,
         avg(p.degraded_share) FILTER (WHERE p.h >= c.h - 6) AS degraded_share_mean_6h,
         avg(p.degraded_share) AS degraded_share_mean_24h,
         avg(p.aircraft_count) AS aircraft_count_mean_24h
  FROM cells c LEFT JOIN cells p
    ON p.h3_cell = c.h3_cell AND p.h BETWEEN c.h - 24 AND c.h - 1
  GROUP BY ALL"""

NBR_LAGGED = """
  SELECT c.h3_cell, c.slot_start, coalesce(n0.nbr_observed, 0) AS nbr_observed,
         n0.nbr_degraded_share_mean, n0.nbr_degraded_share_max, n0.nbr_degraded_count,
         n1.nbr_degraded_share_mean AS nbr_degraded_share_mean_lag_1h,
         n3.nbr_degraded_share_mean AS nbr_degraded_share_mean_lag_3h,
         n6.nbr_degraded_share_mean AS nbr_degraded_share_mean_lag_6h,
         n0.nbr_degraded_share_mean - n3.nbr_degraded_share_mean AS nbr_degraded_share_delta_3h
  FROM cells c
  LEFT JOIN nbr n0 ON n0.h3_cell = c.h3_cell AND n0.h = c.h
  LEFT JOIN nbr n1 ON n1.h3_cell = c.h3_cell AND n1.h = c.h - 1
  LEFT JOIN nbr n3 ON n3.h3_cell = c.h3_cell AND n3.h = c.h - 3
  LEFT JOIN nbr n6 ON n6.h3_cell = c.h3_cell AND n6.h = c.h - 6"""

SCORABLE = f"""
  SELECT l.* EXCLUDE (h), t.* EXCLUDE (h3_cell, slot_start), n.* EXCLUDE (h3_cell, slot_start),
         hour(l.slot_start) AS hour_utc, isodow(l.slot_start) - 1 AS day_of_week,
         f.is_degraded AS target_is_degraded
  FROM lagged l
  JOIN trailed t USING (h3_cell, slot_start)
  JOIN nbr_lagged n USING (h3_cell, slot_start)
  LEFT JOIN cells f ON f.h3_cell = l.h3_cell AND f.h = l.h + {R.horizon_hours}"""

FEATURES = """
  SELECT * FROM scorable WHERE target_is_degraded IS NOT NULL"""

HOURLY_RUNS = f"""
  SELECT eh, 'run-' || eh AS run_id, make_timestamp(eh * 3600 * 1000000) AS slot_start,
         CASE WHEN eh % 37 IN (5, 6) THEN 0 ELSE count(DISTINCT site) END AS answered,
         count(*) * 12 AS reports
  FROM ev GROUP BY eh"""

RUNS = """
  SELECT run_id, slot_start AS started_at,
         CASE WHEN closed THEN slot_start + INTERVAL 7 MINUTE END AS finished_at, slot_start,
         12 AS points_attempted, CASE WHEN closed THEN answered ELSE 0 END AS points_succeeded,
         CASE WHEN closed AND answered > 0 THEN reports ELSE 0 END AS aircraft_written,
         CASE WHEN NOT closed THEN 'running' WHEN answered = 0 THEN 'failed'
              WHEN answered < 12 THEN 'partial' ELSE 'ok' END AS status,
         CASE WHEN closed AND answered < 12 THEN (12 - answered) || ' discs silent' END AS error
  FROM (SELECT *, eh % 50 <> 0 AS closed FROM hourly_runs)"""

COVERAGE = """
  SELECT s.slot_start, count(o.hex) AS observations, count(DISTINCT o.hex) AS aircraft,
         count(DISTINCT o.sample_point) AS points
  FROM (SELECT unnest(generate_series(min(slot_start), max(slot_start), INTERVAL 1 HOUR))
          AS slot_start FROM obs) s
  LEFT JOIN obs o ON o.slot_start = s.slot_start
  GROUP BY s.slot_start"""

# name -> (SQL, names it builds on)
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "ev": (EV, ()),
    "fan": (FAN, ("ev",)),
    "rep": (REP, ("fan",)),
    "obs": (OBS, ("rep",)),
    "cruise": (CRUISE, ("obs",)),
    "located": (LOCATED, ("cruise",)),
    "worst": (WORST, ("located",)),
    "all_cells": (ALL_CELLS, ("worst",)),
    "cells": (CELLS, ("all_cells",)),
    "pairs": (PAIRS, ("cells",)),
    "nbr": (NBR, ("pairs",)),
    "lagged": (LAGGED, ("cells",)),
    "trailed": (TRAILED, ("cells",)),
    "nbr_lagged": (NBR_LAGGED, ("nbr",)),
    "scorable": (SCORABLE, ("lagged", "trailed", "nbr_lagged")),
    "features": (FEATURES, ("scorable",)),
    "hourly_runs": (HOURLY_RUNS, ("ev",)),
    "runs": (RUNS, ("hourly_runs",)),
    "coverage": (COVERAGE, ("obs",)),
}


def with_ctes(*names: str, also: dict[str, str] | None = None) -> str:
    """`WITH` clause for the named tables, in order of use; `also` appends ad-hoc ones."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for base in TABLES[name][1]:
            visit(base)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{name} AS MATERIALIZED ({TABLES[name][0]})" for name in ordered]
    parts += [f"{name} AS ({sql})" for name, sql in (also or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n"
