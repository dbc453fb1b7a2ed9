"""Check SQL (DuckDB) for every registered query, over the same tables."""

from __future__ import annotations

from cellhours.config import DEFAULT_RULES as R
from cellhours.functions import grid
from cellhours.plans.oracle_base import located, with_ctes
from cellhours.sources.points import POINTS
from cellhours.sources.runs import ABANDONED_NOTE

ORACLES: dict[str, str] = {}

OBS_COLUMNS = (
    "observed_at, slot_start, hex, round(lat, 9) AS lat, round(lon, 9) AS lon, altitude_ft, "
    "nic, nac_p, sil, aircraft_type, sample_point, is_control_region"
)
FULL_OBS = f"{OBS_COLUMNS}, ingest_run_id"
READ_FROM, READ_TO = "TIMESTAMP '2024-01-05 00:00:00'", "TIMESTAMP '2024-01-20 12:00:00'"
STORED_BEFORE = "TIMESTAMP '2024-01-16 00:00:00'"
CELL_COLUMNS = (
    "h3_cell, slot_start, aircraft_count, round(degraded_share, 9) AS degraded_share, "
    "round(median_nic, 9) AS median_nic, round(p25_nic, 9) AS p25_nic, "
    "round(mean_nac_p, 9) AS mean_nac_p, is_degraded"
)
LAG_COLUMNS = ", ".join(
    f"round(degraded_share_lag_{k}h, 9) AS degraded_share_lag_{k}h, is_degraded_lag_{k}h"
    for k in R.lag_hours
)
TRAIL_COLUMNS = ", ".join(
    f"round({c}, 9) AS {c}"
    for c in ("degraded_share_mean_6h", "degraded_share_mean_24h", "aircraft_count_mean_24h")
)
NBR_COLUMNS = "nbr_observed, nbr_degraded_count, " + ", ".join(
    f"round({c}, 9) AS {c}"
    for c in (
        "nbr_degraded_share_mean",
        "nbr_degraded_share_max",
        "nbr_degraded_share_mean_lag_1h",
        "nbr_degraded_share_mean_lag_3h",
        "nbr_degraded_share_mean_lag_6h",
        "nbr_degraded_share_delta_3h",
    )
)
SCORE_COLUMNS = f"{CELL_COLUMNS}, {LAG_COLUMNS}, {TRAIL_COLUMNS}, {NBR_COLUMNS}, hour_utc, day_of_week"
FEATURE_COLUMNS = f"{SCORE_COLUMNS}, target_is_degraded"


def _add(name: str, *tables: str, sql: str, also: dict[str, str] | None = None) -> None:
    ORACLES[name] = (with_ctes(*tables, also=also) if tables or also else "") + sql.strip()


# --- sources and sinks ------------------------------------------------------------------------

# Feed answers: poll time is the event's own, and the altitude has seven spellings.
FEED = """
  SELECT ts AS observed_at, event_id, i, site, event_type AS aircraft_type,
         'u' || user_id || '_' || i AS hex,
         CASE WHEN (event_id + i) % 17 <> 0
              THEN 50.0 + (site % 4) * 2.5 + ((event_id * 31 + i * 7) % 100) / 200.0 END AS lat,
         10.0 + (site // 4) * 4.0 + ((event_id * 17 + i * 3) % 100) / 200.0 AS lon,
         CASE WHEN (event_id + i) % 19 <> 0 THEN
           CASE WHEN ((eh // 8) + site) % 7 = 0 AND (event_id + i) % 3 <> 0
                THEN (event_id + i) % 7 ELSE 7 + (event_id + i) % 5 END END AS nic,
         CASE WHEN (event_id * 5 + i) % 13 <> 0 THEN 8 + i % 4 END AS nac_p,
         CASE (event_id + i) % 11 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
              WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN 0.0::DOUBLE
              WHEN 6 THEN 15000.5::DOUBLE + ((event_id * 13 + i * 997) % 250) * 100
              ELSE 15000.0::DOUBLE + ((event_id * 13 + i * 997) % 250) * 100 END AS altitude_ft,
         eh
  FROM fan"""
FEED_REPORTS = """
  SELECT observed_at, date_trunc('hour', observed_at) AS slot_start, hex, lat::DOUBLE AS lat,
         lon::DOUBLE AS lon, altitude_ft, nic, nac_p, 3 AS sil, aircraft_type,
         'p' || site AS sample_point, site % 3 = 0 AS is_control_region,
         'run-' || eh AS ingest_run_id
  FROM feed WHERE lat IS NOT NULL AND nic IS NOT NULL"""
_FEED = {"feed": FEED, "feed_reports": FEED_REPORTS}

_add("snapshot_flatten", "fan", also=_FEED, sql=f"SELECT {FULL_OBS} FROM feed_reports")
_add(
    "altitude_parse",
    "fan",
    also={"feed": FEED},
    sql="SELECT altitude_ft AS alt, count(*) AS reports FROM feed GROUP BY 1",
)


def _cells_from(source: str, side: str, step: str) -> dict[str, str]:
    """CTEs that aggregate the reports of `source` to cell hours named `made_cells`."""
    return {
        "made_located": located(source, side, step),
        "made_worst": """
  SELECT h3_cell, slot_start, hex, min(nic) AS nic,
         arg_min(nac_p, row(nic, observed_at, nac_p)) FILTER (WHERE nac_p IS NOT NULL) AS nac_p
  FROM made_located GROUP BY ALL""",
        "made_cells": f"""
  SELECT *, CASE WHEN degraded_share >= 0.3::DOUBLE THEN 1 ELSE 0 END AS is_degraded
  FROM (SELECT h3_cell, slot_start, count(*) AS aircraft_count,
               avg(CASE WHEN nic < 7 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS degraded_share,
               quantile_cont(nic, 0.5) AS median_nic, quantile_cont(nic, 0.25) AS p25_nic,
               avg(nac_p) AS mean_nac_p
        FROM made_worst GROUP BY ALL)
  WHERE aircraft_count >= {R.min_aircraft}""",
    }


_SIDE_2 = f"{grid.side_km(2)!r}::DOUBLE"
_add(
    "snapshot_cells",
    "fan",
    also={
        **_FEED,
        "live": "SELECT * FROM feed_reports WHERE altitude_ft >= 20000",
        **_cells_from("live", _SIDE_2, "'2'"),
    },
    sql=f"SELECT {CELL_COLUMNS} FROM made_cells",
)
_add(
    "legacy_load",
    "cruise",
    sql=f"SELECT {OBS_COLUMNS.replace('slot_start, ', '')} FROM cruise",
)
LEGACY = """
  SELECT * REPLACE ('legacy-parquet-' || strftime(slot_start, '%Y%m%dT%H') AS ingest_run_id)
  FROM cruise"""
_add("legacy_reshape", "cruise", also={"legacy": LEGACY}, sql=f"SELECT {FULL_OBS} FROM legacy")
LEGACY_DEDUP = """
  SELECT * REPLACE (nic - CASE WHEN nac_p = 9 THEN 2 ELSE 0 END AS nic) FROM legacy"""
_add(
    "legacy_dedup",
    "cruise",
    also={"legacy": LEGACY, "kept": LEGACY_DEDUP},
    sql=f"SELECT {FULL_OBS} FROM kept",
)
_add(
    "import_summary",
    "cruise",
    sql=f"""
SELECT count(*) AS prepared, min(slot_start) AS first_slot, max(slot_start) AS last_slot,
       count(DISTINCT slot_start) AS slots,
       count(*) FILTER (WHERE slot_start >= {STORED_BEFORE}) AS inserted,
       count(*) FILTER (WHERE slot_start < {STORED_BEFORE}) AS already_present
FROM cruise""",
)
_add(
    "legacy_import",
    "cruise",
    also={"legacy": LEGACY},
    sql="""
SELECT CAST(slot_start AS DATE) AS slot_date, count(*) AS rows,
       min(ingest_run_id) AS first_run, max(ingest_run_id) AS last_run,
       (SELECT count(*) FROM legacy) AS added_first, 0 AS added_again
FROM legacy GROUP BY 1""",
)
_add(
    "read_observations",
    "cruise",
    sql=f"""
SELECT {OBS_COLUMNS} FROM cruise WHERE slot_start BETWEEN {READ_FROM} AND {READ_TO}""",
)
_add(
    "read_stored_range",
    "obs",
    sql=f"""
SELECT {OBS_COLUMNS} FROM obs WHERE slot_start BETWEEN {READ_FROM} AND {READ_TO}""",
)
_add(
    "append_if_absent",
    "obs",
    sql=f"""
SELECT {FULL_OBS}, (SELECT count(*) FROM obs WHERE slot_start >= {STORED_BEFORE}) AS added,
       0 AS replayed
FROM obs""",
)
_add(
    "append_concurrent",
    "obs",
    sql=f"SELECT {FULL_OBS}, (SELECT count(*) FROM obs) AS added FROM obs",
)
_BROKEN = """
  SELECT 'run-' || eh AS run_id, eh, site, 'p' || site AS sample_point, count(*) * 12 AS broken
  FROM ev WHERE event_id % 23 = 0 GROUP BY eh, site"""
_add(
    "broken_answers",
    "ev",
    also={"unread": _BROKEN},
    sql="SELECT run_id, sample_point, broken FROM unread",
)
_add("run_state", "runs", sql="SELECT * FROM runs")
_add(
    "publish_refused",
    "features",
    sql="""
SELECT 'features-20240201T000000Z' AS feature_run_id, count(*) AS rows, false AS published,
       1 AS problems, 1 AS audited
FROM features""",
)
_add(
    "feature_publish",
    "features",
    sql="""
SELECT 'features-20240201T000000Z' AS run_id, 'v2-neighbours' AS feature_version,
       TIMESTAMP '2024-02-01 00:00:00' AS built_at, min(slot_start) AS first_slot,
       max(slot_start) AS last_slot, (SELECT count(*) FROM cells) AS cell_slots,
       count(*) AS labelled_rows, round(avg(target_is_degraded), 9) AS positive_rate,
       'succeeded' AS status
FROM features""",
)
_add(
    "read_features",
    "features",
    sql=f"""
SELECT {FEATURE_COLUMNS}, 'v2-neighbours' AS feature_version,
       'features-20240201T000000Z' AS feature_run_id
FROM features""",
)
_add(
    "feature_run_summary",
    "features",
    sql="""
SELECT min(slot_start) AS first_slot, max(slot_start) AS last_slot, count(*) AS labelled_rows,
       count(DISTINCT h3_cell) AS cells, round(avg(target_is_degraded), 9) AS positive_rate
FROM features""",
)

# --- aggregation ------------------------------------------------------------------------------

_add("cruise_filter", "cruise", sql=f"SELECT {FULL_OBS} FROM cruise")
_add(
    "slot_floor",
    "obs",
    sql="""
SELECT slot_start, count(*) AS reports, min(observed_at) AS first_at, max(observed_at) AS last_at
FROM obs GROUP BY slot_start""",
)
_add(
    "assign_cells",
    "located",
    sql="""
SELECT observed_at, hex, sample_point, round(lat, 9) AS lat, round(lon, 9) AS lon, h3_cell,
       slot_start
FROM located""",
)


def _first_known(column: str) -> str:
    value = f"arg_min({column}, row(nic, observed_at, {column})) FILTER (WHERE {column} IS NOT NULL)"
    if column in {"lat", "lon"}:
        value = f"round({value}, 9)"
    return f"{value} AS {column}"


_add(
    "worst_nic_dedup",
    "located",
    sql=f"""
SELECT h3_cell, slot_start, hex, min(nic) AS nic,
       {", ".join(_first_known(c) for c in (
           "observed_at", "lat", "lon", "altitude_ft", "nac_p", "sil", "aircraft_type",
           "sample_point", "is_control_region", "ingest_run_id"))}
FROM located GROUP BY h3_cell, slot_start, hex""",
)
_add("worst_nic", "worst", sql="SELECT h3_cell, slot_start, hex, nic, nac_p FROM worst")
_add("cell_hourly", "cells", sql=f"SELECT {CELL_COLUMNS} FROM cells")
_add(
    "read_cell_hourly",
    "cells",
    sql=f"""
SELECT {CELL_COLUMNS} FROM cells WHERE slot_start BETWEEN {READ_FROM} AND {READ_TO}""",
)
_add(
    "collapse_runs",
    "cells",
    also={
        "high": "SELECT * FROM obs WHERE altitude_ft >= 24000",
        **_cells_from("high", _SIDE_2, "'2'"),
        "two_floors": f"""
  SELECT h3_cell, slot_start, aircraft_count, degraded_share, median_nic, p25_nic, mean_nac_p,
         is_degraded FROM cells
  UNION ALL
  SELECT h3_cell, slot_start, aircraft_count, degraded_share, median_nic, p25_nic, mean_nac_p,
         is_degraded FROM made_cells""",
    },
    sql="""
SELECT h3_cell, slot_start, max(aircraft_count) AS aircraft_count,
       round(avg(degraded_share), 9) AS degraded_share, round(median(median_nic), 9) AS median_nic,
       round(min(p25_nic), 9) AS p25_nic, round(avg(mean_nac_p), 9) AS mean_nac_p,
       max(is_degraded) AS is_degraded
FROM two_floors GROUP BY h3_cell, slot_start""",
)

# --- features ---------------------------------------------------------------------------------

_add(
    "regular_grid",
    "cells",
    sql="""
SELECT k.h3_cell, s.slot_start, c.aircraft_count, round(c.degraded_share, 9) AS degraded_share,
       round(c.median_nic, 9) AS median_nic, round(c.p25_nic, 9) AS p25_nic,
       round(c.mean_nac_p, 9) AS mean_nac_p, c.is_degraded
FROM (SELECT DISTINCT h3_cell FROM cells) k
CROSS JOIN (SELECT unnest(generate_series(min(slot_start), max(slot_start), INTERVAL 1 HOUR))
              AS slot_start FROM cells) s
LEFT JOIN cells c ON c.h3_cell = k.h3_cell AND c.slot_start = s.slot_start""",
)
_add("cell_neighbours", "pairs", sql="SELECT h3_cell, nbr_cell FROM pairs")
_add(
    "neighbour_state",
    "nbr",
    sql="""
SELECT h3_cell, slot_start, nbr_observed,
       round(nbr_degraded_share_mean, 9) AS nbr_degraded_share_mean,
       round(nbr_degraded_share_max, 9) AS nbr_degraded_share_max, nbr_degraded_count
FROM nbr""",
)
_add("neighbour_lags", "nbr_lagged", sql=f"SELECT h3_cell, slot_start, {NBR_COLUMNS} FROM nbr_lagged")
_add("temporal_lags", "lagged", sql=f"SELECT {CELL_COLUMNS}, {LAG_COLUMNS} FROM lagged")
_add("trailing_means", "trailed", sql=f"SELECT h3_cell, slot_start, {TRAIL_COLUMNS} FROM trailed")
_add(
    "target_ahead",
    "cells",
    sql="""
SELECT c.h3_cell, c.slot_start, c.is_degraded, f.is_degraded AS target_is_degraded
FROM cells c LEFT JOIN cells f ON f.h3_cell = c.h3_cell AND f.h = c.h + 6""",
)
for _name in ("build_features", "build_incremental", "export_features"):
    _add(_name, "features", sql=f"SELECT {FEATURE_COLUMNS} FROM features")
_add("score_rows", "scorable", sql=f"SELECT {SCORE_COLUMNS} FROM scorable")
_add(
    "model_matrix",
    "features",
    sql=f"SELECT {SCORE_COLUMNS.replace('h3_cell, slot_start, ', '', 1)} FROM features",
)
_add(
    "thin_neighbours",
    "all_cells",
    also={
        "all_pairs": """
  SELECT c.h3_cell, c.slot_start, split_part(c.h3_cell, '_', 1) || '_' ||
         (CAST(split_part(c.h3_cell, '_', 2) AS INT) + d.dq) || '_' ||
         (CAST(split_part(c.h3_cell, '_', 3) AS INT) + d.dr) AS nbr_cell
  FROM all_cells c,
       (VALUES (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1)) AS d(dq, dr)
  WHERE c.aircraft_count >= 5"""
    },
    sql="""
SELECT p.h3_cell, p.slot_start, count(n.h3_cell) AS nbr_thin_count
FROM all_pairs p LEFT JOIN all_cells n
  ON n.h3_cell = p.nbr_cell AND n.slot_start = p.slot_start AND n.aircraft_count < 5
GROUP BY p.h3_cell, p.slot_start""",
)

_SHARE_COLUMNS = [
    "degraded_share",
    *[f"degraded_share_lag_{k}h" for k in R.lag_hours],
    "degraded_share_mean_6h",
    "degraded_share_mean_24h",
    "nbr_degraded_share_mean",
    "nbr_degraded_share_max",
    "nbr_degraded_share_mean_lag_1h",
    "nbr_degraded_share_mean_lag_3h",
    "nbr_degraded_share_mean_lag_6h",
]


def _gate_sql(table: str) -> str:
    rules = [
        ("unique keys", "count(*) - count(DISTINCT (h3_cell, slot_start))",
         "duplicate (h3_cell, slot_start) keys"),
        ("target is not binary", "count(*) FILTER (WHERE target_is_degraded NOT IN (0, 1))", None),
        *[
            (f"{c} outside [0, 1]", f"count(*) FILTER (WHERE {c} < 0 OR {c} > 1)", None)
            for c in _SHARE_COLUMNS
        ],
        ("current-slot degraded_share missing on a training row",
         "count(*) FILTER (WHERE degraded_share IS NULL)", None),
        ("row below the traffic floor", "count(*) FILTER (WHERE aircraft_count < 5)", None),
    ]
    parts = [
        f"SELECT '{name}' AS \"check\", n AS violations, "
        f"CASE WHEN n > 0 THEN '{message or name}' END AS problem "
        f"FROM (SELECT {count} AS n FROM {table})"
        for name, count, message in rules
    ]
    parts.append(
        f"""SELECT 'positive rate' AS "check", CASE WHEN r BETWEEN 0.005 AND 0.5 THEN 0 ELSE 1 END
         AS violations,
       CASE WHEN NOT r BETWEEN 0.005 AND 0.5
            THEN 'positive rate ' || printf('%.3f', r) || ' outside the plausible 0.5-50% band' END
         AS problem
FROM (SELECT avg(target_is_degraded) AS r FROM {table})"""
    )
    return "\nUNION ALL\n".join(parts)


_add("validate_features", "features", sql=_gate_sql("features"))
_add(
    "validate_damaged",
    "features",
    also={
        "damaged": """
  SELECT * REPLACE (
           CASE WHEN hour_utc = 3 THEN 2 ELSE target_is_degraded END AS target_is_degraded,
           degraded_share_lag_1h + CASE WHEN hour_utc = 4 THEN 1.5 ELSE 0 END
             AS degraded_share_lag_1h,
           CASE WHEN hour_utc = 5 THEN NULL ELSE degraded_share END AS degraded_share,
           CASE WHEN hour_utc = 6 THEN 4 ELSE aircraft_count END AS aircraft_count)
  FROM features
  UNION ALL
  SELECT * FROM features WHERE hour_utc = 7"""
    },
    sql=_gate_sql("damaged"),
)

# --- discs and regions ------------------------------------------------------------------------

_POINTS = "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', {lat}::DOUBLE, {lon}::DOUBLE, {str(c).lower()})" for n, lat, lon, c in POINTS
) + ") AS p(disc, disc_lat, disc_lon, control)"
_DISTANCE = f"""2 * {grid.EARTH_RADIUS_KM}::DOUBLE / {grid.NAUTICAL_MILE_KM} * asin(sqrt(least(1.0,
           sin(radians(lat - disc_lat) / 2) ** 2 + cos(radians(disc_lat)) * cos(radians(lat))
           * sin(radians(lon - disc_lon) / 2) ** 2)))"""
_COVERED = f"""
  SELECT * FROM (SELECT obs.*, points.*, {_DISTANCE} AS distance_nm FROM obs, points)
  WHERE distance_nm <= 250"""
_add(
    "disc_membership",
    "obs",
    also={"points": _POINTS, "covered": _COVERED},
    sql="""
SELECT disc, control, count(*) AS reports, round(min(distance_nm), 9) AS nearest_nm,
       round(max(distance_nm), 9) AS farthest_nm
FROM covered GROUP BY disc, control""",
)
_add(
    "active_points",
    "obs",
    also={"points": _POINTS, "covered": _COVERED},
    sql="""
SELECT disc, count(*) AS reports, count(DISTINCT hex) AS aircraft
FROM covered WHERE NOT control GROUP BY disc""",
)
_add(
    "region_rollup",
    "obs",
    sql="""
SELECT sample_point, CAST(substr(sample_point, 2) AS INT) % 3 = 0 AS control,
       count(*) AS reports,
       round(avg(CASE WHEN nic < 7 THEN 1.0::DOUBLE ELSE 0 END), 9) AS degraded_share,
       count(*) FILTER (WHERE altitude_ft >= 20000) AS cruise_reports,
       round(avg(CASE WHEN nic < 7 THEN 1.0::DOUBLE ELSE 0 END)
         FILTER (WHERE altitude_ft >= 20000), 9) AS cruise_degraded_share
FROM obs GROUP BY sample_point""",
)

# --- monitoring -------------------------------------------------------------------------------

_add("slot_coverage", "coverage", sql="SELECT * FROM coverage")
_add(
    "history_stats",
    "obs",
    sql="""
SELECT count(*) AS observations, count(DISTINCT slot_start) AS slots_covered,
       max(slot_start) AS latest_slot
FROM obs""",
)
_add(
    "capture_lag",
    "obs",
    sql="""
SELECT max(slot_start) AS latest_slot, round(200 / 60.0::DOUBLE, 9) AS lag_hours FROM obs""",
)
_add(
    "capture_watchdog",
    "obs",
    sql="""
SELECT max(slot_start) AS latest_slot, round(200 / 60.0::DOUBLE, 9) AS lag_hours,
       false AS healthy,
       'newest captured hour is 3.3 h old: capture is behind' AS problem
FROM obs""",
)
_add(
    "gap_report",
    "coverage",
    sql="""
SELECT CAST(slot_start AS DATE) AS date, count(*) AS missing_hours,
       string_agg(strftime(slot_start, '%H'), ',' ORDER BY slot_start) AS hours
FROM coverage WHERE observations = 0 GROUP BY 1""",
)
_add(
    "completeness",
    "coverage",
    sql="""
SELECT count(*) FILTER (WHERE observations > 0) AS observed_hours, count(*) AS expected_hours,
       round(avg(CASE WHEN observations > 0 THEN 1.0::DOUBLE ELSE 0 END), 9) AS completeness
FROM coverage""",
)
_add(
    "sweep_status",
    "ev",
    also={
        "polled": """
  SELECT h.eh, p.seq < CASE h.eh % 41 WHEN 3 THEN 7 WHEN 4 THEN 0 ELSE 12 END AS reached, p.seq,
         e.site IS NOT NULL AND h.eh % 37 NOT IN (5, 6) AS answered, reached AND answered AS ok
  FROM (SELECT DISTINCT eh FROM ev) h CROSS JOIN range(12) AS p(seq)
  LEFT JOIN (SELECT DISTINCT eh, site FROM ev) e ON e.eh = h.eh AND e.site = p.seq"""
    },
    sql="""
SELECT run_id, slot_start, points_attempted, points_succeeded, error,
       CASE WHEN points_succeeded = 0 THEN 'failed'
            WHEN points_succeeded < points_attempted THEN 'partial' ELSE 'ok' END AS status
FROM (SELECT 'run-' || eh AS run_id, make_timestamp(eh * 3600 * 1000000) AS slot_start,
             count(*) AS points_attempted, count(*) FILTER (WHERE ok) AS points_succeeded,
             'no answer from p' || (min(seq) FILTER (WHERE reached AND NOT ok)) AS error
      FROM polled GROUP BY eh)""",
)
_add(
    "sweep_status_broken",
    "ev",
    also={
        "unread": _BROKEN,
        "polled": """
  SELECT h.eh, p.seq < CASE h.eh % 41 WHEN 3 THEN 7 WHEN 4 THEN 0 ELSE 12 END AS reached, p.seq,
         e.site IS NOT NULL AND h.eh % 37 NOT IN (5, 6) AS answered,
         reached AND answered AND u.broken IS NULL AS ok,
         CASE WHEN answered THEN 'answer of p' || p.seq || ' could not be read'
              ELSE 'no answer from p' || p.seq END AS note
  FROM (SELECT DISTINCT eh FROM ev) h CROSS JOIN range(12) AS p(seq)
  LEFT JOIN (SELECT DISTINCT eh, site FROM ev) e ON e.eh = h.eh AND e.site = p.seq
  LEFT JOIN unread u ON u.eh = h.eh AND u.site = p.seq"""
    },
    sql="""
SELECT run_id, slot_start, points_attempted, points_succeeded, error,
       CASE WHEN points_succeeded = 0 THEN 'failed'
            WHEN points_succeeded < points_attempted THEN 'partial' ELSE 'ok' END AS status
FROM (SELECT 'run-' || eh AS run_id, make_timestamp(eh * 3600 * 1000000) AS slot_start,
             count(*) AS points_attempted, count(*) FILTER (WHERE ok) AS points_succeeded,
             arg_min(note, seq) FILTER (WHERE reached AND NOT ok) AS error
      FROM polled GROUP BY eh)""",
)
_add(
    "close_stale_runs",
    "runs",
    sql=f"""
SELECT * EXCLUDE (stale) REPLACE (
         CASE WHEN stale THEN started_at + INTERVAL 20 MINUTE ELSE finished_at END AS finished_at,
         CASE WHEN stale THEN coalesce(error, '{ABANDONED_NOTE}') ELSE error END AS error,
         CASE WHEN stale THEN 'abandoned' ELSE status END AS status)
FROM (SELECT *, status = 'running'
               AND started_at < (SELECT max(slot_start) FROM runs) + INTERVAL 140 MINUTE AS stale
      FROM runs)""",
)
_add(
    "recent_runs",
    "runs",
    sql="SELECT * FROM runs ORDER BY slot_start DESC, run_id DESC LIMIT 200",
)
_add(
    "runs_by_status",
    "runs",
    sql="""
SELECT CAST(slot_start AS DATE) AS date, status, count(*) AS runs,
       CAST(sum(points_attempted) AS BIGINT) AS requests,
       CAST(sum(points_succeeded) AS BIGINT) AS answered,
       CAST(sum(aircraft_written) AS BIGINT) AS aircraft_written
FROM runs GROUP BY 1, 2""",
)
EDGES = """
  SELECT *, lag(slot_start) OVER (ORDER BY slot_start, run_id) AS before
  FROM (SELECT *, lag(healthy, 1, true) OVER (ORDER BY slot_start, run_id) AS was
        FROM (SELECT *, status = 'ok' AS healthy FROM runs WHERE status <> 'running'))
  WHERE healthy <> was"""
_EDGE_ROWS = """
SELECT slot_start, run_id, CASE WHEN healthy THEN 'recovered' ELSE 'degraded' END AS transition,
       CASE WHEN healthy THEN 'default' WHEN points_succeeded = 0 THEN 'urgent' ELSE 'high' END
         AS priority,
       CASE WHEN healthy THEN before ELSE slot_start END AS degraded_since,
       'Slot ' || strftime(slot_start, '%Y-%m-%d %H:%M') || ' UTC: ' || points_succeeded || '/'
         || points_attempted || ' discs OK' ||
         CASE WHEN healthy THEN ' again (degraded since ' || strftime(before, '%Y-%m-%d %H:%M')
                                || ' UTC).'
              ELSE '.' || coalesce(' Error: ' || error, '') END AS body
FROM edges"""
_add("health_transitions", "runs", also={"edges": EDGES}, sql=_EDGE_ROWS)

# --- analyses ---------------------------------------------------------------------------------

SPLIT = """
  SELECT f.*, CASE WHEN f.h > c.second THEN 'test'
                   WHEN f.h > c.first AND f.h + 6 <= c.second THEN 'validation'
                   WHEN f.h + 6 <= c.first THEN 'train' ELSE 'gap' END AS segment
  FROM (SELECT *, CAST(epoch(slot_start) / 3600 AS BIGINT) AS h FROM features) f,
       (SELECT max(h) FILTER (WHERE rn = (n * 70 + 99) // 100) AS first,
               max(h) FILTER (WHERE rn = (n * 85 + 99) // 100) AS second
        FROM (SELECT h, row_number() OVER (ORDER BY h) AS rn, count(*) OVER () AS n
              FROM (SELECT DISTINCT CAST(epoch(slot_start) / 3600 AS BIGINT) AS h
                    FROM features))) c"""
CLIMATOLOGY = """
  SELECT s.*, coalesce(
           (SELECT avg(t.target_is_degraded) FROM split t WHERE t.segment = 'train'
              AND t.h3_cell = s.h3_cell AND t.hour_utc = s.hour_utc),
           (SELECT avg(t.target_is_degraded) FROM split t WHERE t.segment = 'train'
              AND t.h3_cell = s.h3_cell),
           (SELECT avg(t.target_is_degraded) FROM split t WHERE t.segment = 'train')) AS score
  FROM split s"""
_CLIMATE = {"split": SPLIT, "climate": CLIMATOLOGY}


def _precision_sql(table: str) -> str:
    return f"""
SELECT CAST(sum(n) AS BIGINT) AS scored_rows, CAST(sum(pos) AS BIGINT) AS positives,
       round(sum(pos * cum_pos / cum_n::DOUBLE) / sum(pos), 9) AS average_precision
FROM (SELECT n, pos, sum(pos) OVER (ORDER BY score DESC) AS cum_pos,
             sum(n) OVER (ORDER BY score DESC) AS cum_n
      FROM (SELECT round(score, 12) AS score, count(*) AS n, sum(target_is_degraded) AS pos
            FROM {table} GROUP BY 1))"""


_add(
    "chrono_split",
    "features",
    also={"split": SPLIT},
    sql="SELECT h3_cell, slot_start, target_is_degraded, segment FROM split",
)
_add(
    "persistence",
    "features",
    sql="""
SELECT h3_cell, slot_start, is_degraded, CAST(is_degraded AS DOUBLE) AS score, target_is_degraded
FROM features""",
)
_add(
    "climatology",
    "features",
    also=_CLIMATE,
    sql="""
SELECT h3_cell, slot_start, segment, target_is_degraded, round(score, 9) AS score FROM climate""",
)
_add("average_precision", "features", also=_CLIMATE, sql=_precision_sql("climate"))
_add(
    "onset_average_precision",
    "features",
    also={
        "clean": """
  SELECT coalesce(nbr_degraded_share_max, 0) AS score, target_is_degraded
  FROM features WHERE is_degraded = 0"""
    },
    sql=_precision_sql("clean"),
)
_add(
    "brier",
    "features",
    also=_CLIMATE,
    sql="""
SELECT count(*) AS scored_rows, round(avg((score - target_is_degraded) ** 2), 9) AS brier
FROM climate""",
)
_add(
    "region_metrics",
    "features",
    also={
        "regions": """
  SELECT h3_cell, CASE WHEN avg(CASE WHEN is_control_region THEN 1.0::DOUBLE ELSE 0 END) >= 0.5
                       THEN 'control' ELSE 'interference' END AS region
  FROM located GROUP BY h3_cell""",
        "judged": """
  SELECT region, s.subset, coalesce(nbr_degraded_share_max >= 0.3::DOUBLE, false) AS said,
         target_is_degraded = 1 AS was
  FROM features JOIN regions USING (h3_cell), (VALUES ('all'), ('transitions')) AS s(subset)
  WHERE s.subset = 'all' OR is_degraded <> target_is_degraded""",
    },
    sql="""
SELECT *, round(hits / nullif(hits + false_alarms, 0)::DOUBLE, 9) AS precision,
       round(hits / nullif(hits + misses, 0)::DOUBLE, 9) AS recall
FROM (SELECT region, subset, count(*) AS rows, count(*) FILTER (WHERE said AND was) AS hits,
             count(*) FILTER (WHERE said AND NOT was) AS false_alarms,
             count(*) FILTER (WHERE NOT said AND was) AS misses
      FROM judged GROUP BY region, subset)""",
)
_add(
    "transition_rates",
    "features",
    sql="""
SELECT *, round(transitions / rows::DOUBLE, 9) AS transition_rate,
       round(onsets / nullif(clean_rows, 0)::DOUBLE, 9) AS onset_rate,
       round(onsets_near / nullif(clean_rows_near, 0)::DOUBLE, 9) AS onset_rate_near
FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE is_degraded <> target_is_degraded)
               AS transitions,
             count(*) FILTER (WHERE is_degraded = 0 AND target_is_degraded = 1) AS onsets,
             count(*) FILTER (WHERE is_degraded = 0) AS clean_rows,
             count(*) FILTER (WHERE is_degraded = 0 AND nbr_degraded_count >= 1)
               AS clean_rows_near,
             count(*) FILTER (WHERE is_degraded = 0 AND nbr_degraded_count >= 1
                              AND target_is_degraded = 1) AS onsets_near
      FROM features)""",
)
DISC_HOURS = """
  SELECT s.sample_point, c.aircraft_count < 5 AS dropped, c.is_degraded
  FROM (SELECT DISTINCT sample_point, h3_cell, slot_start FROM located) s
  JOIN all_cells c USING (h3_cell, slot_start)"""
DISC_AUDIT = """
  SELECT sample_point, count(*) AS cell_hours, count(*) FILTER (WHERE dropped) AS dropped,
         avg(CASE WHEN dropped THEN 1.0::DOUBLE ELSE 0 END) AS drop_rate,
         avg(is_degraded) AS degraded_rate,
         avg(is_degraded) FILTER (WHERE dropped) AS dropped_degraded_rate,
         avg(is_degraded) FILTER (WHERE NOT dropped) AS kept_degraded_rate
  FROM disc_hours GROUP BY sample_point"""
_add(
    "floor_audit",
    "all_cells",
    also={"disc_hours": DISC_HOURS, "audit": DISC_AUDIT},
    sql="""
SELECT sample_point, cell_hours, dropped, round(drop_rate, 9) AS drop_rate,
       round(degraded_rate, 9) AS degraded_rate,
       round(dropped_degraded_rate, 9) AS dropped_degraded_rate,
       round(kept_degraded_rate, 9) AS kept_degraded_rate
FROM audit""",
)
CELL_AUDIT = """
  SELECT h3_cell, avg(CASE WHEN aircraft_count < 5 THEN 1.0::DOUBLE ELSE 0 END) AS drop_rate,
         avg(is_degraded) AS degraded_rate
  FROM all_cells GROUP BY h3_cell"""


def _correlation_sql(level: str, table: str) -> str:
    return f"""
SELECT '{level}' AS level, count(*) AS pairs, round(corr(x, y), 9) AS pearson,
       round(corr(rx, ry), 9) AS spearman
FROM (SELECT x, y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
      FROM (SELECT drop_rate AS x, degraded_rate AS y FROM {table}))"""


_add(
    "floor_correlation",
    "all_cells",
    also={"disc_hours": DISC_HOURS, "audit": DISC_AUDIT, "cell_audit": CELL_AUDIT},
    sql=_correlation_sql("disc", "audit") + "\nUNION ALL\n" + _correlation_sql("cell", "cell_audit"),
)
SWEEP_STEPS = "SELECT cruise.*, s.* FROM cruise, (VALUES " + ", ".join(
    f"({r}, {grid.side_km(r)!r}::DOUBLE)" for r in (1, 2, 3, 4)
) + ") AS s(resolution, side_km)"
_add(
    "resolution_sweep",
    "cruise",
    also={
        "stepped": SWEEP_STEPS,
        "binned": located("stepped", "side_km", "resolution"),
        "sweep_hours": """
  SELECT resolution, side_km, h3_cell, slot_start, count(*) AS n,
         avg(CASE WHEN nic < 7 THEN 1.0::DOUBLE ELSE 0 END) AS share
  FROM (SELECT resolution, side_km, h3_cell, slot_start, hex, min(nic) AS nic
        FROM binned GROUP BY ALL)
  GROUP BY resolution, side_km, h3_cell, slot_start""",
    },
    sql="""
SELECT resolution, round(side_km, 9) AS side_km, count(DISTINCT h3_cell) AS cells,
       count(*) AS cell_hours, count(*) FILTER (WHERE n >= 5) AS usable_cell_hours,
       round(median(n), 9) AS median_aircraft,
       count(*) FILTER (WHERE n >= 5 AND share >= 0.3::DOUBLE) AS degraded_cell_hours
FROM sweep_hours GROUP BY resolution, side_km""",
)
_add(
    "lag_availability",
    "features",
    sql="\nUNION ALL\n".join(
        f"SELECT {k} AS lag_hours, round(avg(CASE WHEN degraded_share_lag_{k}h IS NOT NULL "
        f"THEN 1.0::DOUBLE ELSE 0 END), 9) AS available FROM features"
        for k in R.lag_hours
    ),
)
_FEATURE_NAMES = [
    "aircraft_count", "degraded_share", "median_nic", "p25_nic", "mean_nac_p", "is_degraded",
    *[f"{c}_lag_{k}h" for k in R.lag_hours for c in ("degraded_share", "is_degraded")],
    "degraded_share_mean_6h", "degraded_share_mean_24h", "aircraft_count_mean_24h",
    "nbr_observed", "nbr_degraded_share_mean", "nbr_degraded_share_max", "nbr_degraded_count",
    "nbr_degraded_share_mean_lag_1h", "nbr_degraded_share_mean_lag_3h",
    "nbr_degraded_share_mean_lag_6h", "nbr_degraded_share_delta_3h", "hour_utc", "day_of_week",
]
_LONG = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, segment = 'test' AS late "
    f"FROM split WHERE segment IN ('train', 'test')"
    for c in _FEATURE_NAMES
)
_add(
    "psi_drift",
    "features",
    also={
        "split": SPLIT,
        "long": _LONG,
        "cuts": """
  SELECT feature, list_distinct(list_transform([1, 2, 3, 4, 5, 6, 7, 8, 9],
           lambda d: vals[CAST(greatest(1, ceil(len(vals) * d / 10.0)) AS BIGINT)])) AS edges
  FROM (SELECT feature, list(value ORDER BY value) AS vals
        FROM long WHERE NOT late AND value IS NOT NULL GROUP BY feature)""",
        "binned": """
  SELECT long.feature, late, CASE WHEN value IS NULL THEN -1
           ELSE len(list_filter(edges, lambda e: e < value)) END AS bin
  FROM long JOIN cuts USING (feature)""",
        "shares": """
  SELECT feature, bin,
         greatest(1e-6, count(*) FILTER (WHERE NOT late)
           / (sum(count(*) FILTER (WHERE NOT late)) OVER (PARTITION BY feature))::DOUBLE) AS p,
         greatest(1e-6, count(*) FILTER (WHERE late)
           / (sum(count(*) FILTER (WHERE late)) OVER (PARTITION BY feature))::DOUBLE) AS q
  FROM binned GROUP BY feature, bin""",
    },
    sql="""
SELECT feature, count(*) AS bins, round(sum((p - q) * ln(p / q)), 9) AS psi
FROM shares GROUP BY feature""",
)
_add(
    "lagged_accuracy",
    "cells",
    sql="""
SELECT CAST(f.slot_start AS DATE) AS date, count(*) AS scored_rows,
       round(avg(CASE WHEN c.is_degraded = f.is_degraded THEN 1.0::DOUBLE ELSE 0 END), 9)
         AS accuracy,
       round(avg((c.is_degraded - f.is_degraded) ** 2), 9) AS brier
FROM cells c JOIN cells f ON f.h3_cell = c.h3_cell AND f.h = c.h + 6 GROUP BY 1""",
)
_add(
    "class_weights",
    "features",
    sql="""
SELECT h3_cell, slot_start, target_is_degraded,
       round(count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY target_is_degraded)), 9)
         AS weight
FROM features""",
)

# --- streaming --------------------------------------------------------------------------------

for _name in ("stream_capture", "stream_capture_late"):
    _add(_name, "fan", also=_FEED, sql=f"SELECT {FULL_OBS} FROM feed_reports")
_add("stream_health", "runs", also={"edges": EDGES}, sql=_EDGE_ROWS)
for _name in ("stream_cell_hourly", "stream_cells_repaired"):
    _add(
        _name,
        "cells",
        sql=f"""
SELECT {CELL_COLUMNS} FROM cells
WHERE slot_start + INTERVAL 1 HOUR <= (SELECT max(observed_at) FROM cruise) - INTERVAL 20 MINUTE""",
    )
