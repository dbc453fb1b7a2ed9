"""Position reports, sweeps and feed answers derived from a generic `events` table.

The table has no aircraft, so each event is read as twelve reports around one of twelve sites,
with plain integer arithmetic. Two rules add the defects the engine has to cope with: hours in
which nothing was captured, and copies of reports seen by a second, overlapping disc.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellhours.functions.timeslots import hour_index_sql, instant_from_utc, slot_floor
from cellhours.schemas import INGEST_RUNS, OBSERVATIONS

# What report `i` of an event looks like, given its `site` and its event hour.
_HEX = "concat('u', user_id, '_', i)"
_SITE_LAT = "50D + (site % 4) * 2.5D"
_SITE_LON = "10D + (site div 4) * 4D"
_LAT = f"{_SITE_LAT} + ((event_id * 31 + i * 7) % 100) / 200D"
_LON = f"{_SITE_LON} + ((event_id * 17 + i * 3) % 100) / 200D"
_FEET = "15000L + ((event_id * 13 + i * 997) % 250) * 100"
_NIC = (
    "if(((event_hour div 8) + site) % 7 = 0 AND (event_id + i) % 3 <> 0, "
    "(event_id + i) % 7, 7 + (event_id + i) % 5)"
)
_NAC_P = "if((event_id * 5 + i) % 13 <> 0, 8 + i % 4, NULL)"
# Hours in which nothing was captured, and sweeps that never recorded their end.
_OUTAGE = "% 37 IN (5, 6)"
_OPEN_RUN = "% 50 = 0"
# Sweeps that their deadline cut after seven discs, and before the first.
_CUT_RUN = "CASE event_hour % 41 WHEN 3 THEN 7 WHEN 4 THEN 0 ELSE 12 END"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "event_type", "ts"
    )
    # Each event fans out twelvefold: the narrow rows are dealt to all tasks before that.
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = events.repartition(max(shuffled, spark.sparkContext.defaultParallelism), "event_id")
    return events.select(
        "event_id", "user_id", "event_type", instant_from_utc("ts").alias("event_at")
    ).selectExpr("*", "event_id % 12 AS site", f"{hour_index_sql('event_at')} AS event_hour")


def _fanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr("*", "explode(sequence(0L, 11L)) AS i")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reports at all altitudes, with capture outages and overlapping discs.

    What two discs hear at the same instant may differ in NACp.
    """
    reports = _fanned(spark, sf_dir).selectExpr(
        "event_id",
        "site",
        "timestamp_micros(unix_micros(event_at) + i * 60000000L) AS observed_at",
        "event_type AS aircraft_type",
        f"{_HEX} AS hex",
        f"{_LAT} AS lat",
        f"{_LON} AS lon",
        f"if((event_id + i) % 11 <> 0, cast({_FEET} AS double), NULL) AS altitude_ft",
        f"{_NIC} AS nic",
        f"{_NAC_P} AS nac_p",
    )
    captured = reports.filter(f"NOT ({hour_index_sql('observed_at')} {_OUTAGE})")
    # Every tenth event is also heard by the next disc.
    heard = captured.selectExpr(
        "*",
        "explode(if(event_id % 10 = 0, array(site, (site + 1) % 12), array(site))) AS disc",
    ).withColumns(
        {
            "slot_start": slot_floor("observed_at"),
            "nac_p": F.expr("if(disc = site, nac_p, nac_p - event_id % 3)"),
        }
    )
    named = heard.selectExpr(
        "*",
        "3 AS sil",
        "concat('p', disc) AS sample_point",
        "disc % 3 = 0 AS is_control_region",
        f"concat('run-', {hour_index_sql('slot_start')}) AS ingest_run_id",
    )
    return named.selectExpr(
        *[f"cast({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in OBSERVATIONS]
    )


def sample_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The discs that occur in the events, as a small dimension table."""
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .selectExpr("event_id % 12 AS site")
        .distinct()
        .selectExpr(
            "concat('p', site) AS name",
            f"{_SITE_LAT} AS lat",
            f"{_SITE_LON} AS lon",
            "250D AS radius_nm",
            "site % 3 = 0 AS control",
        )
    )


def _answers_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per hour with events: which sites had one, as a bit set, and how many reports."""
    return (
        _events(spark, sf_dir)
        .groupBy("event_hour")
        .agg(
            F.expr("bit_or(shiftleft(1, cast(site AS int)))").alias("answered"),
            F.expr("count(1) * 12").alias("reports"),
        )
        .selectExpr(
            "event_hour AS hour",
            f"if(event_hour {_OUTAGE}, 0, answered) AS answered",
            "reports",
            "timestamp_seconds(event_hour * 3600L) AS slot_start",
            "concat('run-', event_hour) AS run_id",
        )
    )


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sweep and disc: did the poll work, and with which error if not.

    A disc without an event in the hour counts as a failed poll; in an outage hour all fail.
    Some sweeps were cut short and have no row for the discs they did not reach.
    """
    return (
        _answers_per_hour(spark, sf_dir)
        .selectExpr("*", "hour AS event_hour", "explode(sequence(0, 11)) AS seq")
        .where(f"seq < {_CUT_RUN}")
        .selectExpr(
            "run_id",
            "slot_start",
            "seq",
            "concat('p', seq) AS sample_point",
            "getbit(answered, seq) = 1 AS ok",
            "if(getbit(answered, seq) = 1, NULL, concat('no answer from p', seq)) AS error",
        )
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit log as written: a `running` record per sweep, then its outcome.

    Every fiftieth sweep never recorded its end. A later record carries a later start, which
    must not win.
    """
    log = _answers_per_hour(spark, sf_dir).selectExpr(
        "*",
        "bit_count(answered) AS discs",
        f"explode(if(hour {_OPEN_RUN}, array(0), array(0, 1))) AS seq",
    )
    columns = {
        "run_id": "run_id",
        "started_at": "slot_start + make_dt_interval(0, 0, seq)",
        "finished_at": "if(seq = 1, slot_start + make_dt_interval(0, 0, 7), NULL)",
        "slot_start": "slot_start",
        "points_attempted": "12",
        "points_succeeded": "if(seq = 1, discs, 0)",
        "aircraft_written": "if(seq = 1 AND discs > 0, reports, 0)",
        "status": (
            "CASE WHEN seq = 0 THEN 'running' WHEN discs = 0 THEN 'failed' "
            "WHEN discs < 12 THEN 'partial' ELSE 'ok' END"
        ),
        "error": "if(seq = 1 AND discs < 12, concat(12 - discs, ' discs silent'), NULL)",
    }
    return log.selectExpr(
        "seq",
        *[
            f"cast({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in INGEST_RUNS
        ],
    )


def snapshots(spark: SparkSession, sf_dir: str, cut_every: int | None = None) -> DataFrame:
    """Feed answers as JSON text, one aircraft per answer, with every altitude spelling.

    The answers of each `cut_every`-th event are cut off before their end.

    Some aircraft lack a position or a NIC. The altitude is a number, "ground", null, absent,
    numeric text, true or a literal 0.
    """
    altitude = (
        "CASE (event_id + i) % 11 "
        "WHEN 0 THEN '\"ground\"' WHEN 1 THEN 'null' "
        f"WHEN 3 THEN concat('\"', {_FEET}, '\"') WHEN 4 THEN 'true' WHEN 5 THEN '0' "
        f"WHEN 6 THEN concat({_FEET}, '.5') ELSE cast({_FEET} AS string) END"
    )
    members = [
        ("lat", _LAT, "(event_id + i) % 17 <> 0"),
        ("lon", _LON, None),
        ("nic", _NIC, "(event_id + i) % 19 <> 0"),
        ("nac_p", "8 + i % 4", "(event_id * 5 + i) % 13 <> 0"),
        ("sil", "3", None),
        ("alt_baro", altitude, "(event_id + i) % 11 <> 2"),
    ]
    texts = []
    for name, value, present in members:
        text = f"concat(', \"{name}\": ', {value})"
        texts.append(f"if({present}, {text}, '')" if present else text)
    body = (
        f"concat('{{\"now\": 1, \"ac\": [{{\"hex\": \"', {_HEX}, '\", \"t\": \"', event_type, '\"', "
        + ", ".join(texts)
        + ", '}]}')"
    )
    if cut_every is not None:
        body = f"if(event_id % {cut_every} = 0, rtrim('}}]', {body}), {body})"
    return _fanned(spark, sf_dir).selectExpr(
        "event_at AS observed_at",
        "concat('p', site) AS sample_point",
        "site % 3 = 0 AS is_control_region",
        "concat('run-', event_hour) AS ingest_run_id",
        f"{body} AS body",
    )
