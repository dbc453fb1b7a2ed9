"""Column names and schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

CELL = "h3_cell"
SLOT = "slot_start"
KEYS = [CELL, SLOT]
LABEL = "is_degraded"
TARGET = "target_is_degraded"
LINEAGE = ["feature_version", "feature_run_id"]
OBSERVATION_KEY = ["slot_start", "hex", "sample_point", "observed_at"]
CELL_VALUES = [
    "aircraft_count",
    "degraded_share",
    "median_nic",
    "p25_nic",
    "mean_nac_p",
    "is_degraded",
]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


OBSERVATIONS = _struct(
    ("observed_at", T.TimestampType()),
    ("slot_start", T.TimestampType()),
    ("hex", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("altitude_ft", T.DoubleType()),
    ("nic", T.ShortType()),
    ("nac_p", T.ShortType()),
    ("sil", T.ShortType()),
    ("aircraft_type", T.StringType()),
    ("sample_point", T.StringType()),
    ("is_control_region", T.BooleanType()),
    ("ingest_run_id", T.StringType()),
)

# `alt_baro` is a number or a word, so it stays a variant until it is parsed.
AIRCRAFT = _struct(
    ("hex", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("nic", T.IntegerType()),
    ("nac_p", T.IntegerType()),
    ("sil", T.IntegerType()),
    ("t", T.StringType()),
    ("alt_baro", T.VariantType()),
)

FEED_BODY = _struct(("now", T.DoubleType()), ("ac", T.ArrayType(AIRCRAFT)))

# One landed poll: the collector's envelope around the feed's answer.
SNAPSHOT = _struct(
    ("observed_at", T.TimestampType()),
    ("sample_point", T.StringType()),
    ("is_control_region", T.BooleanType()),
    ("ingest_run_id", T.StringType()),
    ("body", FEED_BODY),
)

# The same with the answer as it came, for answers that may be broken.
LANDED_TEXT = _struct(
    *[(f.name, f.dataType) for f in SNAPSHOT.fields if f.name != "body"], ("body", T.StringType())
)

INGEST_RUNS = _struct(
    ("run_id", T.StringType()),
    ("started_at", T.TimestampType()),
    ("finished_at", T.TimestampType()),
    ("slot_start", T.TimestampType()),
    ("points_attempted", T.IntegerType()),
    ("points_succeeded", T.IntegerType()),
    ("aircraft_written", T.IntegerType()),
    ("status", T.StringType()),
    ("error", T.StringType()),
)

CELL_HOURS = _struct(
    (CELL, T.StringType()),
    (SLOT, T.TimestampType()),
    ("aircraft_count", T.IntegerType()),
    ("degraded_share", T.DoubleType()),
    ("median_nic", T.DoubleType()),
    ("p25_nic", T.DoubleType()),
    ("mean_nac_p", T.DoubleType()),
    ("is_degraded", T.IntegerType()),
)

FEATURE_RUNS = _struct(
    ("run_id", T.StringType()),
    ("feature_version", T.StringType()),
    ("built_at", T.TimestampType()),
    ("first_slot", T.TimestampType()),
    ("last_slot", T.TimestampType()),
    ("cell_slots", T.LongType()),
    ("labelled_rows", T.LongType()),
    ("positive_rate", T.DoubleType()),
    ("status", T.StringType()),
)

LEGACY_REPORTS = _struct(
    ("observed_at", T.TimestampType()),
    ("hex", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("altitude_ft", T.DoubleType()),
    ("nic", T.ShortType()),
    ("nac_p", T.ShortType()),
    ("sil", T.ShortType()),
    ("aircraft_type", T.StringType()),
    ("sample_point", T.StringType()),
    ("is_control_region", T.BooleanType()),
    ("date", T.DateType()),
)
