"""Feed answers to report rows, and straight on to cell rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.altitude import altitude_ft
from cellhours.functions.timeslots import slot_floor
from cellhours.operators.cells import aggregate_cells, assign_cells, cruise_filter
from cellhours.schemas import FEED_BODY, OBSERVATIONS, SNAPSHOT

_CORRUPT = "_unread"


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Landed polls: JSON lines, one envelope with the feed's answer per line."""
    return spark.read.schema(SNAPSHOT).json(path)


def parse_bodies(envelopes: DataFrame) -> DataFrame:
    """For envelopes that carry the answer as text: `body` parsed, and whether it is `broken`.

    A text that is no JSON, or of which a value has the wrong type, is a broken answer as a whole:
    its `body` is NULL, so none of its aircraft is taken. Envelopes without an answer are not
    broken, their poll failed before.
    """
    schema = StructType([*FEED_BODY.fields]).add(_CORRUPT, "string")
    parsed = F.from_json("body", schema, {"columnNameOfCorruptRecord": _CORRUPT})
    read = envelopes.withColumn("_text", F.col("body")).withColumn("body", parsed)
    bad = F.col("body").isNull() | F.col(f"body.{_CORRUPT}").isNotNull()
    return (
        read.withColumn("broken", F.col("_text").isNotNull() & bad)
        .withColumn("body", F.when(~F.col("broken"), F.col("body")))
        .drop("_text")
    )


def broken_answers(parsed: DataFrame) -> DataFrame:
    """Answers that could not be read, per sweep and disc: run_id, sample_point, broken."""
    return (
        parsed.filter("broken")
        .groupBy(F.col("ingest_run_id").alias("run_id"), "sample_point")
        .agg(F.count(F.lit(1)).alias("broken"))
    )


def flatten_snapshots(
    envelopes: DataFrame, cruise_only: bool = False, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """One report per aircraft with a position and a NIC, stamped with the poll time.

    NIC 0 is the strongest signal there is, an absent NIC is none: only the latter is dropped.
    Altitude does not matter for storage; the live path asks for ``cruise_only``.
    """
    # The outer form, because the plain one makes the optimizer test the array's size below the
    # generator and parse every body twice. Its NULL rows go with those without a position.
    each = envelopes.select(
        "observed_at",
        "sample_point",
        "is_control_region",
        "ingest_run_id",
        F.inline_outer("body.ac"),
    )
    usable = each.filter(
        F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("nic").isNotNull()
    )
    named = usable.withColumns(
        {
            "slot_start": slot_floor("observed_at", rules),
            "hex": F.coalesce("hex", F.lit("")),  # an aircraft without an address still counts
            "altitude_ft": altitude_ft(F.col("alt_baro")),
            "aircraft_type": F.col("t"),
        }
    )
    rows = named.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in OBSERVATIONS.fields]
    )
    return cruise_filter(rows, rules) if cruise_only else rows


def snapshot_cells(envelopes: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Live path: feed answers to cell rows, through the operators the history uses."""
    reports = flatten_snapshots(envelopes, cruise_only=True, rules=rules)
    return aggregate_cells(assign_cells(reports, rules), rules)
