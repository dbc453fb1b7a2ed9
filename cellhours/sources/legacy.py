"""Import of the earlier Parquet history (`date=*/` folders, already cruise only)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.timeslots import slot_floor, utc_text
from cellhours.schemas import LEGACY_REPORTS, OBSERVATIONS
from cellhours.sources.observations import append_if_absent, first_per_key, stored_keys
from cellhours.sources.scratch import materialise, path_missing

RUN_PREFIX = "legacy-parquet"


def load_legacy(spark: SparkSession, root: str) -> DataFrame:
    """All partitions as one frame; columns that some files lack are NULL there.

    No partition at all is an empty frame, not an error.
    """
    try:
        return (
            spark.read.option("mergeSchema", "true")
            .option("basePath", root)
            .parquet(f"{root}/date=*/*.parquet")
        )
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], LEGACY_REPORTS)


def reshape_legacy(legacy: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Legacy columns in the shape of the report table.

    The slot is recomputed, unknown NACp and SIL stay NULL, and the run id records the origin.
    """
    if "aircraft_type" not in legacy.columns:
        legacy = legacy.withColumn("aircraft_type", F.lit(None).cast("string"))
    slotted = legacy.withColumn("slot_start", slot_floor("observed_at", rules))
    tagged = slotted.withColumn(
        "ingest_run_id",
        F.concat(F.lit(f"{RUN_PREFIX}-"), utc_text("slot_start", "yyyyMMdd'T'HH")),
    )
    return tagged.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in OBSERVATIONS.fields]
    )


def dedupe_legacy(rows: DataFrame) -> DataFrame:
    """One row per primary key: the one with the worst NIC."""
    return first_per_key(rows, "nic")


def to_observations(legacy: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return dedupe_legacy(reshape_legacy(legacy, rules))


def staged_history(spark: SparkSession, root: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The history as it would be appended, worked out once and stored for the steps after."""
    return materialise(to_observations(load_legacy(spark, root), rules), "history")


def import_summary(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """What an import would do: span of the rows, new ones and those already stored.

    Of a stored table only the dates that the rows span are read.
    """
    stored, same = stored_keys(rows, existing)
    known = F.col("_stored").isNotNull()
    return rows.join(stored.withColumn("_stored", F.lit(True)), same, "left").agg(
        F.count(F.lit(1)).alias("prepared"),
        F.min("slot_start").alias("first_slot"),
        F.max("slot_start").alias("last_slot"),
        F.count_distinct("slot_start").alias("slots"),
        F.count_if(~known).alias("inserted"),
        F.count_if(known).alias("already_present"),
    )


def import_legacy(
    spark: SparkSession, root: str, path: str, dry_run: bool = False, rules: Rules = DEFAULT_RULES
) -> int:
    """Load, reshape and append; running it again adds nothing. Returns the rows added."""
    if dry_run:
        return 0
    history = reshape_legacy(load_legacy(spark, root), rules)
    return append_if_absent(history, path, order=("nic",))  # of a key the worst NIC
