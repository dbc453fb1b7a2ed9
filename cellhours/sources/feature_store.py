"""Versioned feature table with an audit row per build.

A build is written to a folder of its own. Only the audit row, appended last, makes it visible:
readers take the newest succeeded build, so they never see a half-written table, and a build
that fails leaves the one before in place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.timeslots import utc_date
from cellhours.schemas import CELL, CELL_HOURS, FEATURE_RUNS, SLOT, TARGET
from cellhours.sources.commits import children, remove
from cellhours.sources.scratch import path_missing

MONTH, DAY = "slot_month", "slot_date"
MONTHS, DAYS = "features", "cells"  # kinds of parts in a manifest
MANIFEST = (
    "kind string, part string, folder string, rows bigint, positives double, "
    "first_slot timestamp, last_slot timestamp, raw_version bigint, feature_version string"
)


def _month(ts: str | Column) -> Column:
    return F.trunc(utc_date(ts), "month")


def build_path(root: str, run_id: str) -> str:
    return f"{root}/cell_hourly_features/{run_id}"


def runs_path(root: str) -> str:
    return f"{root}/feature_runs"


def stage_features(
    features: DataFrame, root: str, run_id: str, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Write a build where no reader looks yet, and return it as stored.

    A run id is used once: if its folder exists, published or not, the write is refused.

    Files are laid out by month and sorted by slot, so a read of a time range skips folders,
    row groups and pages. Rebalancing needs no sampling pass over the features and splits a
    month that holds most of them.
    """
    path = build_path(root, run_id)
    tagged = features.withColumns(
        {
            "feature_version": F.lit(rules.feature_version),
            "feature_run_id": F.lit(run_id),
            MONTH: _month(SLOT),
        }
    )
    balanced = tagged.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, SLOT, CELL)
    balanced.write.mode("errorifexists").partitionBy(MONTH).parquet(path)
    return features.sparkSession.read.schema(tagged.schema).parquet(path).drop(MONTH)


def feature_run_summary(features: DataFrame) -> DataFrame:
    """First and last slot, rows, cells and positive rate; NULLs for an empty table."""
    return features.agg(
        F.min(SLOT).alias("first_slot"),
        F.max(SLOT).alias("last_slot"),
        F.count(F.lit(1)).alias("labelled_rows"),
        F.count_distinct(CELL).alias("cells"),
        F.avg(F.col(TARGET).cast("double")).alias("positive_rate"),
    )


def commit_features(
    staged: DataFrame,
    root: str,
    run_id: str,
    cell_slots: int,
    built_at: datetime,
    rules: Rules = DEFAULT_RULES,
) -> None:
    """Append the audit row that publishes a staged build."""
    row = feature_run_summary(staged).withColumns(
        {
            "run_id": F.lit(run_id),
            "feature_version": F.lit(rules.feature_version),
            "built_at": F.lit(built_at),
            "cell_slots": F.lit(cell_slots),
            "status": F.lit("succeeded"),
        }
    )
    row.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURE_RUNS.fields]
    ).write.mode("append").parquet(runs_path(root))


def write_features(
    features: DataFrame,
    root: str,
    run_id: str,
    cell_slots: int,
    built_at: datetime,
    rules: Rules = DEFAULT_RULES,
) -> None:
    """Stage and publish in one go, for a table that needs no gate."""
    staged = stage_features(features, root, run_id, rules)
    commit_features(staged, root, run_id, cell_slots, built_at, rules)


def feature_runs(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(FEATURE_RUNS).parquet(runs_path(root))
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], FEATURE_RUNS)


def newest_run(spark: SparkSession, root: str) -> str | None:
    """Id of the newest published build: one value, whatever the size of the table."""
    row = (
        feature_runs(spark, root)
        .filter(F.col("status") == "succeeded")
        .agg(F.max_by("run_id", F.struct("built_at", "run_id")).alias("run_id"))
        .first()
    )
    return None if row is None else row.run_id


def read_features(
    spark: SparkSession,
    root: str,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """The published feature table, the entry point for training; bounds are inclusive."""
    run_id = newest_run(spark, root)
    if run_id is None:
        raise FileNotFoundError(f"no published feature build under {root}")
    months = {m.part: m.folder for m in manifest(spark, root, run_id) if m.kind == MONTHS}
    if not months:  # a build that has all its months itself
        rows = spark.read.parquet(build_path(root, run_id))
    else:
        rows = read_months(spark, root, months)
    if start is not None:
        rows = rows.filter(F.col(SLOT) >= F.lit(start)).filter(
            F.col(MONTH) >= _month(F.lit(start))
        )
    if end is not None:
        rows = rows.filter(F.col(SLOT) <= F.lit(end)).filter(F.col(MONTH) <= _month(F.lit(end)))
    return rows.drop(MONTH)


def _parts(
    spark: SparkSession, place: Callable[[str], str], column: str, folders: Mapping[str, str]
) -> DataFrame:
    """Partition folders {value: run id} that lie in several runs, as one table."""
    frames = []
    for run_id in sorted(set(folders.values())):
        own = [f"{place(run_id)}/{column}={v}" for v, r in sorted(folders.items()) if r == run_id]
        frames.append(spark.read.option("basePath", place(run_id)).parquet(*own))
    return reduce(DataFrame.unionByName, frames)


def read_months(spark: SparkSession, root: str, months: Mapping[str, str]) -> DataFrame:
    return _parts(spark, partial(build_path, root), MONTH, months)


def cells_path(root: str, run_id: str) -> str:
    return f"{root}/cell_hours/{run_id}"


def read_cell_days(spark: SparkSession, root: str, days: Mapping[str, str]) -> DataFrame:
    """Stored cell hours of the dates {date: run id}."""
    if not days:
        return spark.createDataFrame([], CELL_HOURS)
    return _parts(spark, partial(cells_path, root), DAY, days).drop(DAY)


def manifest(spark: SparkSession, root: str, run_id: str) -> list[Row]:
    """What an incremental build consists of: a row per date of cell hours and month of features.

    Empty for a build that was made in one go.
    """
    path = f"{root}/feature_manifests/{run_id}"
    if not children(spark, path):
        return []
    return spark.read.schema(MANIFEST).parquet(path).orderBy("kind", "part").collect()


def write_manifest(spark: SparkSession, root: str, run_id: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").parquet(
        f"{root}/feature_manifests/{run_id}"
    )


def drop_unreferenced(spark: SparkSession, root: str, keep: int = 24) -> list[str]:
    """Delete the folders that none of the newest `keep` published builds needs; their paths.

    Not for the time in which a build runs: what it has staged is not published yet.
    """
    published = feature_runs(spark, root).filter(F.col("status") == "succeeded")
    newest = published.orderBy(F.desc("built_at"), F.desc("run_id")).limit(keep).collect()
    needed = {MONTHS: {r.run_id for r in newest}, DAYS: set(), "manifest": {r.run_id for r in newest}}
    for run in newest:
        for row in manifest(spark, root, run.run_id):
            needed[row.kind].add(row.folder)
    gone = []
    for kind, folder in (
        (MONTHS, "cell_hourly_features"), (DAYS, "cell_hours"), ("manifest", "feature_manifests")
    ):
        for run_id in children(spark, f"{root}/{folder}"):
            if run_id not in needed[kind]:
                remove(spark, f"{root}/{folder}/{run_id}")
                gone.append(f"{root}/{folder}/{run_id}")
    return gone


def export_features(features: DataFrame, path: str) -> None:
    """Plain Parquet copy of a feature table."""
    features.write.mode("overwrite").parquet(path)
