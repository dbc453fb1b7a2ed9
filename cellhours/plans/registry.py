"""Every operator as a named query over the generic `events` table.

A query takes (spark, sf_dir). Doubles are rounded to nine places, whole numbers are BIGINT and
timestamps come back without a zone (UTC), so results compare with other engines.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import UTC, datetime, timedelta
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellhours.config import DEFAULT_RULES
from cellhours.functions.altitude import altitude_ft
from cellhours.functions.timeslots import plus_minutes, utc_date
from cellhours.operators import (
    analysis,
    cells,
    coverage,
    discs,
    evaluation,
    features,
    health,
    quality,
)
from cellhours.plans.build import run_feature_build
from cellhours.plans.incremental import run_incremental_build
from cellhours.schemas import CELL, CELL_VALUES, KEYS, LABEL, LINEAGE, SLOT, TARGET
from cellhours.session import apply_settings
from cellhours.sources import events_view, feature_store, legacy, points, runs, snapshots
from cellhours.sources import observations as store
from cellhours.sources.scratch import materialise, run_folder
from cellhours.streaming import capture, health as health_stream
from cellhours.streaming import cells as cell_stream
from cellhours.streaming import reopened

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

READ_FROM = datetime(2024, 1, 5, tzinfo=UTC)
READ_TO = datetime(2024, 1, 20, 12, tzinfo=UTC)
STORED_BEFORE = datetime(2024, 1, 16, tzinfo=UTC)
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
LANDED = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", **PACKED}
BUILT_AT = datetime(2024, 2, 1, tzinfo=UTC)


def comparable(df: DataFrame) -> DataFrame:
    """Types and precision that every engine shares."""

    def plain(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), 9)
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        return comparable(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


# --- shared inputs ----------------------------------------------------------------------------


def _obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_view.observations(spark, sf_dir)


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.cell_hourly(_obs(spark, sf_dir))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_features(_cells(spark, sf_dir), unique=True)


def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For queries that read the feature table more than once."""
    return materialise(_features(spark, sf_dir), "features")


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_state(events_view.run_events(spark, sf_dir))


def _now(slots: DataFrame) -> Column:
    """A fixed clock: 3 h 20 min after the newest slot, as a scalar subquery."""
    return plus_minutes(slots.agg(F.max(SLOT)).scalar(), 200)


# --- sources and sinks ------------------------------------------------------------------------


@query
def snapshot_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.flatten_snapshots(
        snapshots.parse_bodies(events_view.snapshots(spark, sf_dir))
    )


@query
def altitude_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every altitude spelling of the feed, counted, with the altitude it means."""
    bodies = snapshots.parse_bodies(events_view.snapshots(spark, sf_dir))
    raw = bodies.select(F.inline("body.ac")).select("alt_baro", altitude_ft(F.col("alt_baro")).alias("alt"))
    return raw.groupBy("alt").agg(F.count(F.lit(1)).alias("reports"))


@query
def snapshot_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.snapshot_cells(
        snapshots.parse_bodies(events_view.snapshots(spark, sf_dir))
    )


@query
def broken_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers cut off on their way, per sweep and disc."""
    cut = events_view.snapshots(spark, sf_dir, cut_every=23)
    return snapshots.broken_answers(snapshots.parse_bodies(cut))


@query
def sweep_status_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of the sweeps when polls with a broken answer count as failed."""
    cut = events_view.snapshots(spark, sf_dir, cut_every=23)
    unread = snapshots.broken_answers(snapshots.parse_bodies(cut))
    polls = runs.with_broken_answers(events_view.polls(spark, sf_dir), unread)
    return runs.sweep_status(polls, runs.run_state(events_view.run_events(spark, sf_dir)))


def _legacy_folder(spark: SparkSession, sf_dir: str) -> str:
    """The fixture's cruise reports in the layout of the earlier history."""
    root = run_folder(spark, "legacy")
    reports = cells.cruise_filter(_obs(spark, sf_dir)).drop("slot_start", "ingest_run_id")
    dated = reports.withColumn("date", utc_date("observed_at"))
    dated.hint("rebalance", F.col("date")).write.partitionBy("date").parquet(root)
    return root


@query
def legacy_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.load_legacy(spark, _legacy_folder(spark, sf_dir)).drop("date")


@query
def legacy_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.reshape_legacy(cells.cruise_filter(_obs(spark, sf_dir)))


def _legacy_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy rows, a third of them twice, the second time with a NIC two lower."""
    rows = legacy.reshape_legacy(cells.cruise_filter(_obs(spark, sf_dir)))
    repeat = F.col("nac_p") == 9
    again = F.when(repeat, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    spread = rows.withColumn("_less", F.explode(again))
    return spread.withColumn("nic", (F.col("nic") - F.col("_less")).cast("smallint")).drop("_less")


@query
def legacy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.dedupe_legacy(_legacy_with_repeats(spark, sf_dir))


@query
def import_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = legacy.dedupe_legacy(_legacy_with_repeats(spark, sf_dir))
    stored = _obs(spark, sf_dir).filter(F.col(SLOT) < F.lit(STORED_BEFORE))
    return legacy.import_summary(rows, stored)


@query
def legacy_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import the earlier history twice; the table after that."""
    root, table = _legacy_folder(spark, sf_dir), run_folder(spark, "observations")
    first = legacy.import_legacy(spark, root, table)
    second = legacy.import_legacy(spark, root, table)
    return (
        store.stored_observations(spark, table)
        .groupBy(store.DATE)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("ingest_run_id").alias("first_run"),
            F.max("ingest_run_id").alias("last_run"),
        )
        .withColumns({"added_first": F.lit(first), "added_again": F.lit(second)})
    )


@query
def read_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.read_observations(_obs(spark, sf_dir), READ_FROM, READ_TO)


@query
def read_stored_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same read from a stored table, where the bounds also prune date folders."""
    table = run_folder(spark, "observations")
    store.append_if_absent(_obs(spark, sf_dir), table)
    return store.read_observations(
        store.stored_observations(spark, table), READ_FROM, READ_TO, cruise_only=False
    )


@query
def append_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches appended, the second one twice; the table after that."""
    table = run_folder(spark, "observations")
    reports = _obs(spark, sf_dir)
    late = reports.filter(F.col(SLOT) >= F.lit(READ_FROM))
    store.append_if_absent(reports.filter(F.col(SLOT) < F.lit(STORED_BEFORE)), table)
    added = store.append_if_absent(late.unionByName(late), table)
    replayed = store.append_if_absent(late, table)
    stored = store.stored_observations(spark, table).drop(store.DATE)
    return stored.withColumns({"added": F.lit(added), "replayed": F.lit(replayed)})


@query
def append_concurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writers at once, whose batches overlap; the table after that, and who added what."""
    table = run_folder(spark, "observations")
    reports = _obs(spark, sf_dir)
    batches = [
        reports.filter(F.col(SLOT) < F.lit(STORED_BEFORE)),
        reports.filter(F.col(SLOT) >= F.lit(READ_FROM)),
        reports,
    ]
    with ThreadPoolExecutor(len(batches)) as writers:
        added = sum(writers.map(lambda batch: store.append_if_absent(batch, table), batches))
    stored = store.stored_observations(spark, table).drop(store.DATE)
    return stored.withColumn("added", F.lit(added))


@query
def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir)


def _published(spark: SparkSession, sf_dir: str) -> str:
    root = run_folder(spark, "store")
    run_id = f"{BUILT_AT:features-%Y%m%dT%H%M%SZ}"  # the root is new, so the id is free
    result = run_feature_build(_obs(spark, sf_dir), root, BUILT_AT, run_id=run_id)
    if not result.published:
        raise RuntimeError(f"feature build refused: {result.problems}")
    return root


@query
def feature_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit row of a published build."""
    return feature_store.feature_runs(spark, _published(spark, sf_dir))


@query
def build_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table after three incremental builds, the last over reports that came late."""
    table, root = run_folder(spark, "observations"), run_folder(spark, "store")
    reports = _obs(spark, sf_dir)
    late = (F.col(SLOT) < F.lit(READ_FROM)) & F.col("hex").endswith("_7")
    batches = [
        reports.filter((F.col(SLOT) < F.lit(READ_TO)) & ~late),
        reports.filter(F.col(SLOT) >= F.lit(READ_TO)),
        reports.filter(late),
    ]
    for hours, batch in enumerate(batches):
        store.append_if_absent(batch, table)
        now = BUILT_AT + timedelta(hours=hours)
        result = run_incremental_build(spark, table, root, now)
    if not result.published:
        raise RuntimeError(f"feature build refused: {result.problems}")
    return feature_store.read_features(spark, root).drop(*LINEAGE)


@query
def publish_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit after a good build and one that the gate refuses; readers keep the good one."""
    root = _published(spark, sf_dir)
    strict = replace(DEFAULT_RULES, positive_rate_low=0.9, positive_rate_high=1.0)
    again = BUILT_AT + timedelta(hours=1)
    refused = run_feature_build(_obs(spark, sf_dir), root, again, run_id="refused", rules=strict)
    read = feature_store.read_features(spark, root)
    return read.groupBy("feature_run_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(refused.published).alias("published"),
        F.lit(len(refused.problems)).alias("problems"),
        F.lit(feature_store.feature_runs(spark, root).count()).alias("audited"),
    )


@query
def export_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain Parquet copy of the feature table, read back."""
    path = run_folder(spark, "export")
    feature_store.export_features(_features(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def read_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table as a training job reads it, lineage included."""
    return feature_store.read_features(spark, _published(spark, sf_dir))


@query
def feature_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_store.feature_run_summary(_features(spark, sf_dir))


# --- aggregation ------------------------------------------------------------------------------


@query
def cruise_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.cruise_filter(_obs(spark, sf_dir))


@query
def slot_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports per recomputed slot, with the span of their times."""
    return (
        cells.with_slot(_obs(spark, sf_dir).drop(SLOT))
        .groupBy(SLOT)
        .agg(
            F.count(F.lit(1)).alias("reports"),
            F.min("observed_at").alias("first_at"),
            F.max("observed_at").alias("last_at"),
        )
    )


@query
def assign_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = cells.assign_cells(cells.cruise_filter(_obs(spark, sf_dir)))
    return located.select("observed_at", "hex", "sample_point", "lat", "lon", *KEYS)


@query
def worst_nic_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = cells.assign_cells(cells.cruise_filter(_obs(spark, sf_dir)))
    return cells.worst_report_rows(located)


@query
def worst_nic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lean form the cell hours are built on."""
    return cells.worst_reports(cells.assign_cells(cells.cruise_filter(_obs(spark, sf_dir))))


@query
def cell_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir)


@query
def read_cell_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.read_cell_hourly(_obs(spark, sf_dir), READ_FROM, READ_TO)


@query
def collapse_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell hours of two overlapping altitude floors, collapsed to one row per hour."""
    reports = _obs(spark, sf_dir)
    high = reports.filter(F.col("altitude_ft") >= 24_000)
    return cells.collapse_runs(cells.cell_hourly(reports).unionByName(cells.cell_hourly(high)))


# --- features ---------------------------------------------------------------------------------


@query
def regular_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.regular_grid(_cells(spark, sf_dir))


@query
def cell_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.cell_neighbours(_cells(spark, sf_dir))


@query
def neighbour_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.neighbour_state(_cells(spark, sf_dir))


@query
def neighbour_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.neighbour_lags(_cells(spark, sf_dir), unique=True)


@query
def temporal_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.temporal_lags(_cells(spark, sf_dir))


@query
def trailing_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = features.trailing_means(_cells(spark, sf_dir))
    return wide.select(*KEYS, *[c for c in wide.columns if "_mean_" in c])


@query
def target_ahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.target_ahead(_cells(spark, sf_dir)).select(*KEYS, LABEL, TARGET)


@query
def build_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


@query
def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.score_rows(_cells(spark, sf_dir), unique=True)


@query
def model_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.model_matrix(_features(spark, sf_dir))


@query
def thin_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.thin_neighbours(
        cells.cell_hourly(_obs(spark, sf_dir), traffic_floor=False)
    )


@query
def validate_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate_features(_features(spark, sf_dir))


@query
def validate_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate on a table with repeated keys, impossible shares and wrong targets."""
    good = _stored_features(spark, sf_dir)
    hour = F.col("hour_utc")
    bad = good.withColumns(
        {
            TARGET: F.when(hour == 3, F.lit(2)).otherwise(F.col(TARGET)),
            "degraded_share_lag_1h": F.col("degraded_share_lag_1h")
            + F.when(hour == 4, F.lit(1.5)).otherwise(F.lit(0.0)),
            "degraded_share": F.when(hour == 5, F.lit(None)).otherwise(F.col("degraded_share")),
            "aircraft_count": F.when(hour == 6, F.lit(4)).otherwise(F.col("aircraft_count")),
        }
    )
    return quality.validate_features(bad.unionByName(good.filter(hour == 7)))


# --- discs and regions ------------------------------------------------------------------------


@query
def disc_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = discs.disc_membership(_obs(spark, sf_dir), points.all_points(spark))
    return covered.groupBy("disc", "control").agg(
        F.count(F.lit(1)).alias("reports"),
        F.min("distance_nm").alias("nearest_nm"),
        F.max("distance_nm").alias("farthest_nm"),
    )


@query
def active_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports inside the interference discs only."""
    active = points.active_points(points.all_points(spark), include_controls=False)
    covered = discs.disc_membership(_obs(spark, sf_dir), active)
    return covered.groupBy("disc").agg(
        F.count(F.lit(1)).alias("reports"), F.count_distinct("hex").alias("aircraft")
    )


@query
def region_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discs.region_rollup(
        _obs(spark, sf_dir), events_view.sample_points(spark, sf_dir)
    )


# --- monitoring -------------------------------------------------------------------------------


@query
def slot_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.slot_coverage(_obs(spark, sf_dir))


@query
def history_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.history_stats(_obs(spark, sf_dir))


@query
def capture_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = _obs(spark, sf_dir)
    return coverage.capture_lag(reports, _now(reports))


@query
def capture_watchdog(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = _obs(spark, sf_dir)
    return coverage.capture_watchdog(reports, _now(reports))


@query
def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.gap_report(coverage.slot_coverage(_obs(spark, sf_dir), ordered=False))


@query
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.completeness(coverage.slot_coverage(_obs(spark, sf_dir), ordered=False))


@query
def sweep_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = runs.run_state(events_view.run_events(spark, sf_dir))
    return runs.sweep_status(events_view.polls(spark, sf_dir), log)


@query
def close_stale_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _runs(spark, sf_dir)
    return runs.close_stale_runs(state, _now(state))


@query
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.recent_runs(_runs(spark, sf_dir))


@query
def runs_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.runs_by_status(_runs(spark, sf_dir), utc_date(SLOT))


@query
def health_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.health_transitions(_runs(spark, sf_dir))


# --- analyses ---------------------------------------------------------------------------------


@query
def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _stored_features(spark, sf_dir)
    return evaluation.chrono_split(table).select(*KEYS, TARGET, "segment")


@query
def persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.persistence(_features(spark, sf_dir))


def _climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = evaluation.chrono_split(_stored_features(spark, sf_dir))
    return evaluation.climatology(split.filter(F.col("segment") == "train"), split)


@query
def climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _climatology(spark, sf_dir).select(*KEYS, "segment", TARGET, "score")


@query
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Climatology against the outcome, over all rows."""
    return evaluation.average_precision(_climatology(spark, sf_dir))


@query
def onset_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the worst neighbour ranks the onsets among clean cells."""
    clean = _features(spark, sf_dir).filter(F.col(LABEL) == 0)
    scored = clean.withColumn(
        "score", F.coalesce("nbr_degraded_share_max", F.lit(0.0))
    )
    return evaluation.average_precision(scored)


@query
def brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.brier(_climatology(spark, sf_dir))


@query
def region_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = cells.assign_cells(cells.cruise_filter(_obs(spark, sf_dir)))
    return evaluation.region_metrics(
        _features(spark, sf_dir),
        discs.cell_regions(located),
        threshold=0.30,
        score="nbr_degraded_share_max",
    )


@query
def transition_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.transition_rates(_features(spark, sf_dir))


@query
def floor_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.floor_audit(_obs(spark, sf_dir))


@query
def floor_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does the traffic floor drop the degraded discs, and the degraded cells?"""
    by_disc = materialise(analysis.floor_audit(_obs(spark, sf_dir)), "floor-audit")
    every = cells.cell_hourly(_obs(spark, sf_dir), traffic_floor=False)
    by_cell = materialise(analysis.floor_by_cell(every), "floor-by-cell")
    rows = [
        analysis.correlation(df, "drop_rate", "degraded_rate").withColumn("level", F.lit(level))
        for level, df in (("disc", by_disc), ("cell", by_cell))
    ]
    return rows[0].unionByName(rows[1])


@query
def resolution_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.resolution_sweep(_obs(spark, sf_dir))


@query
def lag_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.lag_availability(_features(spark, sf_dir))


@query
def psi_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evaluation.chrono_split(_stored_features(spark, sf_dir))
    columns = features.feature_columns(table.drop("segment"))
    return analysis.psi_drift(
        table.filter(F.col("segment") == "train"),
        table.filter(F.col("segment") == "test"),
        columns,
    )


@query
def lagged_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = materialise(_cells(spark, sf_dir), "cell-hours")
    forecasts = features.score_rows(hours, unique=True).withColumn(
        "score", F.col(LABEL).cast("double")
    )
    return evaluation.lagged_accuracy(forecasts, hours)


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = evaluation.class_weights(_stored_features(spark, sf_dir))
    return weighted.select(*KEYS, TARGET, "weight")


# --- streaming --------------------------------------------------------------------------------


@query
def stream_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed answers landed as files, streamed into the report table; then landed again."""
    landing, table, state = (
        run_folder(spark, name) for name in ("landing", "observations", "capture-state")
    )
    answers = snapshots.parse_bodies(events_view.snapshots(spark, sf_dir)).drop("broken")
    for again in (False, True):
        if again:  # the same lines, which need not be parsed to be landed
            spark.read.text(landing).write.mode("append").options(**PACKED).text(landing)
        else:
            answers.write.mode("append").options(**LANDED).json(landing)
        stream = capture.snapshot_stream(spark, landing)
        capture.start_capture(stream, table, state).awaitTermination()
    return store.stored_observations(spark, table).drop(store.DATE)


@query
def stream_capture_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the later half landed and captured first; the older ones come days late."""
    landing, table, state = (
        run_folder(spark, name) for name in ("landing", "observations", "capture-state")
    )
    answers = snapshots.parse_bodies(events_view.snapshots(spark, sf_dir)).drop("broken")
    in_time = F.col("observed_at") >= F.lit(STORED_BEFORE)
    for batch in (answers.filter(in_time), answers.filter(~in_time)):
        batch.write.mode("append").options(**LANDED).json(landing)
        stream = capture.snapshot_stream(spark, landing)
        capture.start_capture(stream, table, state).awaitTermination()
    return store.stored_observations(spark, table).drop(store.DATE)


@query
def stream_cell_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell hours of a stored report table read as a stream, up to the last closed hour."""
    source, table, state = (
        run_folder(spark, name) for name in ("observations", "cell-hours", "cells-state")
    )
    reports = _obs(spark, sf_dir)
    reports.write.parquet(source)
    stream = spark.readStream.schema(reports.schema).parquet(source)
    cell_stream.start_cell_hourly(stream, table, state).awaitTermination()
    return spark.read.parquet(table).select(*KEYS, *CELL_VALUES)


@query
def stream_cells_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed cell hours after a repair: some aircraft of the first days are reported at the end."""
    source, table, hours, late, repairs = (
        run_folder(spark, name)
        for name in ("arriving", "observations", "cell-hours", "late", "repairs")
    )
    states = run_folder(spark, "cells-state"), run_folder(spark, "capture-state")
    reports = _obs(spark, sf_dir)
    behind = (F.col(SLOT) < F.lit(READ_FROM)) & F.col("hex").endswith("_7")
    for batch in (
        reports.filter((F.col(SLOT) < F.lit(READ_TO)) & ~behind),
        reports.filter(F.col(SLOT) >= F.lit(READ_TO)),
        reports.filter(behind),
    ):
        batch.write.mode("append").parquet(source)
        stream = spark.readStream.schema(reports.schema).parquet(source)
        cell_stream.start_cell_hourly(stream, hours, states[0]).awaitTermination()
        capture.start_reports(stream, table, states[1], late=late).awaitTermination()
    reopened.repair_cell_hours(spark, table, late, repairs)
    return reopened.read_cell_hours(spark, hours, repairs).select(*KEYS, *CELL_VALUES)


@query
def stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records streamed through the alert rules, then replayed."""
    source, log, alerts, state = (
        run_folder(spark, name) for name in ("run-records", "run-log", "alerts", "health-state")
    )
    records = events_view.run_events(spark, sf_dir)
    for _ in range(2):
        records.write.mode("append").parquet(source)
        stream = spark.readStream.schema(records.schema).parquet(source)
        health_stream.start_health(stream, log, alerts, state).awaitTermination()
    return spark.read.parquet(alerts)
