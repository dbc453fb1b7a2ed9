"""The hourly job without rereading history: only what new reports can change is built anew.

Three tables hang together by manifest: the commits of the raw table tell which dates have new
reports; cell hours are kept by date, and the dates with new reports are aggregated again; feature
rows are kept by month, and the months that a changed hour can reach, by the longest lag ahead
and by the horizon back, are built again from the cell hours around them. A published build names
the folder of every date and month, most of them those of earlier builds.
"""

from __future__ import annotations

import math
import uuid
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.timeslots import utc_date
from cellhours.operators.cells import cell_hourly
from cellhours.operators.coverage import capture_watchdog
from cellhours.operators.features import build_features
from cellhours.operators.quality import problems
from cellhours.plans.build import BuildResult
from cellhours.schemas import FEATURE_RUNS, SLOT, TARGET
from cellhours.sources.commits import log_entries
from cellhours.sources.feature_store import (
    DAY,
    DAYS,
    MONTH,
    MONTHS,
    cells_path,
    manifest,
    newest_run,
    read_cell_days,
    runs_path,
    stage_features,
    write_manifest,
)
from cellhours.sources.observations import DATE, newest_day, stored_observations


def reach(rules: Rules = DEFAULT_RULES) -> tuple[int, int]:
    """Days before and after a changed date whose feature rows may change with it."""
    ahead = max(
        *rules.lag_hours, *rules.neighbour_lag_hours, *rules.share_window_hours,
        *rules.count_window_hours,
    )
    return math.ceil(rules.horizon_hours / 24), math.ceil(ahead / 24)


def months_reached(days: list[date], rules: Rules = DEFAULT_RULES) -> set[date]:
    """First days of all months with feature rows that the cell hours of `days` take part in."""
    before, after = reach(rules)
    return {
        (day + timedelta(days=shift)).replace(day=1)
        for day in days
        for shift in range(-before, after + 1)
    }


def _days_of(months: set[date], rules: Rules) -> set[date]:
    """The dates whose cell hours the feature rows of some months need."""
    before, after = reach(rules)
    out: set[date] = set()
    for month in months:
        following = (month + timedelta(days=31)).replace(day=1)
        day = month - timedelta(days=after)
        while day < following + timedelta(days=before):
            out.add(day)
            day += timedelta(days=1)
    return out


def _stage_cells(
    reports: DataFrame, root: str, run_id: str, rules: Rules
) -> dict[str, tuple[str, int]]:
    """Aggregate and store the cell hours of some dates: {date: (run id, cell hours)}."""
    hours = cell_hourly(reports, rules).withColumn(DAY, utc_date(SLOT))
    hours.hint("rebalance", F.col(DAY)).write.mode("errorifexists").partitionBy(DAY).parquet(
        cells_path(root, run_id)
    )
    spark = reports.sparkSession
    schema = hours.schema
    stored = spark.read.schema(schema).parquet(cells_path(root, run_id))
    return {str(r[DAY]): (run_id, r["count"]) for r in stored.groupBy(DAY).count().collect()}


def run_incremental_build(
    spark: SparkSession,
    observations: str,
    root: str,
    now: datetime,
    run_id: str | None = None,
    rules: Rules = DEFAULT_RULES,
) -> BuildResult:
    """Bring the published feature table up to the newest commit of the table at `observations`.

    The result is that of a full build. The gate checks the rows that are new, which include all
    keys of their months, and the positive rate of the whole table. A refused build changes
    nothing: the next one starts from the last published build again. The first build, and one
    with another feature version, covers all dates. Rows keep the id of the run that computed
    them. For one builder at a time.
    """
    run_id = run_id or f"{now:features-%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"
    stale = capture_watchdog(newest_day(spark, observations), F.lit(now), rules).first().problem
    last = newest_run(spark, root)
    parts = manifest(spark, root, last) if last else []
    parts = [p for p in parts if p.feature_version == rules.feature_version]
    seen = max((p.raw_version for p in parts), default=0)
    entries = log_entries(spark, observations, seen)
    version = entries[-1].version if entries else seen
    days = {p.part: (p.folder, p.rows) for p in parts if p.kind == DAYS}
    months = {p.part: p for p in parts if p.kind == MONTHS}

    def refused(*reasons: str) -> BuildResult:
        return BuildResult(run_id, False, sum(n for _, n in days.values()), stale, list(reasons))

    reports = stored_observations(spark, observations)
    if parts:
        dirty = sorted({p for e in entries for p in e.parts if p[:1].isdigit()})
        changed = [date.fromisoformat(d) for d in dirty]
        # Only dates with new commits are read again, and of them all reports.
        reports = reports.filter(F.col(DATE).isin(changed))
    if not parts or dirty:
        fresh = _stage_cells(reports, root, run_id, rules)
        days = {d: v for d, v in days.items() if parts and d not in dirty} | fresh
        if not parts:
            changed = [date.fromisoformat(d) for d in fresh]
    else:
        changed = []
    if not days:
        return refused("the raw table holds no cell hour to build from")

    reached = months_reached(changed, rules)
    needed = {str(d) for d in _days_of(reached, rules)}
    kept = {m: p for m, p in months.items() if date.fromisoformat(m) not in reached}
    rows = [
        (MONTHS, p.part, p.folder, p.rows, p.positives, p.first_slot, p.last_slot)
        for p in kept.values()
    ]
    if reached:
        hours = read_cell_days(spark, root, {d: f for d, (f, _) in days.items() if d in needed})
        month = F.trunc(utc_date(SLOT), "month")
        built = build_features(hours, rules, unique=True).filter(month.isin(sorted(reached)))
        staged = stage_features(built, root, run_id, rules)
        found = problems(
            staged, rules, sum(p.rows for p in kept.values()), sum(p.positives for p in kept.values())
        )
        new = (
            staged.groupBy(month.alias("month"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.col(TARGET).cast("double")).alias("positives"),
                F.min(SLOT).alias("first"),
                F.max(SLOT).alias("last"),
            )
            .collect()
        )
        rows += [(MONTHS, str(r.month), run_id, r.n, r.positives, r["first"], r["last"]) for r in new]
        if not rows:
            total = sum(n for _, n in days.values())
            return refused(
                f"none of {total} cell hours has a target {rules.horizon_hours} hours ahead so far"
            )
        if found:
            return refused(*found)
    rows += [(DAYS, d, f, n, None, None, None) for d, (f, n) in days.items()]
    write_manifest(spark, root, run_id, [(*r, version, rules.feature_version) for r in rows])
    cell_slots = sum(n for _, n in days.values())
    _commit(spark, root, run_id, now, cell_slots, [r for r in rows if r[0] == MONTHS], rules)
    return BuildResult(run_id, True, cell_slots, stale)


def _commit(
    spark: SparkSession, root: str, run_id: str, now: datetime, cell_slots: int,
    months: list[tuple], rules: Rules,
) -> None:
    """The audit row, from the counts that the manifest has of every month."""
    labelled = sum(m[3] for m in months)
    values = {
        "run_id": run_id,
        "feature_version": rules.feature_version,
        "built_at": now if now.tzinfo else now.replace(tzinfo=UTC),
        "first_slot": min(m[5] for m in months),
        "last_slot": max(m[6] for m in months),
        "cell_slots": cell_slots,
        "labelled_rows": labelled,
        "positive_rate": sum(m[4] for m in months) / labelled,
        "status": "succeeded",
    }
    row = spark.createDataFrame([tuple(values[f.name] for f in FEATURE_RUNS)], FEATURE_RUNS)
    row.write.mode("append").parquet(runs_path(root))
