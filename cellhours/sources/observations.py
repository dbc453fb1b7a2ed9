"""The raw report table: commits of append-only Parquet, partitioned by slot date."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_, or_
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellhours.config import DEFAULT_RULES, Rules
from cellhours.functions.timeslots import utc_date
from cellhours.operators.cells import cell_hourly
from cellhours.schemas import OBSERVATION_KEY, OBSERVATIONS, SLOT
from cellhours.sources.appends import (
    DATE,
    REPORT_FILES,
    ROWS_PER_TASK,
    absent_rows,
    on_days,
    only_slots,
    slot_digests,
    slots_with_news,
)
from cellhours.sources.commits import (
    COMMIT,
    Entry,
    children,
    log_entries,
    publish,
    read_commits,
    remove,
    stage,
)
from cellhours.sources.scratch import materialise

# What one exchange of an append may hold, about 35 bytes a row on disk.
ROWS_AT_ONCE = 200_000_000
_TURNS: dict[str, Lock] = {}

READ_COLUMNS = [f.name for f in OBSERVATIONS.fields if f.name != "ingest_run_id"]


def stored_observations(
    spark: SparkSession, path: str, entries: list[Entry] | None = None
) -> DataFrame:
    """The whole table, or the commits of some entries; an empty one before the first write.

    Date folders that lie in `path` itself were written before there was a log; they belong to
    the table as well.
    """
    rows = read_commits(
        spark, path, log_entries(spark, path) if entries is None else entries, OBSERVATIONS,
        DATE, "date",
    )
    if entries is None and any(n.startswith(f"{DATE}=") for n in children(spark, path)):
        schema = StructType([*OBSERVATIONS.fields]).add(DATE, "date")
        old = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{DATE}=*")
        return rows.unionByName(old)
    return rows


def newest_day(spark: SparkSession, path: str) -> DataFrame:
    """The reports of the last stored date, which the log and the folder names tell."""
    dates = {p for e in log_entries(spark, path) for p in e.parts}
    dates |= {n.split("=", 1)[1] for n in children(spark, path) if n.startswith(f"{DATE}=")}
    last = max((d for d in dates if d[:1].isdigit()), default=None)
    return stored_observations(spark, path).filter(F.col(DATE) == F.lit(last).cast("date"))


def _bound(value: datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def read_observations(
    observations: DataFrame,
    start: datetime | Column | None = None,
    end: datetime | Column | None = None,
    cruise_only: bool = True,
    rules: Rules = DEFAULT_RULES,
    ordered: bool = True,
) -> DataFrame:
    """Reports within inclusive slot bounds, optionally only those at cruise.

    On a stored table the bounds are repeated on the partition date, so whole folders are
    skipped. The order (slot, aircraft) is for people who look at the rows; jobs pass
    ``ordered=False`` and save the sort. The rest of the key breaks ties, so that a sort range
    can end between two reports of one aircraft.
    """
    rows = observations
    dated = DATE in observations.columns
    if start is not None:
        rows = rows.filter(F.col("slot_start") >= _bound(start))
        if dated:
            rows = rows.filter(F.col(DATE) >= utc_date(_bound(start)))
    if end is not None:
        rows = rows.filter(F.col("slot_start") <= _bound(end))
        if dated:
            rows = rows.filter(F.col(DATE) <= utc_date(_bound(end)))
    if cruise_only:
        rows = rows.filter(F.col("altitude_ft") >= F.lit(rules.min_altitude_ft))
    rows = rows.select(*READ_COLUMNS)
    return rows.orderBy(*OBSERVATION_KEY) if ordered else rows


def read_cell_hourly(
    observations: DataFrame,
    start: datetime | Column | None = None,
    end: datetime | Column | None = None,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Cell hours of the reports within inclusive slot bounds."""
    rows = read_observations(observations, start, end, rules=rules, ordered=False)
    return cell_hourly(rows, rules)


def first_per_key(rows: DataFrame, *order: str) -> DataFrame:
    """One row per primary key: the smallest by `order`, ties broken by the other columns.

    An aggregate and not a ranking, so any number of copies of one report is reduced on the map
    side and no task ever holds them all.
    """
    rest = [c for c in rows.columns if c not in OBSERVATION_KEY]
    ranked = [*order, *[c for c in rest if c not in order]]
    best = F.min(F.struct(*ranked)).alias("_best")
    picked = rows.groupBy(*OBSERVATION_KEY).agg(best)
    return picked.select(
        *[F.col(c) if c in OBSERVATION_KEY else F.col(f"_best.{c}") for c in rows.columns]
    )


def stored_keys(batch: DataFrame, existing: DataFrame) -> tuple[DataFrame, Column]:
    """Keys of the table that a batch can meet, and the condition that a row's key is one."""
    stored = existing
    if DATE in existing.columns:
        # Only the dates the batch touches can hold its keys. The two bounds are a scalar
        # subquery, which prunes partitions when the scan starts.
        day = utc_date("slot_start")
        span = batch.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi"))).scalar()
        stored = existing.filter(
            F.col(DATE).between(span.getField("lo"), span.getField("hi"))
        )
    keys = stored.select(*[F.col(c).alias(f"_{c}") for c in OBSERVATION_KEY])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in OBSERVATION_KEY])
    return keys, same


def _dates_held(spark: SparkSession, path: str, entries: list[Entry], whole: bool) -> set[str]:
    """Names of the date folders that some commits, or the whole table, may have rows in."""
    held = {p for e in entries for p in e.parts}
    if whole:
        held |= {n.split("=", 1)[1] for n in children(spark, path) if n.startswith(f"{DATE}=")}
    return held


@dataclass(frozen=True)
class _News:
    """What of a batch a table lacks: the slots, their rows by date, and the stored keys there."""

    slots: DataFrame
    dates: list[Row]
    existing: DataFrame | None


def _news(
    mine: DataFrame, path: str, entries: list[Entry], whole: bool
) -> _News | None:
    """The slots of a batch, given their digests, that some commits or the whole table lack."""
    spark = mine.sparkSession
    day = utc_date(SLOT).cast("string")
    days = [r[0] for r in mine.select(day).distinct().collect()]  # a row per date
    held = _dates_held(spark, path, entries, whole)
    shared = [d for d in days if d in held]  # rows without a slot have no date to be found by
    existing = theirs = None
    if shared:
        stored = stored_observations(spark, path, None if whole else entries)
        existing = stored.filter(on_days(shared)).select(*OBSERVATION_KEY, DATE)
        theirs = slot_digests(existing)
    slots = materialise(slots_with_news(mine, theirs).withColumn("_day", day), "append-news")
    dates = (
        slots.groupBy("_day")
        .agg(F.sum("_rows").alias("rows"), F.max("_stored").alias("stored"))
        .collect()
    )
    return _News(slots, dates, existing) if dates else None


def _rounds(dates: list[Row]) -> list[list[Row]]:
    """Dates in groups of about ROWS_AT_ONCE rows, one date at least."""
    rounds: list[list[Row]] = []
    room = 0
    for date in sorted(dates, key=lambda r: r._day or ""):
        if not rounds or date.rows > room:
            rounds.append([])
            room = ROWS_AT_ONCE
        rounds[-1].append(date)
        room -= date.rows
    return rounds


def _stage_absent(
    batch: DataFrame, news: _News | None, path: str, order: tuple[str, ...]
) -> tuple[str, tuple[str, ...], int] | None:
    """Stage the rows of a batch whose key the table lacks; None if there is no such row.

    A batch of very many rows is moved by some dates at a time, so the files of its exchange
    stay small beside the table; all go into one commit.
    """
    if news is None:
        return None
    spark = batch.sparkSession
    commit_id, dates, count = None, (), 0
    rounds = _rounds(news.dates)
    for some in rounds:
        keys = None
        if mixed := [r._day for r in some if r.stored]:
            stored = news.slots.filter(F.col("_stored") & F.col("_day").isin(mixed))
            keys = only_slots(news.existing.filter(on_days(mixed)), stored)
        rows = batch
        if news.existing is not None or len(rounds) > 1:
            here = reduce(or_, [F.col("_day").eqNullSafe(F.lit(r._day)) for r in some])
            rows = only_slots(batch, news.slots.filter(here))
        tasks = math.ceil(sum(r.rows for r in some) / ROWS_PER_TASK)
        parts = math.ceil(max(r.rows for r in some) / ROWS_PER_TASK)
        # The row count is taken from the writing stage, whose tasks count once even after a lost
        # executor.
        written = Observation()
        fresh = absent_rows(rows, keys, tasks, parts, order)
        counted = fresh.observe(written, F.count(F.lit(1)).alias("rows"))
        commit_id, dates = stage(counted, path, DATE, commit_id, **REPORT_FILES)
        count += int(written.get["rows"])
    if not count:
        remove(spark, f"{path}/{COMMIT}={commit_id}")
        return None
    return commit_id, dates, count


def _turn(path: str) -> Lock:
    """Held while a writer of this process stages rows for a table.

    The writers of a process share its executors, so staging at the same time gains them
    nothing: each would move and write what they have in common. In turns, a writer finds the
    rows of those before it in the table. Writers of other processes meet in the log only.
    """
    return _TURNS.setdefault(path.rstrip("/"), Lock())


def append_if_absent(
    batch: DataFrame, path: str, attempts: int = 20, order: tuple[str, ...] = ()
) -> int:
    """Append the rows whose key is new; returns how many. Replaying a batch adds nothing.

    Of several rows of a key the smallest by `order`, then by the other columns, is taken. A NULL
    in a key equals a NULL, but rows without a slot are not looked up in the table. Any number of
    writers may append at a time: a commit that another one came before is checked against that
    one's rows, if both hold a date, and tried again behind it.
    """
    spark = batch.sparkSession
    rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in OBSERVATIONS.fields])
    mine = materialise(slot_digests(rows), "append-slots")  # a row per hour
    with _turn(path):
        known = log_entries(spark, path)
        while True:
            version = known[-1].version if known else 0
            news = _news(mine, path, known, True)
            # The writer before commits once its turn is over, which may have been just now.
            newer = log_entries(spark, path, version)
            if not newer:
                break
            known += newer
        staged = _stage_absent(rows, news, path, order)
    for _ in range(attempts):
        if staged is None:
            return 0
        commit_id, dates, count = staged
        newer = []
        while not any(set(e.parts) & set(dates) for e in newer):
            entry = Entry(version + 1, commit_id, count, dates)
            if publish(spark, path, entry):
                return count
            newer = log_entries(spark, path, version)
            version = newer[-1].version
        mine = stored_observations(spark, path, [entry]).select(*OBSERVATIONS.names)
        with _turn(path):
            digests = materialise(slot_digests(mine), "append-slots")
            staged = _stage_absent(mine, _news(digests, path, newer, False), path, order)
        remove(spark, f"{path}/{COMMIT}={commit_id}")  # in no entry, so nobody reads it
    raise RuntimeError(f"other writers came first {attempts} times")
