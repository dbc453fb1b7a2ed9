"""Streaming health edges: alerts as the run records of the sweeps arrive."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cellhours.functions.timeslots import utc_date
from cellhours.operators.health import health_transitions
from cellhours.schemas import INGEST_RUNS, SLOT
from cellhours.sources.commits import children
from cellhours.sources.runs import run_state
from cellhours.sources.scratch import path_missing

DAY = "slot_date"
_DAY_STATE = StructType().add("outage_since", "timestamp").add(DAY, "date")


def _table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], schema)


def _outage_before(spark: SparkSession, days: str, first: str) -> Column | None:
    """Start of the outage that was open at the end of the last day before `first`, if one was."""
    names = [n for n in children(spark, days) if n.startswith(f"{DAY}=")]
    earlier = max((n for n in names if n < f"{DAY}={first}"), default=None)
    if earlier is None:
        return None
    state = spark.read.schema(_DAY_STATE).option("basePath", days).parquet(f"{days}/{earlier}")
    since = state.agg(F.unix_micros(F.max("outage_since"))).first()[0]
    return None if since is None else F.timestamp_micros(F.lit(since))


def _state_by_day(runs: DataFrame, edges: DataFrame, before: Column | None) -> DataFrame:
    """Per day with ended sweeps: the start of the outage that is open at its end, or NULL."""
    ended = runs.filter(F.col("status") != "running").groupBy(utc_date(SLOT).alias(DAY)).agg(
        F.max_by(F.col("status") == "ok", F.struct(SLOT, "run_id")).alias("_healthy")
    )
    began = (
        edges.filter("transition = 'degraded'")
        .groupBy(utc_date(SLOT).alias(DAY))
        .agg(F.max(SLOT).alias("_began"))
    )
    latest = F.last("_began", ignorenulls=True).over(Window.orderBy(DAY))
    since = F.coalesce(latest, F.lit(None).cast("timestamp") if before is None else before)
    return ended.join(began, DAY, "left").select(
        F.when(~F.col("_healthy"), since).alias("outage_since"), DAY
    )


def emit_new_edges(batch: DataFrame, log: str, alerts: str) -> None:
    """Add a batch of run records to the log and append the edges not reported before.

    The log lies in folders by slot date, and beside it (`<log>_days`) the state at the end of
    each day: whether an outage is open, and since when. A batch reads that of the day before its
    earliest slot, one row, and the log from that slot's day on, however long the history. All
    records of a run name one slot. Every write skips or replaces what is stored already, so
    replaying a batch changes nothing.
    """
    spark = batch.sparkSession
    columns = ["seq", *[f.name for f in INGEST_RUNS.fields]]
    records = batch.select(*columns, utc_date(SLOT).alias(DAY)).dropDuplicates(["run_id", "seq"])
    first = records.agg(F.min(DAY).cast("string")).first()[0]
    if first is None:
        return
    recent = F.col(DAY) >= F.lit(first).cast("date")
    stored = _table(spark, log, records.schema).filter(recent).select("run_id", "seq")
    records.join(stored, ["run_id", "seq"], "left_anti").write.mode("append").partitionBy(
        DAY
    ).parquet(log)
    days = f"{log.rstrip('/')}_days"
    before = _outage_before(spark, days, first)
    runs = run_state(_table(spark, log, records.schema).filter(recent))
    edges = health_transitions(runs, before)
    key = ["run_id", "transition"]
    told = _table(spark, alerts, edges.schema).filter(
        utc_date(SLOT) >= F.lit(first).cast("date")
    )
    untold = edges.join(told.select(*key), key, "left_anti").select(*edges.columns)
    untold.write.mode("append").parquet(alerts)
    _state_by_day(runs, edges, before).coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(DAY).parquet(days)


def start_health(
    run_log: DataFrame, log: str, alerts: str, checkpoint: str, continuous: str | None = None
) -> StreamingQuery:
    def step(batch: DataFrame, _: int) -> None:
        batch.persist()  # a batch is looked at three times
        try:
            emit_new_edges(batch, log, alerts)
        finally:
            batch.unpersist()

    writer = run_log.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()
