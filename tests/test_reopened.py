"""Cell hours that late reports reopen: what is noted, repaired and read."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from cellhours.__main__ import main
from cellhours.operators.cells import cell_hourly
from cellhours.schemas import KEYS, LANDED_TEXT, OBSERVATIONS
from cellhours.sources import commits
from cellhours.sources.observations import append_if_absent
from cellhours.sources.snapshots import parse_bodies
from cellhours.streaming.capture import start_reports
from cellhours.streaming.cells import start_cell_hourly
from cellhours.streaming.reopened import (
    note_late,
    read_cell_hours,
    repair_cell_hours,
    repaired_cell_hours,
)
from tests.conftest import EAST, EAST_CELL, HOME_CELL, T0, by_key, observations, report, traffic


def noted(spark, ledger):
    """(cell key, hours after T0) of all notes."""
    folders = [f"{ledger}/late/{n}" for n in commits.children(spark, f"{ledger}/late")]
    rows = [r for f in folders for r in spark.read.parquet(f).select(
        "cell_key", ((F.unix_seconds("slot_start") - int(T0.timestamp())) / 3600).alias("h")
    ).collect()]
    return sorted((r.cell_key, int(r.h)) for r in rows)


@pytest.mark.parametrize("size", [1, 4])
def test_stream_and_repair_equal_the_batch(spark, tmp_path, size):
    source, table, hours, ledger, repairs, first, second = (
        str(tmp_path / n) for n in ("in", "table", "hours", "late", "repairs", "s1", "s2")
    )
    batches = [traffic([h], lambda _: h % 4 / 10) for h in range(8)]
    batches[4] += traffic([4], lambda _: 0, EAST, vehicles=3, tag="e")  # too few to show
    batches.append(
        traffic([2], lambda _: 1, tag="late")  # turns the label of the hour
        + traffic([4], lambda _: 0.5, EAST, vehicles=4, tag="f")  # together enough
        + traffic([1], lambda _: 0, EAST, vehicles=2, tag="g")  # still too few
    )
    batches.append(traffic([9], lambda _: 0) + [report("low", 1, T0 + timedelta(hours=3), altitude=9e3)])
    for rows in batches:
        observations(spark, rows).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", size).parquet(source)
    one_by_one = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    start_cell_hourly(one_by_one, hours, first).awaitTermination()
    start_reports(stream, table, second, late=ledger).awaitTermination()

    everything = observations(spark, [r for b in batches for r in b])
    want = {k: v for k, v in by_key(cell_hourly(everything)).items() if k[1] < 9}
    streamed = by_key(spark.read.parquet(hours))
    assert streamed.keys() < want.keys()
    assert streamed[HOME_CELL, 2].is_degraded == 0 and want[HOME_CELL, 2].is_degraded == 1
    if size == 1:  # the low report is none of the cell hours', and its batch noted nothing
        assert sorted(h for _, h in noted(spark, ledger)) == [1, 2, 4]
        assert repair_cell_hours(spark, table, ledger, repairs) == 3
    else:
        assert {1, 2, 4} <= {h for _, h in noted(spark, ledger)}
        assert repair_cell_hours(spark, table, ledger, repairs) >= 3
    assert by_key(read_cell_hours(spark, hours, repairs)) == want
    assert (EAST_CELL, 4) in want and (EAST_CELL, 1) not in want
    assert noted(spark, ledger) == [] and repair_cell_hours(spark, table, ledger, repairs) == 0
    assert len(commits.log_entries(spark, repairs)) == 1


def test_replays_and_later_repairs(spark, tmp_path):
    table, hours, ledger, repairs = (str(tmp_path / n) for n in ("t", "hours", "late", "repairs"))

    def take(batch_id, rows):
        frame = observations(spark, rows)
        append_if_absent(frame, table)
        note_late(frame, batch_id, ledger)
        return noted(spark, ledger)

    assert take(0, traffic([0], lambda _: 0)) == []
    assert take(1, []) == []  # the newest time is handed on
    assert take(2, traffic([5], lambda _: 0)) == []
    cell_hourly(observations(spark, traffic([0], lambda _: 0))).write.parquet(hours)
    late = traffic([0], lambda _: 1, tag="late")
    assert len(take(3, late)) == 1 and take(3, late) == take(3, late)
    assert len(commits.children(spark, f"{ledger}/clock")) == 2
    assert repair_cell_hours(spark, table, ledger, repairs) == 1
    assert by_key(read_cell_hours(spark, hours, repairs))[HOME_CELL, 0].aircraft_count == 20
    take(4, traffic([0, 1], lambda _: 1, tag="later"))
    assert repair_cell_hours(spark, table, ledger, repairs) == 2
    rows = by_key(read_cell_hours(spark, hours, repairs))
    assert rows[HOME_CELL, 0].aircraft_count == 30 and rows[HOME_CELL, 1].aircraft_count == 10


def test_a_batch_that_is_still_written_is_left_alone(spark, tmp_path):
    ledger, repairs = str(tmp_path / "late"), str(tmp_path / "repairs")
    (tmp_path / "late" / "late" / "batch_id=0").mkdir(parents=True)
    assert repair_cell_hours(spark, str(tmp_path / "t"), ledger, repairs) == 0
    assert (tmp_path / "late" / "late" / "batch_id=0").exists()
    assert repaired_cell_hours(spark, repairs).count() == 0
    assert repaired_cell_hours(spark, repairs).columns[:2] == list(KEYS)
    empty = spark.createDataFrame([], OBSERVATIONS)
    note_late(empty, 0, str(tmp_path / "other"))
    assert not (tmp_path / "other" / "late").exists()


def test_jobs_from_landing_to_repair(spark, tmp_path):
    landing, table, hours, ledger, repairs, first, second = (
        str(tmp_path / n) for n in ("landing", "table", "hours", "late", "repairs", "s1", "s2")
    )
    for hour, tag in [(0, "a"), (5, "a"), (0, "b"), (9, "a")]:
        planes = ", ".join(
            '{"hex": "%s%d", "lat": 52.0, "lon": 10.0, "alt_baro": 35000, "nic": 9}' % (tag, i)
            for i in range(6)
        )
        row = (T0 + timedelta(hours=hour), "d0", False, "run", '{"now": 1, "ac": [%s]}' % planes)
        answers = parse_bodies(spark.createDataFrame([row], LANDED_TEXT)).drop("broken")
        answers.write.mode("append").json(landing)
        where = ["--landing", landing, "--checkpoint"]
        assert main(["stream-cells", *where, first, "--cell-hours", hours]) == 0
        assert main(["capture", *where, second, "--observations", table, "--late", ledger]) == 0
    mend = ["repair-cells", "--observations", table, "--late", ledger, "--repairs", repairs]
    assert main(mend) == 0 and main(mend) == 0
    counts = {h: r.aircraft_count for (_, h), r in by_key(read_cell_hours(spark, hours, repairs)).items()}
    assert counts == {0: 12, 5: 6}
