"""Plans of the reports over raw rows: how often the table is read and what is not in the plan."""

from __future__ import annotations

from datetime import timedelta

import pytest

from cellhours.operators import analysis, coverage, evaluation
from cellhours.schemas import OBSERVATIONS
from tests.conftest import EAST, T0, observations, report, traffic


def text_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    """Reports of four discs, one aircraft in two of them, one without an address, and a gap."""
    path = str(tmp_path / "reports")
    rows = traffic(range(3), lambda _: 0.4) + traffic([7], lambda _: 0.0, EAST, 2, "e")
    at = T0 + timedelta(hours=1, minutes=7)
    rows += [report("v-1", 9, at, disc="d1"), report("v-1", 9, at, disc="d2")]
    rows += [report(None, 1, at, disc="d3"), report("low", 1, at, altitude=900.0, disc="d4")]
    observations(spark, rows).write.parquet(path)
    return spark.read.schema(OBSERVATIONS).parquet(path)


def test_coverage_reads_once_and_expands_nothing(stored):
    table = coverage.slot_coverage(stored)
    plan = text_of(table)
    assert plan.count("FileScan") == 1 and "Expand" not in plan and "Join" not in plan
    got = [(r.slot_start.hour, r.observations, r.aircraft, r.points) for r in table.collect()]
    gaps = [(h, 0, 0, 0) for h in range(3, 7)]
    assert got == [(0, 10, 10, 1), (1, 14, 12, 5), (2, 10, 10, 1), *gaps, (7, 2, 2, 1)]


def test_floor_audit_reads_once(stored):
    table = analysis.floor_audit(stored)
    plan = text_of(table)
    assert plan.count("FileScan") == 1 and "Expand" not in plan and "Join" not in plan
    got = {r.sample_point: (r.cell_hours, r.dropped, r.degraded_rate) for r in table.collect()}
    home = {d: (1, 0, 1.0) for d in ("d1", "d2", "d3")}
    assert got == {"d0": (4, 1, 0.75), **home}


def test_split_gathers_no_list_of_hours(spark):
    hours = [h for h in range(100) if h % 7]
    rows = [("a", T0 + timedelta(hours=h)) for h in hours for _ in range(2)]
    features = spark.createDataFrame(rows, "h3_cell string, slot_start timestamp")
    split = evaluation.chrono_split(features)
    assert "collect_set" not in text_of(split) and "collect_list" not in text_of(split)
    first, second = hours[-(-len(hours) * 70 // 100) - 1], hours[-(-len(hours) * 85 // 100) - 1]
    parts = {(r.slot_start.day - 1) * 24 + r.slot_start.hour: r.segment for r in split.collect()}
    assert {h for h, s in parts.items() if s == "test"} == {h for h in hours if h > second}
    tested = {h for h, s in parts.items() if s == "validation"}
    assert min(tested) == min(h for h in hours if h > first) and max(tested) <= second
    assert evaluation.chrono_split(features.limit(0)).count() == 0


