from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from cellhours.operators import coverage, health
from tests.conftest import T0, observations, report, traffic
from tests.test_store import run_log, run_row


def watchdog(spark, rows, now):
    return coverage.capture_watchdog(observations(spark, rows), F.lit(now)).first()


def test_watchdog_fresh_stale_empty_and_exactly_at_the_limit(spark):
    now = datetime(2025, 3, 2, 8, 45, tzinfo=UTC)
    at = now.replace(minute=0)
    assert watchdog(spark, [report("a", 8, at)], now).healthy
    stale = watchdog(spark, [report("a", 8, at - timedelta(hours=7))], now)
    assert stale.problem == "newest captured hour is 7.8 h old: capture is behind"
    empty = watchdog(spark, [], now)
    assert not empty.healthy and empty.problem == "no observations in the raw table"
    assert empty.lag_hours is None
    assert watchdog(spark, [report("a", 8, at)], at + timedelta(hours=2)).healthy
    assert not watchdog(spark, [report("a", 8, at)], at + timedelta(hours=2, seconds=1)).healthy


def test_coverage_shows_gaps_as_zeros_and_counts_all_altitudes(spark):
    rows = traffic([0], lambda _: 0, vehicles=3) + traffic([3], lambda _: 0, vehicles=2)
    rows += [dict(r, sample_point="d1") for r in traffic([3], lambda _: 0, vehicles=2)]
    rows += [report("low", 8, T0, altitude=None)]
    table = coverage.slot_coverage(observations(spark, rows))
    got = [(r.slot_start.hour, r.observations, r.aircraft, r.points) for r in table.collect()]
    assert got == [(0, 4, 4, 1), (1, 0, 0, 0), (2, 0, 0, 0), (3, 4, 2, 2)]
    gaps = coverage.gap_report(table).collect()
    assert [(str(r.date), r.missing_hours, r.hours) for r in gaps] == [("2026-10-01", 2, "01,02")]
    share = coverage.completeness(table).first()
    assert (share.observed_hours, share.expected_hours, share.completeness) == (2, 4, 0.5)


def test_coverage_of_nothing_is_empty(spark):
    nothing = observations(spark, [])
    assert coverage.slot_coverage(nothing).count() == 0
    assert coverage.history_stats(nothing).first().latest_slot is None


def edges(spark, outcomes):
    """Edges of (hour, ok, status, error) sweeps."""
    rows = [run_row(f"r{h:04d}", h, status, ok, error) for h, ok, status, error in outcomes]
    table = health.health_transitions(run_log(spark, rows)).orderBy("slot_start")
    return table.collect()


def test_an_edge_for_each_outage_and_none_in_between(spark):
    """Two outages over midnight and noon, the second without a single answer at its begin."""
    healthy = [(h, 18, "ok", None) for h in (20, 21, 26, 27, 35, 40)]
    night = [(22, 6, "partial", "p3 refused"), (23, 2, "partial", None), (25, 0, "failed", None)]
    noon = [(36, 0, "failed", None), (38, 5, "partial", "p1 slow")]
    got = edges(spark, sorted(healthy + night + noon))
    hours = [(r.slot_start.replace(tzinfo=UTC) - T0) // timedelta(hours=1) for r in got]
    assert [(h, r.transition) for h, r in zip(hours, got, strict=True)] == [
        (22, "degraded"), (26, "recovered"), (36, "degraded"), (40, "recovered")
    ]
    assert [r.priority for r in got] == ["high", "default", "urgent", "default"]
    assert got[0].body.endswith("Error: p3 refused") and "22:00" in got[0].body
    assert "since 2026-10-02 12:00 UTC" in got[3].body


def test_a_sweep_whose_rows_were_lost_is_no_healthy_one(spark):
    """All discs answered, but the last write did not succeed, in the middle of a good day."""
    rows = [(5, 18, "ok", None), (6, 18, "failed", "disk full while storing"), (9, 18, "ok", None)]
    assert [(r.transition, r.slot_start.hour) for r in edges(spark, rows)] == [
        ("degraded", 6), ("recovered", 9)
    ]


def test_running_sweeps_have_no_outcome_yet(spark):
    assert edges(spark, [(0, 18, "ok", None), (1, 0, "running", None)]) == []


def test_edges_across_day_blocks_equal_a_plain_walk(spark):
    """Long outages, whole days without a sweep, and edges at midnight."""
    rng = random.Random(3)
    outcomes, state = [], True
    for h in range(24 * 30):
        if h // 24 in {4, 5, 17}:
            continue
        if rng.random() < 0.04 or h % 24 == 0 and rng.random() < 0.4:
            state = not state
        outcomes.append((h, 18 if state else 9, "ok" if state else "partial", None))
    expected, was, since = [], True, None
    for h, _, status, _ in outcomes:
        now = status == "ok"
        if now != was:
            since = since if now else h
            expected.append((h, now, since))
        was = now
    got = [
        (
            (r.slot_start.replace(tzinfo=UTC) - T0) // timedelta(hours=1),
            r.transition == "recovered",
            (r.degraded_since.replace(tzinfo=UTC) - T0) // timedelta(hours=1),
        )
        for r in edges(spark, outcomes)
    ]
    assert got == expected and len(got) > 20
