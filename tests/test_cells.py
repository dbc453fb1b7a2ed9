from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cellhours import Rules
from cellhours.operators import cells
from cellhours.sources.runs import sweep_status, with_broken_answers
from cellhours.sources.snapshots import (
    broken_answers,
    flatten_snapshots,
    parse_bodies,
    snapshot_cells,
)
from tests.conftest import EAST, EAST_CELL, HOME_CELL, T0, observations, report, traffic

BODY = """{"now": 1, "ac": [%s]}"""


def feed(spark, *aircraft, at=T0):
    row = (at, "d0", False, "run", BODY % ", ".join(aircraft))
    schema = (
        "observed_at timestamp, sample_point string, is_control_region boolean, "
        "ingest_run_id string, body string"
    )
    return parse_bodies(spark.createDataFrame([row], schema))


def plane(hex_, alt="35000", nic="8", lat="52.0", extra=""):
    parts = [f'"hex": "{hex_}"', '"lon": 10.0', f'"lat": {lat}']
    parts += [f'"alt_baro": {alt}'] if alt else []
    parts += [f'"nic": {nic}'] if nic else []
    return "{" + ", ".join(parts) + extra + "}"


@pytest.mark.parametrize(
    ("spelling", "feet"),
    [
        ("35000", 35000.0),
        ("1200.5", 1200.5),
        ("0", 0.0),
        ('"ground"', None),
        ('"35000"', None),
        ("null", None),
        ("true", None),
        ("", None),
    ],
)
def test_altitude_spellings(spark, spelling, feet):
    rows = flatten_snapshots(feed(spark, plane("a", alt=spelling))).collect()
    assert [r.altitude_ft for r in rows] == [feet]


def test_storage_keeps_everything_with_position_and_nic(spark):
    envelope = feed(
        spark,
        plane("zero", nic="0"),
        plane("absent", nic=""),
        plane("nowhere", lat="null"),
        plane("low", alt="900"),
        plane("ground", alt='"ground"'),
        plane("rich", extra=', "nac_p": 10, "sil": 3, "t": "A320"'),
    )
    rows = {r.hex: r for r in flatten_snapshots(envelope).collect()}
    assert set(rows) == {"zero", "low", "ground", "rich"}
    assert rows["zero"].nic == 0 and rows["zero"].nac_p is None
    assert (rows["rich"].nac_p, rows["rich"].sil, rows["rich"].aircraft_type) == (10, 3, "A320")
    live = flatten_snapshots(envelope, cruise_only=True).collect()
    assert {r.hex for r in live} == {"zero", "rich"}


def test_live_path_gives_cell_rows(spark):
    envelope = feed(spark, *[plane(f"a{i}", nic="2" if i < 3 else "8") for i in range(10)])
    rows = snapshot_cells(envelope).collect()
    assert [(r.h3_cell, r.aircraft_count, r.is_degraded) for r in rows] == [(HOME_CELL, 10, 1)]


def test_slots_begin_on_the_hour_across_days_and_years(spark):
    """Every eleventh minute around New Year and a leap day, and the last microseconds of both."""
    starts = [datetime(2027, 12, 31, 21, tzinfo=UTC), datetime(2028, 2, 28, 22, tzinfo=UTC)]
    times = [s + timedelta(minutes=11 * i, microseconds=i) for s in starts for i in range(40)]
    times += [s.replace(hour=23, minute=59, second=59, microsecond=999_999) for s in starts]
    rows = [report(f"a{i}", 8, at) for i, at in enumerate(times)]
    found = {r.hex: r.slot_start for r in cells.with_slot(observations(spark, rows)).collect()}
    for i, at in enumerate(times):
        past = timedelta(minutes=at.minute, seconds=at.second, microseconds=at.microsecond)
        assert found[f"a{i}"].replace(tzinfo=UTC) == at - past


def test_a_broken_answer_is_taken_as_a_whole(spark):
    good = BODY % ", ".join([plane("a"), plane("b").replace('"hex": "b", ', "")])
    wrong = BODY % ", ".join([plane("c"), plane("d", lat='"north"')])
    bodies = [good, good[:-4], "", "not json", wrong, None, '{"now": 2}', '{"now": 2, "ac": []}']
    rows = [(T0, f"d{i}", False, "run", b) for i, b in enumerate(bodies)]
    schema = "observed_at timestamp, sample_point string, is_control_region boolean, ingest_run_id string, body string"
    parsed = parse_bodies(spark.createDataFrame(rows, schema))
    assert sorted(r.hex for r in flatten_snapshots(parsed).collect()) == ["", "a"]
    unread = broken_answers(parsed)
    assert {r.sample_point: r.broken for r in unread.collect()} == {"d1": 1, "d2": 1, "d3": 1, "d4": 1}
    polls = [("run", i, f"d{i}", i != 5, "timeout" if i == 5 else None) for i in range(8)]
    table = spark.createDataFrame(polls, "run_id string, seq int, sample_point string, ok boolean, error string")
    planned = spark.createDataFrame([("run", T0, 8)], "run_id string, slot_start timestamp, points_attempted int")
    sweep = sweep_status(with_broken_answers(table, unread), planned).first()
    assert (sweep.status, sweep.points_succeeded) == ("partial", 3)
    assert sweep.error == "answer of d1 could not be read"


def test_slot_floor_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")  # half an hour off
    try:
        rows = observations(spark, [report("a", 8, T0 + timedelta(minutes=40))])
        seconds = cells.with_slot(rows).select(F.unix_seconds("slot_start")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == int(T0.timestamp())


def test_traffic_floor_drops_thin_cells(spark):
    rows = traffic([0], lambda _: 0) + traffic([1], lambda _: 0, vehicles=4) + traffic([2], lambda _: 0, vehicles=5)
    hours = [r.slot_start.hour for r in cells.cell_hourly(observations(spark, rows)).collect()]
    assert sorted(hours) == [0, 2]
    all_hours = cells.cell_hourly(observations(spark, rows), traffic_floor=False)
    assert all_hours.count() == 3


@pytest.mark.parametrize(("degraded", "label"), [(2, 0), (3, 1), (4, 1)])
def test_label_boundary_is_inclusive(spark, degraded, label):
    row = cells.cell_hourly(observations(spark, traffic([0], lambda _: degraded / 10))).first()
    assert (row.degraded_share, row.is_degraded) == (degraded / 10, label)


def test_an_aircraft_counts_once_at_its_worst(spark):
    at = T0 + timedelta(minutes=1)
    rows = traffic([0], lambda _: 0, vehicles=5)
    rows += [report("v-0", nic, at + timedelta(minutes=m), disc=d)
             for m, (nic, d) in enumerate([(8, "d1"), (3, "d2"), (9, "d1"), (3, "d1")])]
    row = cells.cell_hourly(observations(spark, rows)).first()
    assert row.aircraft_count == 5
    assert row.degraded_share == 0.2
    assert row.median_nic == 9.0


def test_quantiles_are_linear(spark):
    at = T0 + timedelta(minutes=1)
    rows = [report(f"a{i}", nic, at) for i, nic in enumerate([0, 1, 5, 8, 9, 11])]
    row = cells.cell_hourly(observations(spark, rows)).first()
    assert row.median_nic == 6.5
    assert row.p25_nic == 2.0


def test_nac_p_is_the_first_known_in_nic_order(spark):
    at = T0 + timedelta(minutes=1)
    rows = [
        report("a", 2, at, nac_p=None),
        report("a", 4, at + timedelta(minutes=2), nac_p=7),
        report("a", 4, at + timedelta(minutes=1), nac_p=10),
        report("a", 9, at, nac_p=1),
        report("b", 9, at, nac_p=None),
        report("c", 5, at, nac_p=9, disc="d1"),  # two discs at one instant: the lower NACp
        report("c", 5, at, nac_p=7, disc="d2"),
        report(None, 0, at),
    ]
    located = cells.assign_cells(observations(spark, rows))
    lean = {r.hex: (r.nic, r.nac_p) for r in cells.worst_reports(located).collect()}
    full = {r.hex: (r.nic, r.nac_p) for r in cells.worst_report_rows(located).collect()}
    assert lean == full == {"a": (2, 10), "b": (9, None), "c": (5, 7)}


def test_negative_nic_and_wide_slots_keep_their_order(spark):
    rows = [
        report("a", -1, T0 + timedelta(hours=23), nac_p=4),
        report("a", 0, T0, nac_p=5),
        report("a", -1, T0 + timedelta(hours=2), nac_p=6),
    ]
    rules = Rules(slot_minutes=24 * 60)
    located = cells.assign_cells(observations(spark, rows), rules)
    row = cells.worst_reports(located, rules=rules).first()
    assert (row.nic, row.nac_p) == (-1, 6)


def test_distinct_cells_and_altitude_rules(spark):
    rows = traffic([0], lambda _: 0) + traffic([0], lambda _: 0.9, place=EAST, tag="e")
    rows += [
        report(f"low{i}", 0, T0, altitude=a) for i, a in enumerate([19_999.0, None, 0.0])
    ]
    got = {r.h3_cell: r for r in cells.cell_hourly(observations(spark, rows)).collect()}
    assert set(got) == {HOME_CELL, EAST_CELL}
    assert got[HOME_CELL].aircraft_count == 10 and got[EAST_CELL].degraded_share == 0.9


def test_own_cell_ids_can_be_brought(spark):
    rows = observations(spark, traffic([0], lambda _: 0.3)).withColumn("h3_cell", F.lit("821f1ffffffffff"))
    assert cells.aggregate_cells(rows).first().h3_cell == "821f1ffffffffff"


def test_copies_of_one_report_change_nothing(spark):
    """A third of all rows are copies of one report; the plan reduces them before the shuffle."""
    rows = observations(spark, traffic([0], lambda _: 0.3))
    many_times = F.explode(F.sequence(F.lit(1), F.lit(5_000)))
    copies = rows.filter("hex = 'a00000'").withColumn("n", many_times).drop("n")
    once, many = cells.cell_hourly(rows), cells.cell_hourly(rows.unionByName(copies))
    assert once.collect() == many.collect()
