from __future__ import annotations

import json
from datetime import timedelta


from cellhours.operators.cells import cell_hourly
from cellhours.operators.health import health_transitions
from cellhours.schemas import OBSERVATIONS
from cellhours.sources.observations import stored_observations
from cellhours.sources.runs import run_state
from cellhours.streaming.capture import snapshot_stream, start_capture
from cellhours.streaming.cells import start_cell_hourly
from cellhours.streaming.health import emit_new_edges, start_health
from tests.conftest import T0, observations, report, traffic
from tests.test_store import run_log, run_row


def land(folder, name, hour, aircraft):
    folder.mkdir(exist_ok=True)
    at = (T0 + timedelta(hours=hour, minutes=3)).isoformat()
    envelope = {
        "observed_at": at, "sample_point": "d0", "is_control_region": False,
        "ingest_run_id": "run", "body": {"now": 1, "ac": aircraft},
    }
    (folder / name).write_text(json.dumps(envelope) + "\n")


def test_capture_is_idempotent_and_keeps_altitude_rules(spark, tmp_path):
    landing, table, state = tmp_path / "landing", str(tmp_path / "t"), str(tmp_path / "s")
    seen = [
        {"hex": f"a{i}", "lat": 52.0, "lon": 10.0, "nic": i, "alt_baro": alt, "t": "A320"}
        for i, alt in enumerate([35000, "ground", None, 0, 1200.5])
    ]
    seen += [{"hex": "nonic", "lat": 52.0, "lon": 10.0}]

    def run():
        start_capture(snapshot_stream(spark, str(landing)), table, state).awaitTermination()
        return stored_observations(spark, table)

    land(landing, "one.json", 0, seen)
    stored = {r.hex: r.altitude_ft for r in run().collect()}
    assert stored == {"a0": 35000.0, "a1": None, "a2": None, "a3": 0.0, "a4": 1200.5}
    land(landing, "replay.json", 0, seen)
    assert run().count() == 5
    land(landing, "two.json", 1, seen)
    assert run().count() == 10


def test_capture_keeps_late_reports_whatever_the_trigger_size(spark, tmp_path):
    landing = tmp_path / "landing"
    for i, hour in enumerate([7, 0, 30, 2, 7]):  # out of order, hours apart, one repeated
        seen = [{"hex": f"h{hour}-{k}", "lat": 52.0, "lon": 10.0, "nic": k} for k in range(3)]
        land(landing, f"{i}.json", hour, seen)
    counts = []
    for size in (1, 1000):
        table, state = str(tmp_path / f"t{size}"), str(tmp_path / f"s{size}")
        stream = snapshot_stream(spark, str(landing), files_per_trigger=size)
        start_capture(stream, table, state).awaitTermination()
        counts.append(stored_observations(spark, table).count())
    assert counts == [12, 12]


def test_stream_equals_batch_on_closed_hours(spark, tmp_path):
    source, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [r for h in range(8) if h != 3 for r in traffic([h], lambda _: h % 5 / 10)]
    rows += [report("a00000", 1, T0 + timedelta(hours=2, minutes=40), disc="d1")]
    closing = [report("z", 8, T0 + timedelta(hours=9))]
    observations(spark, rows).write.parquet(source)

    def run():
        stream = spark.readStream.schema(OBSERVATIONS).parquet(source)
        start_cell_hourly(stream, table, state).awaitTermination()
        return spark.read.parquet(table)

    run()
    observations(spark, closing).write.mode("append").parquet(source)
    streamed = run().orderBy("slot_start").collect()
    batch = cell_hourly(observations(spark, rows)).orderBy("slot_start").collect()
    assert streamed == batch and len(batch) == 7


def test_rows_behind_the_watermark_are_left_to_the_batch(spark, tmp_path):
    source, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run(rows):
        observations(spark, rows).write.mode("append").parquet(source)
        stream = spark.readStream.schema(OBSERVATIONS).parquet(source)
        start_cell_hourly(stream, table, state).awaitTermination()
        return spark.read.parquet(table)

    run(traffic([0], lambda _: 0) + traffic([5], lambda _: 0))
    late = run(traffic([0], lambda _: 1, tag="late") + traffic([9], lambda _: 0))
    first = [r for r in late.collect() if r.slot_start.hour == 0]
    assert [(r.aircraft_count, r.degraded_share) for r in first] == [(10, 0.0)]


def test_edges_arrive_once(spark, tmp_path):
    source, log, alerts, state = (str(tmp_path / n) for n in ("in", "log", "alerts", "state"))
    rows = [run_row(f"r{h}", h, s, ok) for h, (s, ok) in enumerate(
        [("ok", 18), ("partial", 14), ("failed", 0), ("ok", 18), ("failed", 0)]
    )]

    def run(part):
        frame = run_log(spark, part)
        frame.write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame.schema).parquet(source)
        start_health(stream, log, alerts, state).awaitTermination()
        return spark.read.parquet(alerts).orderBy("slot_start")

    assert run(rows[:2]).count() == 1
    run(rows[:2])
    got = run(rows[2:]).collect()
    expected = health_transitions(run_state(run_log(spark, rows))).orderBy("slot_start").collect()
    assert got == expected and len(got) == 3


def test_edges_over_days_equal_the_batch_and_read_one_state(spark, tmp_path):
    """Batches of a day or two, replays, and a sweep that ends days late."""
    log, alerts = str(tmp_path / "log"), str(tmp_path / "alerts")
    outcome = {5: "failed", 6: "partial", 30: "ok", 31: "failed", 80: "failed", 103: "ok"}
    records = []
    for hour in range(0, 110, 1):
        status = outcome.get(hour, "failed" if 31 < hour < 103 or 6 < hour < 30 else "ok")
        good = 18 if status == "ok" else 0
        records.append(run_row(f"r{hour:03d}", hour, "running", 0, seq=0, finished=False))
        records.append(run_row(f"r{hour:03d}", hour, status, good, seq=1))
    late = [r for r in records if r[1] == "r050" and r[0] == 1]
    rest = [r for r in records if r not in late]
    cuts = [0, 20, 60, 61, 130, len(rest)]
    batches = [rest[a:b] for a, b in zip(cuts, cuts[1:])]
    for part in [*batches, batches[2], late, late]:
        emit_new_edges(run_log(spark, part), log, alerts)
    got = spark.read.parquet(alerts).orderBy("slot_start").collect()
    batch = health_transitions(run_state(run_log(spark, records)))
    assert got == batch.orderBy("slot_start").collect() and len(got) == 4
    since = {r.degraded_since for r in got if r.transition == "recovered"}
    assert since == {r.slot_start for r in got if r.transition == "degraded"}
    days = {str(r.slot_date): r.outage_since for r in spark.read.parquet(f"{log}_days").collect()}
    assert len(days) == 5 and days["2026-10-05"] is None
    assert days["2026-10-01"] == got[0].slot_start and days["2026-10-04"] == got[2].slot_start


def test_edges_of_a_day_do_not_read_the_days_before(spark, tmp_path):
    """The log of the earlier days is gone; the state at their end is enough."""
    log, alerts = str(tmp_path / "log"), str(tmp_path / "alerts")
    emit_new_edges(run_log(spark, [run_row("a", 3, "failed", 0)]), log, alerts)
    (tmp_path / "log" / "slot_date=2026-10-01").rename(tmp_path / "put-away")
    emit_new_edges(run_log(spark, [run_row("b", 30, "partial", 9), run_row("c", 31, "ok")]), log, alerts)
    last = spark.read.parquet(alerts).orderBy("slot_start").collect()
    assert [r.transition for r in last] == ["degraded", "recovered"]
    assert last[1].degraded_since == last[0].slot_start


def test_an_empty_batch_of_records_changes_nothing(spark, tmp_path):
    log, alerts = tmp_path / "log", tmp_path / "alerts"
    emit_new_edges(run_log(spark, []), str(log), str(alerts))
    assert not log.exists() and not alerts.exists()
