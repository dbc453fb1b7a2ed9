from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cellhours.operators import quality
from cellhours.operators.features import build_features
from cellhours.plans.build import run_feature_build
from cellhours.schemas import INGEST_RUNS
from cellhours.sources import feature_store, legacy, runs
from cellhours.sources import observations as store
from tests.conftest import T0, cell_rows, observations, report, traffic

NOW = datetime(2026, 10, 3, tzinfo=UTC)


def test_read_applies_floor_and_inclusive_bounds(spark):
    rows = observations(
        spark,
        [report(f"a{i}", 8, T0, altitude=a) for i, a in enumerate([19_999.0, 20_000.0, None])]
        + [report("late", 8, T0 + timedelta(hours=h)) for h in (1, 2, 3)],
    )
    cruise = store.read_observations(rows)
    assert [r.hex for r in cruise.collect()] == ["a1", "late", "late", "late"]
    assert len(cruise.columns) == 12
    assert store.read_observations(rows, cruise_only=False).count() == 6
    ranged = store.read_observations(rows, T0 + timedelta(hours=1), T0 + timedelta(hours=2))
    assert ranged.count() == 2
    assert store.read_observations(rows, start=NOW).count() == 0


def test_append_skips_stored_keys_and_repeats(spark, tmp_path):
    table = str(tmp_path / "observations")
    first = traffic([0], lambda _: 0.3)
    assert store.append_if_absent(observations(spark, first + first), table) == 10
    again = first + traffic([30], lambda _: 0)
    assert store.append_if_absent(observations(spark, again), table) == 10
    assert store.append_if_absent(observations(spark, again), table) == 0
    assert store.append_if_absent(observations(spark, []), table) == 0
    assert store.stored_observations(spark, table).count() == 20
    # The same aircraft seen by an overlapping disc is another row.
    other = [dict(r, sample_point="d1") for r in first]
    assert store.append_if_absent(observations(spark, other), table) == 10


def test_reads_prune_date_folders(spark, tmp_path):
    table = str(tmp_path / "observations")
    store.append_if_absent(
        observations(spark, traffic([0], lambda _: 0) + traffic([30], lambda _: 0)), table
    )
    ranged = store.read_observations(
        store.stored_observations(spark, table), T0 + timedelta(hours=24), ordered=False
    )
    assert len(ranged.inputFiles()) >= 1 and ranged.count() == 10
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "slot_date" in partition_filters and "PushedFilters: [IsNotNull" in plan


def test_a_missing_table_reads_as_empty(spark, tmp_path):
    assert store.stored_observations(spark, str(tmp_path / "none")).count() == 0
    assert legacy.load_legacy(spark, str(tmp_path / "none")).count() == 0


def test_legacy_import_is_repeatable(spark, tmp_path):
    at = T0 + timedelta(minutes=10)
    rows = observations(
        spark, [report("a", 8, at), report("a", 2, at), report("b", 7, at, nac_p=None)]
    )
    old = rows.drop("slot_start", "ingest_run_id", "aircraft_type").withColumn(
        "date", F.to_date("observed_at")
    )
    root, table = str(tmp_path / "legacy"), str(tmp_path / "observations")
    old.write.partitionBy("date").parquet(root)
    prepared = legacy.to_observations(legacy.load_legacy(spark, root))
    got = {r.hex: r for r in prepared.collect()}
    assert got["a"].nic == 2, "the worst of two equal keys stays"
    assert got["b"].nac_p is None and got["b"].aircraft_type is None
    assert got["a"].ingest_run_id == "legacy-parquet-20261001T00"
    assert legacy.import_legacy(spark, root, table, dry_run=True) == 0
    assert legacy.import_legacy(spark, root, table) == 2
    assert legacy.import_legacy(spark, root, table) == 0
    summary = legacy.import_summary(prepared, store.stored_observations(spark, table)).first()
    assert (summary.prepared, summary.inserted, summary.already_present) == (2, 0, 2)


def run_row(run_id, hour, status, ok=18, error=None, seq=0, finished=True):
    start = T0 + timedelta(hours=hour)
    return (
        seq, run_id, start + timedelta(minutes=seq), start if finished else None, start, 18, ok,
        100, status, error,
    )


def run_log(spark, rows):
    return spark.createDataFrame(rows, f"seq int, {INGEST_RUNS.simpleString()[7:-1]}".replace(":", " "))


def test_run_state_folds_records_in_any_order(spark):
    """Three sweeps of one, two and four records, told by their number and not by their place."""
    records = [
        run_row("swept", 9, "ok", ok=18, seq=8),
        run_row("open", 11, "running", ok=0, finished=False),
        run_row("swept", 9, "running", ok=3, seq=2, finished=False),
        run_row("lost", 10, "failed", ok=0, error="host away", seq=1),
        run_row("swept", 9, "running", ok=0, seq=1, finished=False),
        run_row("lost", 10, "running", ok=0, finished=False),
        run_row("swept", 9, "partial", ok=12, error="p5 mute", seq=6),
    ]
    got = {r.run_id: r for r in runs.run_state(run_log(spark, records)).collect()}
    assert {k: (r.status, r.points_succeeded, r.error) for k, r in got.items()} == {
        "swept": ("ok", 18, None), "open": ("running", 0, None), "lost": ("failed", 0, "host away")
    }
    assert [got[k].started_at.minute for k in ("swept", "open", "lost")] == [1, 0, 0]
    assert got["open"].finished_at is None and got["swept"].finished_at is not None


def test_stale_runs_are_closed_once(spark):
    state = runs.run_state(
        run_log(
            spark,
            [
                run_row("old", 0, "running", finished=False),
                run_row("told", 0, "running", error="disk full", finished=False),
                run_row("live", 5, "running", finished=False),
                run_row("done", 0, "ok"),
            ],
        )
    )
    now = F.lit(T0 + timedelta(hours=5, minutes=30))
    once = runs.close_stale_runs(state, now)
    got = {r.run_id: r for r in once.collect()}
    assert {k: r.status for k, r in got.items()} == {
        "old": "abandoned", "told": "abandoned", "live": "running", "done": "ok"
    }
    assert got["old"].finished_at - got["old"].started_at == timedelta(minutes=20)
    assert got["told"].error == "disk full" and got["old"].error == runs.ABANDONED_NOTE
    assert sorted(runs.close_stale_runs(once, now).collect()) == sorted(got.values())


def test_sweep_status(spark):
    polls = [("ok", i, True, None, None) for i in range(3)]
    polls += [("part", 0, True, None, None), ("part", 2, False, "late", None)]
    polls += [("part", 1, False, "first", None)]
    polls += [("none", i, False, f"e{i}", None) for i in range(2)]
    polls += [("lost", i, True, None, "no disk") for i in range(2)]
    polls += [("cut", i, True, None, None) for i in range(2)]
    frame = spark.createDataFrame(
        polls, "run_id string, seq int, ok boolean, error string, write_error string"
    ).withColumn("slot_start", F.lit(T0))
    planned = [("ok", 3), ("part", 3), ("none", 2), ("lost", 2), ("cut", 9), ("idle", 4)]
    log = spark.createDataFrame(planned, "run_id string, points_attempted int")
    rows = runs.sweep_status(frame, log.withColumn("slot_start", F.lit(T0)), "write_error")
    got = {r.run_id: r for r in rows.collect()}
    assert {k: r.status for k, r in got.items()} == {
        "ok": "ok", "part": "partial", "none": "failed", "lost": "failed", "cut": "partial",
        "idle": "failed",
    }
    assert (got["cut"].points_attempted, got["cut"].points_succeeded) == (9, 2)
    assert (got["idle"].points_succeeded, got["idle"].error) == (0, None)
    assert (got["part"].error, got["none"].error, got["lost"].error) == ("first", "e0", "no disk")
    assert got["lost"].points_succeeded == 2


def history(hours=40, bad=lambda h: 4 if 10 <= h < 14 else 0):
    return [r for h in range(hours) for r in traffic([h], lambda _: bad(h) / 10)]


def test_every_build_is_logged_and_the_newest_is_read(spark, tmp_path):
    root = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        feature_store.read_features(spark, root)
    first = run_feature_build(observations(spark, history()), root, NOW, run_id="one")
    assert first.published and first.cell_slots == 40
    assert first.capture_problem == (
        "newest captured hour is 9.0 h old: capture is behind"
    )
    later = NOW + timedelta(hours=1)
    run_feature_build(observations(spark, history(30)), root, later, run_id="two")
    table = feature_store.read_features(spark, root)
    assert table.count() == 24
    assert {r.feature_run_id for r in table.select("feature_run_id").distinct().collect()} == {"two"}
    assert len(table.columns) == 38
    log = {r.run_id: r for r in feature_store.feature_runs(spark, root).collect()}
    assert set(log) == {"one", "two"}
    assert (log["one"].cell_slots, log["one"].labelled_rows) == (40, 34)
    assert log["one"].positive_rate == pytest.approx(4 / 34)
    ranged = feature_store.read_features(
        spark, root, T0 + timedelta(hours=2), T0 + timedelta(hours=5)
    )
    assert ranged.count() == 4


def test_a_refused_build_leaves_the_published_one(spark, tmp_path):
    root = str(tmp_path / "store")
    run_feature_build(observations(spark, history()), root, NOW, run_id="good")
    quiet = run_feature_build(
        observations(spark, history(bad=lambda h: 0)), root, NOW, run_id="quiet"
    )
    assert not quiet.published
    assert quiet.problems == ["positive rate 0.000 outside the plausible 0.5-50% band"]
    empty = run_feature_build(observations(spark, []), root, NOW, run_id="empty")
    assert not empty.published and empty.capture_problem.startswith("no observations")
    short = run_feature_build(observations(spark, history(5)), root, NOW, run_id="short")
    assert "6 hours ahead" in short.problems[0]
    assert feature_store.newest_run(spark, root) == "good"
    assert feature_store.read_features(spark, root).count() == 34


def test_a_published_run_id_cannot_be_written_again(spark, tmp_path):
    root = str(tmp_path / "store")
    run_feature_build(observations(spark, history()), root, NOW, run_id="once")
    with pytest.raises(Exception, match="(?i)exists"):
        run_feature_build(observations(spark, history(30)), root, NOW, run_id="once")
    run_feature_build(observations(spark, history(30)), root, NOW, run_id="once", store=False)
    assert feature_store.read_features(spark, root).count() == 34


def test_a_null_in_a_key_is_stored_once(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = observations(spark, [report(None, 8, T0), report("a", 8, T0, disc=None)])
    assert [store.append_if_absent(rows, table) for _ in range(3)] == [2, 0, 0]


def test_export(spark, tmp_path):
    out = str(tmp_path / "out")
    result = run_feature_build(
        observations(spark, history()), str(tmp_path / "s"), NOW, export_to=out, store=False
    )
    assert not result.published and not result.problems
    assert spark.read.parquet(out).count() == 34


class TestGate:
    def good(self, spark):
        return build_features(cell_rows(spark, {h: 0.9 if h % 5 == 0 else 0.0 for h in range(40)}))

    def test_a_good_table_passes(self, spark):
        assert quality.problems(self.good(spark)) == []
        assert quality.validate_features(self.good(spark)).count() == 20

    @pytest.mark.parametrize(
        ("column", "sql", "message"),
        [
            ("target_is_degraded", "2", "target is not binary"),
            ("degraded_share_lag_2h", "1.2D", "degraded_share_lag_2h outside [0, 1]"),
            ("nbr_degraded_share_max", "-0.1D", "nbr_degraded_share_max outside [0, 1]"),
            ("aircraft_count", "4", "row below the traffic floor"),
            (
                "degraded_share",
                "cast(null as double)",
                "current-slot degraded_share missing on a training row",
            ),
        ],
    )
    def test_one_bad_row_is_found(self, spark, column, sql, message):
        bad = self.good(spark).withColumn(
            column, F.expr(f"if(hour_utc = 3 AND day_of_week = 3, {sql}, {column})")
        )
        assert quality.problems(bad) == [message]

    def test_a_falling_neighbour_share_is_fine(self, spark):
        falling = self.good(spark).withColumn("nbr_degraded_share_delta_3h", F.lit(-0.5))
        assert quality.problems(falling) == []

    def test_duplicates(self, spark):
        twice = self.good(spark).unionByName(self.good(spark))
        assert quality.problems(twice) == ["duplicate (h3_cell, slot_start) keys"]

    def test_an_empty_table_fails(self, spark):
        found = quality.problems(self.good(spark).filter("false"))
        assert found == ["positive rate nan outside the plausible 0.5-50% band"]
