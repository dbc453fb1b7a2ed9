from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from cellhours.__main__ import main
from cellhours.schemas import LANDED_TEXT
from cellhours.sources import commits, feature_store
from cellhours.sources import observations as store
from cellhours.sources.snapshots import parse_bodies
from tests.conftest import EAST, T0, observations, traffic
from tests.test_store import history, run_log, run_row


def test_jobs_from_import_to_report(spark, tmp_path, capsys):
    raw, table, root, out = (str(tmp_path / n) for n in ("legacy", "table", "store", "out"))
    old = observations(spark, history()).drop("slot_start", "ingest_run_id")
    old.withColumn("date", F.to_date("observed_at")).write.partitionBy("date").parquet(raw)

    bring = ["import-legacy", "--raw-root", raw, "--observations", table]
    assert main([*bring, "--dry-run"]) == 0
    assert store.stored_observations(spark, table).count() == 0
    assert main(bring) == 0 and main(bring) == 0
    assert store.stored_observations(spark, table).count() == 400

    build = ["features", "--observations", table, "--store", root, "--now", "2026-10-03"]
    assert main([*build, "--no-store", "--out", out]) == 0
    assert spark.read.parquet(out).count() == 34
    assert feature_store.newest_run(spark, root) is None
    assert main(build) == 0
    assert feature_store.newest_run(spark, root).startswith("features-20261003T000000Z-")

    log = str(tmp_path / "log")
    run_log(spark, [run_row("r0", 0, "ok"), run_row("r1", 1, "failed", 0)]).write.parquet(log)
    assert main(["report", "--observations", table, "--run-log", log]) == 0
    printed = capsys.readouterr().out
    assert "expected_hours" in printed and "urgent" in printed


def test_a_build_without_data_fails(spark, tmp_path):
    args = ["features", "--observations", str(tmp_path / "none"), "--store", str(tmp_path / "s")]
    assert main(args) == 1


def test_capture_incremental_build_and_clean_up(spark, tmp_path):
    landing, text, table, root, state = (
        str(tmp_path / n) for n in ("landing", "text", "table", "store", "state")
    )
    planes = [
        '{"hex": "v%d", "lat": 52.0, "lon": 10.0, "alt_baro": 35000, "nic": %d}' % (i, n)
        for i, n in enumerate([2] * 4 + [9] * 6)
    ]
    good = '{"now": 1, "ac": [' + ", ".join(planes) + "]}"
    rows = [
        (T0 + timedelta(hours=h), "d0", False, f"run-{h}", good if h % 5 else good.replace('"nic": 2', '"nic": 9'))
        for h in range(40)
    ]
    answers = spark.createDataFrame(rows, LANDED_TEXT)
    parse_bodies(answers.limit(30)).drop("broken").write.json(landing)
    take = ["capture", "--landing", landing, "--observations", table, "--checkpoint", state]
    assert main(take) == 0 and main(take) == 0
    assert store.stored_observations(spark, table).count() == 300
    broken = answers.selectExpr(*answers.columns[:-1], "if(ingest_run_id = 'run-39', left(body, 50), body) AS body")
    broken.write.json(text)
    assert main(["import-landed", "--landing", text, "--observations", table]) == 1
    assert store.stored_observations(spark, table).count() == 390
    build = ["features", "--observations", table, "--store", root, "--incremental", "--now"]
    out = str(tmp_path / "out")
    assert main([*build, "2026-10-03", "--out", out]) == 1  # most rows are positive: refused
    assert feature_store.newest_run(spark, root) is None
    quiet = observations(spark, traffic(range(40), lambda h: 0.6 if h == 20 else 0, place=EAST, tag="e"))
    more = observations(spark, traffic(range(40), lambda h: 0, vehicles=12, tag="w"))
    store.append_if_absent(quiet.unionByName(more), table)
    assert main([*build, "2026-10-04", "--out", out]) == 0
    assert spark.read.parquet(out).count() == feature_store.read_features(spark, root).count() > 60
    assert main(["clean", "--store", root, "--keep", "1"]) == 0
    assert len(commits.children(spark, f"{root}/cell_hourly_features")) == 1
    assert feature_store.read_features(spark, root).count() > 60
