"""What an append moves: each report once, and nothing of slots that are stored already."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest

from cellhours.plans import registry
from cellhours.schemas import OBSERVATION_KEY, OBSERVATIONS
from cellhours.sources import appends, legacy
from cellhours.sources import observations as store
from cellhours.sources.commits import children
from cellhours.streaming import capture
from tests.conftest import T0, observations, report, traffic


def odd_rows():
    """Every field once NULL, the ends of the whole numbers, and a slot that is no hour."""
    at = T0 + timedelta(minutes=7)
    rows = [report("a", -32768, at, nac_p=32767, control=True), report("b", 32767, at, nac_p=-1)]
    for name in OBSERVATIONS.names:
        rows.append({**report(f"no-{name}", 3, at), name: None})
    rows.append({**report("half", 3, at), "slot_start": T0 + timedelta(minutes=30)})
    return rows


def as_set(df):
    return {tuple(r[c] for c in OBSERVATIONS.names) for r in df.collect()}


def test_reports_keep_every_value(spark, tmp_path):
    table, batch = str(tmp_path / "t"), observations(spark, odd_rows())
    assert store.append_if_absent(batch, table) == len(odd_rows())
    assert as_set(store.stored_observations(spark, table)) == as_set(batch)
    assert store.append_if_absent(batch.filter("slot_start IS NOT NULL"), table) == 0


def test_rows_of_a_batch_cross_one_exchange(spark):
    batch = observations(spark, traffic([0, 30], lambda _: 0))
    for keys in (None, batch.select(*OBSERVATION_KEY)):
        fresh = appends.absent_rows(batch, keys, 3, 2)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "Join" not in plan
        assert fresh.count() == (20 if keys is None else 0)


def test_a_replay_stages_nothing(spark, tmp_path, monkeypatch):
    table, batch = str(tmp_path / "t"), observations(spark, traffic([0, 1, 30], lambda _: 0))
    assert store.append_if_absent(batch, table) == 30
    with monkeypatch.context() as patched:
        patched.setattr(store, "stage", None)
        assert store.append_if_absent(batch, table) == 0
    # One report more in a stored slot, beside copies, one swapped for another, and a new slot.
    more = traffic([0], lambda _: 0) * 2 + [report("x", 5, T0)] + traffic([1], lambda _: 0)[1:]
    more += [report("y", 5, T0 + timedelta(hours=1))] + traffic([2], lambda _: 0)
    assert store.append_if_absent(observations(spark, more), table) == 12
    assert len(children(spark, table)) == 3  # two commits and the log


def test_digests_tell_null_fields_apart(spark):
    at = T0 + timedelta(minutes=3)
    sides = [{**report("a", 1, at), "sample_point": None}], [{**report("a", 1, at, disc="a"), "hex": None}]
    mine, theirs = (appends.slot_digests(observations(spark, rows)) for rows in sides)
    assert appends.slots_with_news(mine, theirs).count() == 1
    assert appends.slots_with_news(mine, mine).count() == 0


def test_an_import_moves_its_history_once(spark, tmp_path, monkeypatch):
    """Copies are taken out by the append itself, which keeps the worst NIC."""
    root, table = str(tmp_path / "h"), str(tmp_path / "t")
    rows = traffic([0, 1], lambda _: 0) + traffic([1], lambda _: 1)
    frame = observations(spark, rows).drop("slot_start", "ingest_run_id")
    frame.selectExpr("*", "date'2026-10-01' AS date").write.partitionBy("date").parquet(root)
    monkeypatch.setattr(legacy, "materialise", None)
    assert [legacy.import_legacy(spark, root, table) for _ in range(2)] == [20, 0]
    nics = {(r.slot_start.hour, r.nic) for r in store.stored_observations(spark, table).collect()}
    assert nics == {(0, 9), (1, 2)}


@pytest.mark.parametrize("fails", [False, True])
def test_a_captured_batch_is_not_cached_and_its_folder_goes(spark, tmp_path, monkeypatch, fails):
    source, folder = str(tmp_path / "in"), str(tmp_path / "scratch")
    observations(spark, traffic([0], lambda _: 0)).write.parquet(source)
    seen = []

    def look(rows, table):
        seen.append((rows.count(), rows.storageLevel.useMemory, children(spark, folder) != []))
        if fails:
            raise ValueError("no room")

    monkeypatch.setattr(capture, "append_if_absent", look)
    monkeypatch.setattr(capture, "run_folder", lambda *_: folder)
    stream = spark.readStream.schema(OBSERVATIONS).parquet(source)
    running = capture.start_reports(stream, str(tmp_path / "t"), str(tmp_path / "s"))
    try:
        running.awaitTermination()
    except Exception as error:
        assert fails and "no room" in str(error)
    assert seen == [(10, False, True)] and children(spark, folder) == []


def test_landed_answers_are_compressed():
    assert registry.LANDED["compression"] == "gzip"


def test_writers_of_one_process_move_what_they_share_once(spark, tmp_path, monkeypatch):
    """All three have looked at the table while it was empty, if they look before their turn."""
    table, stage, digests = str(tmp_path / "t"), store.stage, store.slot_digests
    staged, ready, waited = [], threading.Barrier(3), set()

    def counted(rows, path, *args, **options):
        commit = stage(rows, path, *args, **options)
        staged.append(spark.read.parquet(f"{path}/commit_id={commit[0]}").count())
        return commit

    def together(rows):
        if threading.get_ident() not in waited:
            waited.add(threading.get_ident())
            ready.wait(120)
        return digests(rows)

    monkeypatch.setattr(store, "stage", counted)
    monkeypatch.setattr(store, "slot_digests", together)
    batches = [observations(spark, traffic(hours, lambda _: 0)) for hours in ([0, 1], [1, 30], [0, 1, 30])]
    with ThreadPoolExecutor(3) as writers:
        added = list(writers.map(lambda batch: store.append_if_absent(batch, table), batches))
    assert sum(added) == sum(staged) == store.stored_observations(spark, table).count() == 30


@pytest.mark.parametrize("at_once", [1, 25, 10**6])
def test_a_batch_moves_some_dates_at_a_time_into_one_commit(spark, tmp_path, monkeypatch, at_once):
    table, stage, calls = str(tmp_path / "t"), store.stage, []

    def counted(*args, **options):
        calls.append(args)
        return stage(*args, **options)

    monkeypatch.setattr(store, "ROWS_AT_ONCE", at_once)
    store.append_if_absent(observations(spark, traffic([0, 24], lambda _: 0)), table)
    monkeypatch.setattr(store, "stage", counted)
    rows = traffic([0, 1, 24, 25, 50, 51, 74], lambda _: 0) + traffic([74], lambda _: 1)
    rows.append({**report("no slot", 3, T0), "slot_start": None})
    assert store.append_if_absent(observations(spark, rows), table) == 51
    # Of the five dates, one NULL, 10, 10, 20 and 20 rows in slots with news.
    assert len(calls) == {1: 5, 25: 3, 10**6: 1}[at_once]
    assert len(children(spark, table)) == 3  # two commits and the log
    stored = store.stored_observations(spark, table)
    assert stored.count() == stored.select(*OBSERVATION_KEY).distinct().count() == 71
    assert stored.filter("nic = 2").count() == 10  # of two copies the worse NIC
    assert store.append_if_absent(observations(spark, rows[:-1]), table) == 0


def test_an_append_leaves_no_files_of_its_exchanges(spark, tmp_path):
    def shuffles():
        env = spark._jvm.org.apache.spark.SparkEnv.get()
        files = env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {f for f in files if "/shuffle_" in f and f.endswith(".data")}

    before = shuffles()
    store.append_if_absent(observations(spark, traffic([0, 1, 30], lambda _: 0)), str(tmp_path / "t"))
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before


def test_reports_are_written_without_a_dictionary_of_times(spark, tmp_path):
    rows = [report(f"v-{i}", 9, T0) for i in range(50)]
    store.append_if_absent(observations(spark, rows), str(tmp_path / "t"))
    [file] = (tmp_path / "t").glob("commit_id=*/*/*.parquet")
    group = pq.ParquetFile(file).metadata.row_group(0)
    chunks = {c.path_in_schema: c for c in (group.column(i) for i in range(group.num_columns))}
    encoded = {name: str(c.encodings) for name, c in chunks.items()}
    assert "DICTIONARY" in encoded["sample_point"] and "DICTIONARY" not in encoded["observed_at"]
    assert {c.compression for c in chunks.values()} == {"ZSTD"}


def test_answers_land_again_as_the_same_lines(spark, tmp_path, monkeypatch):
    """The feed is parsed and written as JSON once; its lines are landed twice."""
    at = datetime(2024, 1, 5)
    events = [(i, at + timedelta(minutes=37 * i), i % 7, "view") for i in range(40)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"
    spark.createDataFrame(events, schema).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(registry, "run_folder", lambda _, name: str(tmp_path / name))
    stored = registry.QUERIES["stream_capture"](spark, str(tmp_path))
    lines = spark.read.text(str(tmp_path / "landing")).groupBy("value").count()
    assert {r["count"] for r in lines.collect()} == {2} and lines.count() == 480
    names = [n for n in children(spark, str(tmp_path / "landing")) if n.endswith(".gz")]
    assert {n.split(".", 1)[1] for n in names} == {"json.gz", "txt.gz"}
    reports = registry.QUERIES["snapshot_flatten"](spark, str(tmp_path))
    assert sorted(map(str, stored.collect())) == sorted(map(str, reports.collect()))
