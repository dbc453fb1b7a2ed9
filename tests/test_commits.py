"""The commit log of the report table."""

import threading
from datetime import timedelta

from cellhours.sources import commits
from cellhours.sources import observations as store
from cellhours.functions.timeslots import utc_date
from tests.conftest import EAST, T0, observations, report, traffic


def keys(df):
    return sorted((r.hex, r.observed_at, r.sample_point) for r in df.collect())


def test_writers_that_overlap_store_each_key_once(spark, tmp_path, monkeypatch):
    """Both have staged their rows before either commits."""
    table = str(tmp_path / "table")
    shared, own = traffic([0, 1], lambda h: 0), traffic([1, 2], lambda h: 0, place=EAST, tag="e")
    other = traffic([3], lambda h: 0, tag="z")
    batches = [observations(spark, shared + other), observations(spark, shared + own)]
    ready, publish = threading.Barrier(2), store.publish
    waited = set()

    def together(*args):
        me = threading.get_ident()
        if me not in waited:
            waited.add(me)
            ready.wait(120)
        return publish(*args)

    monkeypatch.setattr(store, "publish", together)
    added = {}
    threads = [
        threading.Thread(target=lambda i=i: added.update({i: store.append_if_absent(batches[i], table)}))
        for i in (0, 1)
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    stored = store.stored_observations(spark, table)
    assert stored.count() == 50 == sum(added.values())
    assert keys(stored) == keys(observations(spark, shared + other + own))
    log = commits.log_entries(spark, table)
    assert [e.version for e in log] == [1, 2] and sum(e.rows for e in log) == 50
    # What the second writer staged first is in no entry, and so in no read.
    assert len([n for n in commits.children(spark, table) if n.startswith("commit_id=")]) >= 2


def test_writers_of_other_dates_need_no_second_write(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "table")
    first = observations(spark, traffic([0], lambda h: 0))
    publish, calls = store.publish, []

    def late(spark_, path, entry):
        if not calls:  # another date is committed between our look at the log and our commit
            calls.append(entry)
            monkeypatch.setattr(store, "publish", publish)
            other = observations(spark, traffic([40], lambda h: 0, tag="o"))
            assert store.append_if_absent(other, table) == 10
        return publish(spark_, path, entry)

    monkeypatch.setattr(store, "publish", late)
    assert store.append_if_absent(first, table) == 10
    log = commits.log_entries(spark, table)
    assert [e.version for e in log] == [1, 2] and log[1].commit_id == calls[0].commit_id
    assert store.stored_observations(spark, table).count() == 20


def test_a_version_is_created_once(spark, tmp_path):
    path = str(tmp_path / "t")
    one = commits.Entry(1, "a", 3, ("2026-10-01",))
    assert commits.publish(spark, path, one)
    assert not commits.publish(spark, path, commits.Entry(1, "b", 4, ()))
    assert commits.log_entries(spark, path) == [one] and commits.log_entries(spark, path, 1) == []
    name = f"{path}/{commits.LOG}/{2:020d}.json"
    text = '{"version": 2, "commit_id": "c", "rows": 1, "parts": []}'
    assert commits.rename_once(spark, f"{path}/{commits.LOG}/.d1", name, text)
    assert not commits.rename_once(spark, f"{path}/{commits.LOG}/.d2", name, text)
    assert [e.commit_id for e in commits.log_entries(spark, path)] == ["a", "c"]


def test_tables_from_before_the_log_are_read_and_extended(spark, tmp_path):
    table = str(tmp_path / "table")
    old = observations(spark, traffic([0], lambda h: 0)).withColumn("slot_date", utc_date("slot_start"))
    old.write.partitionBy("slot_date").parquet(table)
    assert store.stored_observations(spark, table).count() == 10
    both = observations(spark, traffic([0, 1], lambda h: 0))
    assert store.append_if_absent(both, table) == 10
    assert store.stored_observations(spark, table).count() == 20


def test_the_newest_day_reads_one_date(spark, tmp_path):
    table = str(tmp_path / "table")
    assert store.newest_day(spark, table).count() == 0
    for hour in (50, 0, 26):
        rows = [report("a", 9, T0 + timedelta(hours=hour))]
        store.append_if_absent(observations(spark, rows), table)
    newest = store.newest_day(spark, table)
    assert [r.observed_at.day for r in newest.collect()] == [3]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "2026-10-03" in plan.split("PartitionFilters")[1].split("]")[0]
