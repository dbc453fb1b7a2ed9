"""The incremental build against the build in one go."""

from datetime import date, timedelta

import pytest

from cellhours.config import Rules
from cellhours.operators.cells import cell_hourly
from cellhours.operators.features import build_features
from cellhours.plans.incremental import months_reached, reach, run_incremental_build
from cellhours.schemas import LINEAGE
from cellhours.sources import feature_store
from cellhours.sources import observations as store
from tests.conftest import EAST, T0, observations, traffic

RULES = Rules(positive_rate_low=0.0, positive_rate_high=1.0)


def both_places(hours, shift=0):
    rows = traffic(hours, lambda h: 0.9 if (h + shift) % 11 < 3 else 0.1)
    return rows + traffic(hours, lambda h: 0.6 if h % 7 == shift else 0.0, place=EAST, tag="e")


def whole(spark, table):
    cells = cell_hourly(store.stored_observations(spark, table), RULES)
    return sorted(map(tuple, build_features(cells, RULES, unique=True).collect()))


def published(spark, root):
    return sorted(map(tuple, feature_store.read_features(spark, root).drop(*LINEAGE).collect()))


def test_builds_after_each_batch_equal_the_whole(spark, tmp_path):
    table, root = str(tmp_path / "table"), str(tmp_path / "store")
    # The first batch lies in October and December, the second in November, the third is late.
    batches = [
        both_places([*range(0, 30), *range(24 * 62, 24 * 62 + 30)]),
        both_places(range(24 * 31 - 10, 24 * 31 + 20), shift=2),
        traffic(range(5, 12), lambda h: 1.0, vehicles=30, tag="late"),
    ]
    folders = []
    for step, rows in enumerate(batches):
        store.append_if_absent(observations(spark, rows), table)
        run = f"run-{step}"
        result = run_incremental_build(spark, table, root, T0 + timedelta(days=80 + step), run, RULES)
        assert result.published and not result.problems
        assert published(spark, root) == whole(spark, table)
        parts = feature_store.manifest(spark, root, run)
        folders.append({p.part: p.folder for p in parts if p.kind == feature_store.MONTHS})
    assert folders[0] == {"2026-10-01": "run-0", "2026-12-01": "run-0"}
    assert folders[1]["2026-12-01"] == "run-0" and folders[1]["2026-11-01"] == "run-1"
    assert folders[2] == {**folders[1], "2026-10-01": "run-2"}
    last = feature_store.feature_runs(spark, root).orderBy("built_at").collect()[-1]
    assert last.labelled_rows == len(whole(spark, table))
    assert last.cell_slots == cell_hourly(store.stored_observations(spark, table), RULES).count()
    # Nothing new: nothing is computed, and the table stays.
    again = run_incremental_build(spark, table, root, T0 + timedelta(days=90), "run-3", RULES)
    assert again.published and published(spark, root) == whole(spark, table)
    assert {p.folder for p in feature_store.manifest(spark, root, "run-3")} <= {"run-0", "run-1", "run-2"}
    # Old folders that the newest build still needs are kept, others go.
    gone = feature_store.drop_unreferenced(spark, root, keep=1)
    assert f"{root}/feature_manifests/run-1" in gone
    assert f"{root}/cell_hourly_features/run-2" not in gone
    assert published(spark, root) == whole(spark, table)


def test_a_refused_build_is_caught_up_with_later(spark, tmp_path):
    table, root = str(tmp_path / "table"), str(tmp_path / "store")
    now = T0 + timedelta(days=9)
    empty = run_incremental_build(spark, table, root, now, "none", RULES)
    assert not empty.published and "no cell hour" in empty.problems[0]
    store.append_if_absent(observations(spark, both_places(range(0, 20))), table)
    strict = Rules(positive_rate_low=0.99, positive_rate_high=1.0)
    assert run_incremental_build(spark, table, root, now, "strict", strict).problems
    with pytest.raises(FileNotFoundError):
        feature_store.read_features(spark, root)
    store.append_if_absent(observations(spark, both_places(range(20, 40))), table)
    assert run_incremental_build(spark, table, root, now, "good", RULES).published
    assert published(spark, root) == whole(spark, table)


def test_only_dirty_dates_and_the_months_they_reach_are_read(spark):
    assert reach() == (1, 7)
    assert months_reached([date(2026, 10, 15)]) == {date(2026, 10, 1)}
    assert months_reached([date(2026, 10, 28)]) == {date(2026, 10, 1), date(2026, 11, 1)}
    assert months_reached([date(2026, 11, 1)]) == {date(2026, 10, 1), date(2026, 11, 1)}
