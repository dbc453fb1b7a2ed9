from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellhours.operators import analysis, evaluation
from cellhours.operators.ordering import average_ranks, running_totals
from tests.conftest import HOME_CELL, T0


def test_running_totals_with_keys_crowded_into_one_spot(spark):
    """Two thirds of the keys lie within a millionth; the blocks follow them."""
    rng = random.Random(5)
    keys = {0.5 + rng.random() * 1e-6 for _ in range(4_000)} | {rng.random() for _ in range(2_000)}
    rows = [(k, rng.randint(0, 5)) for k in keys]
    frame = spark.createDataFrame(rows, "k double, n bigint")
    for descending in (False, True):
        got = {r.k: r.cum_n for r in running_totals(frame, "k", ["n"], descending).collect()}
        total, expected = 0, {}
        for k, n in sorted(rows, reverse=descending):
            total += n
            expected[k] = total
        assert got == expected


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_the_range_of_a_double(spark, descending):
    tiny = [5e-324, 1e-310, 2.2250738585072014e-308]
    keys = {0.0, float("inf"), 1.7976931348623157e308, 1e16, 3.0, 7.0, 1.0 + 2**-52, *tiny}
    keys |= {2.0**e for e in range(-40, 40)} | {2.0**e - 2.0 ** (e - 50) for e in range(-40, 40)}
    keys |= {-k for k in keys}
    rows = [(k, 2 * i + 1) for i, k in enumerate(keys)]
    frame = spark.createDataFrame([*rows, (float("nan"), 1000)], "k double, n bigint")
    total, expected = 1000 if descending else 0, []
    for k, n in sorted(rows, reverse=descending):
        total += n
        expected.append((k, total))
    got = running_totals(frame, "k", ["n"], descending).orderBy("k").collect()
    assert got[-1].cum_n == (1000 if descending else total + 1000)  # NaN is above all numbers
    assert [(r.k, r.cum_n) for r in got[:-1]] == sorted(expected)


def test_running_totals_of_whole_numbers(spark):
    frame = spark.range(-3000, 70_000, 7).selectExpr("id AS k", "1L AS n")
    totals = running_totals(frame, "k", ["n"])
    assert totals.where("cum_n != (k + 3000) div 7 + 1").count() == 0
    assert totals.count() == frame.count()


def test_running_totals_of_nothing_and_of_one(spark):
    schema = "k double, n bigint"
    assert running_totals(spark.createDataFrame([], schema), "k", ["n"]).count() == 0
    one = running_totals(spark.createDataFrame([(0.3, 4)], schema), "k", ["n"]).first()
    assert one.cum_n == 4


def test_average_ranks_share_ties(spark):
    values = [3.0, 1.0, 3.0, 2.0, 3.0, None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.v: r.rank for r in average_ranks(frame, "v", "rank").collect()}
    assert got == {1.0: 1.0, 2.0: 2.0, 3.0: 4.0}


def average_precision(scores, targets):
    order = sorted(set(scores), reverse=True)
    total, before, out = sum(targets), 0.0, 0.0
    for s in order:
        said = [t for x, t in zip(scores, targets, strict=True) if x >= s]
        recall = sum(said) / total
        out += (recall - before) * sum(said) / len(said)
        before = recall
    return out


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "score double, target_is_degraded int")


def test_average_precision_with_ties(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 20) / 20, int(rng.random() < 0.2)) for _ in range(500)]
    row = evaluation.average_precision(scored(spark, pairs + [(None, 1)])).first()
    expected = average_precision(*map(list, zip(*pairs, strict=True)))
    assert row.average_precision == pytest.approx(expected, abs=1e-12)
    assert row.scored_rows == 500


def test_average_precision_extremes(spark):
    perfect = [(0.9, 1), (0.8, 1), (0.1, 0)]
    assert evaluation.average_precision(scored(spark, perfect)).first().average_precision == 1.0
    no_positive = evaluation.average_precision(scored(spark, [(0.5, 0)])).first()
    assert no_positive.average_precision is None


def test_brier(spark):
    row = evaluation.brier(scored(spark, [(1.0, 1), (0.5, 0), (0.0, 1), (None, 1)])).first()
    assert row.brier == pytest.approx((0 + 0.25 + 1) / 3)


def table(spark, rows):
    return spark.createDataFrame(
        [(c, T0 + timedelta(hours=h), s, t) for c, h, s, t in rows],
        "h3_cell string, slot_start timestamp, is_degraded int, target_is_degraded int",
    )


def test_split_is_chronological_with_gaps(spark):
    rows = [(c, h, 0, 0) for c in ("a", "b") for h in range(100)]
    split = evaluation.chrono_split(table(spark, rows)).filter("h3_cell = 'a'")
    got = [r.segment for r in split.orderBy("slot_start").collect()]
    # Cuts after hours 69 and 84; the last six hours before a cut look across it.
    expected = ["train"] * 64 + ["gap"] * 6 + ["validation"] * 9 + ["gap"] * 6 + ["test"] * 15
    assert got == expected


def test_climatology_falls_back_to_cell_and_then_to_all(spark):
    train = table(
        spark, [("a", 0, 0, 1), ("a", 24, 0, 0), ("a", 1, 0, 1), ("b", 0, 0, 0)]
    )
    rows = table(spark, [("a", 48, 0, 0), ("a", 49, 0, 0), ("a", 50, 0, 0), ("c", 48, 0, 0)])
    got = {
        (r.h3_cell, (r.slot_start.hour)): r.score
        for r in evaluation.climatology(train, rows).collect()
    }
    assert got == {("a", 0): 0.5, ("a", 1): 1.0, ("a", 2): pytest.approx(2 / 3), ("c", 0): 0.5}


def test_region_metrics_and_persistence(spark):
    rows = [("a", 0, 0, 0), ("a", 1, 1, 1), ("a", 2, 0, 1), ("a", 3, 1, 0), ("b", 0, 1, 1)]
    base = evaluation.persistence(table(spark, rows))
    regions = spark.createDataFrame(
        [("a", "interference"), ("b", "control")], "h3_cell string, region string"
    )
    got = {
        (r.region, r.subset): (r.rows, r.precision, r.recall)
        for r in evaluation.region_metrics(base, regions, 0.5).collect()
    }
    assert got == {
        ("interference", "all"): (4, 0.5, 0.5),
        ("interference", "transitions"): (2, 0.0, 0.0),
        ("control", "all"): (1, 1.0, 1.0),
    }


def test_lagged_accuracy_waits_for_the_outcome(spark):
    cells = table(spark, [("a", h, int(h >= 8), 0) for h in range(10)])
    forecasts = cells.selectExpr("h3_cell", "slot_start", "cast(is_degraded AS double) AS score")
    row = evaluation.lagged_accuracy(forecasts, cells).first()
    assert (row.scored_rows, row.accuracy) == (4, 0.5)


def test_class_weights_balance(spark):
    rows = [("a", h, 0, int(h < 2)) for h in range(10)]
    weighted = evaluation.class_weights(table(spark, rows)).collect()
    per_class = [sum(r.weight for r in weighted if r.target_is_degraded == t) for t in (0, 1)]
    assert per_class == pytest.approx([5.0, 5.0])


def test_correlation_with_ties_equals_numpy(spark):
    rng = random.Random(9)
    pairs = [(rng.randint(0, 8) / 8, rng.randint(0, 5) / 5) for _ in range(60)]
    row = analysis.correlation(spark.createDataFrame(pairs, "x double, y double"), "x", "y").first()
    x, y = map(np.array, zip(*pairs, strict=True))

    def ranks(v):
        return np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])

    assert row.pearson == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert row.spearman == pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1])


def test_psi_is_zero_without_drift_and_large_with_it(spark):
    same = spark.range(1000).selectExpr("cast(id AS double) AS a", "if(id % 4 = 0, null, id) AS b")
    moved = same.selectExpr("a + 500 AS a", "b")
    got = {r.feature: r.psi for r in analysis.psi_drift(same, moved, ["a", "b"]).collect()}
    assert got["b"] == pytest.approx(0.0, abs=1e-12)
    assert got["a"] > 1.0


def test_psi_cuts_are_exact_at_any_size(spark):
    values = np.r_[np.random.default_rng(3).normal(size=29_989).round(4), np.zeros(5000)]
    rows = spark.createDataFrame([(float(v),) for v in values], "value double")
    both = rows.withColumn("feature", F.lit("x")).unionByName(
        spark.createDataFrame([("y", 1.0), ("y", 2.0), ("y", None)], "feature string, value double")
    )
    got = {r.feature: r._cuts for r in analysis._quantile_cuts(both, 10).collect()}
    ordered = np.sort(values)
    picks = [ordered[-(-len(values) * d // 10) - 1] for d in range(1, 10)]
    assert got == {"x": sorted(set(picks)), "y": [1.0, 2.0]}


def test_transition_rates(spark):
    rows = table(spark, [(HOME_CELL, 0, 0, 1), (HOME_CELL, 1, 0, 0), (HOME_CELL, 2, 1, 0),
                         (HOME_CELL, 3, 1, 1)])
    near = rows.selectExpr("*", "if(target_is_degraded = 1, 1, null) AS nbr_degraded_count")
    row = analysis.transition_rates(near).first()
    assert (row.transitions, row.onsets, row.transition_rate) == (2, 1, 0.5)
    assert (row.onset_rate, row.onset_rate_near) == (0.5, 1.0)
