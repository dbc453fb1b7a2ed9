import random

import numpy as np
import pytest

from cellhours.llm.negatives import (
    MultiIndex,
    cells_to_visit,
    mine_hard_negatives,
    multi_sequence,
    nearest_word,
    train_codebook,
)
from cellhours.llm.queries import op13_negatives
from tests.llm.helpers import HAVE_TABLES, SF

ROWS = "vec_id bigint, label int, vector array<bigint>"


def plain(rows, every, k=5):
    """All rows against every anchor, in Python integers."""
    out = []
    for a, label, v in rows:
        if a % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w, strict=True)), b, other) for b, other, w in rows if b != a
        ]
        near = sorted((s, b) for s, b, other in scored if other == label)[:k]
        for p, b in near:
            hard = sorted((s, c) for s, c, other in scored if other != label and -80 * p <= -100 * s <= -100 * p)
            out += [(a, b, n + 1, c, -p, -s) for n, (s, c) in enumerate(hard[:k])]
    return sorted(out)


def found(df):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_equals_all_pairs(spark):
    rows = []
    for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect():
        label = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
        rows.append((r.vec_id, label, [int(np.floor(256 * float(x))) for x in r.embedding]))
    assert found(op13_negatives(spark, SF)) == plain(rows, 100)


@pytest.mark.parametrize("width", [1, 2, 5])
def test_small_cells_ties_and_copies(spark, width):
    pick = random.Random(width)
    rows = [
        (i, pick.randrange(3), [pick.randint(-4, 9) for _ in range(width)]) for i in range(260)
    ]
    rows += [(1000 + i, i % 3, [5] * width) for i in range(60)]
    table = spark.createDataFrame(rows, ROWS)
    out = mine_hard_negatives(table, every=10, rows_per_cell=4, most_sampled=200)
    assert found(out) == plain(rows, 10)


def test_odd_rows(spark):
    good = [(0, 1, [3, 4]), (1, 1, [3, 3]), (2, 2, [3, 3]), (3, 2, [2, 4]), (4, 2, [0, 0])]
    odd = [
        (None, 1, [3, 4]), (5, None, [3, 4]), (6, 1, None), (7, 1, [3, None]), (8, 2, [3, 3, 3]),
        (9, 2, []), (0, 1, [3, 4]), (1, 1, [9, 9]), (2, 2, [3, 3]),
    ]
    table = spark.createDataFrame(good + odd, ROWS).selectExpr("*", "1 AS ask", "2 AS hi", "3 AS i")
    assert found(mine_hard_negatives(table, every=100)) == plain(good, 100)
    assert mine_hard_negatives(table.limit(0)).count() == 0
    huge = [(0, 1, [1 << 40, 3]), (1, 1, [1 << 20, 1]), (2, 2, [1 << 20, 0]), (3, 2, [1 << 19, 0])]
    assert found(mine_hard_negatives(spark.createDataFrame(huge, ROWS), every=100)) == plain(huge, 100)


def clustered(pick, centres, each, spread):
    middle = pick.normal(0, 200, (centres, 16))
    return np.rint(np.repeat(middle, each, axis=0) + pick.normal(0, spread, (centres * each, 16)))


def test_sequence_of_cells_is_complete_and_sorted():
    pick = np.random.default_rng(1)
    u, v = pick.normal(size=7), pick.normal(size=5)
    cells = list(multi_sequence(u, v))
    assert sorted((i, j) for _, i, j in cells) == [(i, j) for i in range(7) for j in range(5)]
    sums = [b for b, *_ in cells]
    assert sums == sorted(sums, reverse=True)
    assert all(b == u[i] + v[j] for b, i, j in cells)


def test_bounds_hold_and_spare_most_cells():
    pick = np.random.default_rng(7)
    rows = clustered(pick, 40, 50, 4.0)
    words = [train_codebook(rows[:, s], 16) for s in (slice(0, 8), slice(8, 16))]
    near = [nearest_word(rows[:, s], w) for s, w in zip((slice(0, 8), slice(8, 16)), words, strict=True)]
    away = [
        np.linalg.norm(rows[:, s] - w[n], axis=1)
        for s, w, n in zip((slice(0, 8), slice(8, 16)), words, near, strict=True)
    ]
    radii = [np.array([a[n == c].max(initial=0) for c in range(16)]) for a, n in zip(away, near, strict=True)]
    sizes = np.zeros((16, 16), int)
    np.add.at(sizes, tuple(near), 1)
    index = MultiIndex(tuple(words), tuple(radii), sizes)
    spared = 0
    for q in rows[::100]:
        score = rows @ q
        first, second = index.bounds(q)
        assert (score <= first[near[0]] + second[near[1]]).all()
        tenth = np.sort(score)[-10]
        opening = cells_to_visit(index, q, -np.inf, 30, None)
        rest = cells_to_visit(index, q, -np.inf, 30, tenth)
        seen = {(i, j) for part in (opening, rest) for i, js in part.items() for j in js}
        assert sum(len(js) for part in (opening, rest) for js in part.values()) == len(seen)
        best = np.flatnonzero(score >= tenth)
        assert {(near[0][r], near[1][r]) for r in best} <= seen
        spared += (sizes > 0).sum() - len(seen)
    assert spared > 0.5 * (sizes > 0).sum() * len(rows[::100])
