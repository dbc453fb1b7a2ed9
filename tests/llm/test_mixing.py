"""Mixing: how far each source is from its target, over many periods."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cellhours.llm.mixing import mix_sources, plan
from cellhours.llm.queries import op7_mixing
from tests.llm.helpers import HAVE_TABLES, SF


def fluid(blocks, weights, slot):
    """Blocks of each source in the fluid schedule before `slot`, by exhausting phase by phase."""
    left, out = {s: Fraction(n) for s, n in blocks.items()}, dict.fromkeys(blocks, Fraction(0))
    rest = Fraction(slot)
    while rest and left:
        total = sum(weights[s] for s in left)
        step = min([rest, *(n * total / weights[s] for s, n in left.items())])
        for s in list(left):
            out[s] += step * weights[s] / total
            left[s] -= step * weights[s] / total
            if not left[s]:
                del left[s]
        rest -= step
    return out


def test_plan_stays_within_a_block_of_the_fluid_schedule_in_all_phases():
    blocks = {"a": 400, "b": 3, "c": 41, "d": 120, "e": 1, "f": 120}
    weights = {"a": 9.7, "b": 0.3, "c": 0.1, "d": 2.0 ** 0.5, "e": 5.0, "f": 1.0}
    exact = {s: Fraction(w) for s, w in weights.items()}
    done, slot = dict.fromkeys(blocks, 0), 0
    for stretch in plan(blocks, weights, 64):
        assert stretch.start == slot
        for s, block, _ in stretch.blocks:
            assert block == done[s]
            done[s], slot = done[s] + 1, slot + 1
            target = fluid(blocks, exact, slot)
            assert all(abs(done[x] - target[x]) < 1 for x in blocks), slot
    assert done == blocks


def test_lag_against_the_target_weights_over_many_periods(spark):
    weights = {f"s{i:02}": 0.5 if i == 0 else 0.5 / 19 for i in range(20)}
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.expr("if(id % 2 = 0, 's00', concat('s', lpad(1 + (id div 2) % 19, 2, '0')))").alias("source"),
    )
    out = mix_sources(docs, weights, block_rows=1, period=64)
    rows = out.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(6000))
    done = dict.fromkeys(weights, 0)
    for slot, r in enumerate(rows, 1):
        if r.phase:
            break
        done[r.mix_source] += 1
        assert all(abs(done[s] - w * slot) < 1 for s, w in weights.items()), slot
    assert slot > 40 * 64


def test_every_source_has_its_share_beyond_255_and_null(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.expr("if(id % 301 = 300, null, concat('s', id % 301))").alias("source"),
    ).where("doc_id % 301 > 9 or doc_id < 2107")
    counts = {r.source: r["count"] for r in docs.groupBy("source").count().collect()}
    assert len(counts) == 301 and len(set(counts.values())) > 1
    for weights in (None, {f"s{i}": 1.0 + i % 7 for i in range(300)}):
        rows = mix_sources(docs, weights, block_rows=1).orderBy("position").collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
        assert all(r.mix_source == r.source for r in rows)
        target = {s: (weights or {}).get(s, n**0.5 if weights is None else 1.0) for s, n in counts.items()}
        total, done = sum(target.values()), dict.fromkeys(counts, 0)
        for slot, r in enumerate(rows, 1):
            if r.phase:
                break
            done[r.mix_source] += 1
            assert all(abs(done[s] - w * slot / total) < 1 for s, w in target.items()), slot
        assert slot > 301


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_follows_the_fluid_schedule(spark):
    """Each document once, in hash order in its source, whole blocks, less than one block off."""
    order = F.xxhash64("doc_id", F.lit("mix")).alias("h")
    rows = op7_mixing(spark, SF).select("*", order).orderBy("position").collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").collect()
    assert sorted((r.doc_id, str(r.source)) for r in rows) == sorted((d.doc_id, str(d.source)) for d in docs)
    of_source = {}
    for r in rows:
        assert r.mix_source == r.source
        of_source.setdefault(r.source, []).append(r)
    for mine in of_source.values():
        assert [r.h for r in mine] == sorted(r.h for r in mine)
        assert [r.block for r in mine] == [i // 32 for i in range(len(mine))]
        assert all(r.position % 32 == i % 32 for i, r in enumerate(mine))
    blocks = {s: -(-len(mine) // 32) for s, mine in of_source.items()}
    exact = {s: Fraction(len(mine) ** 0.5) for s, mine in of_source.items()}
    slots = {}
    for r in rows:
        assert slots.setdefault(r.position // 32, (r.source, r.block)) == (r.source, r.block)
    assert sorted(slots) == list(range(sum(blocks.values())))
    done = dict.fromkeys(blocks, 0)
    for slot in sorted(slots):
        done[slots[slot][0]] += 1
        target = fluid(blocks, exact, slot + 1)
        assert all(abs(done[s] - target[s]) < 1 for s in blocks), slot


def test_clashing_names_and_repeated_rows(spark):
    rows = [(i % 5 if i % 7 else None, f"s{i % 3}" if i % 4 else None, "x" * i, i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, Position string, key bigint")
    out = mix_sources(docs.unionAll(docs), block_rows=2).collect()
    assert len(out) == 120 and len({r.position for r in out}) == 120
    assert sorted(r.key for r in out) == sorted(2 * list(range(60)))
    assert all(r.mix_source == r.source and isinstance(r.position, int) for r in out)
