"""Interleaving sources to target weights as a proportionate-fair schedule of blocks."""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhours.llm.common import fresh_name, number_rows
from cellhours.sources.scratch import materialise

REST = ""  # key of every row without a source of its own; the others are "=" and the source
GRAIN = 1 << 20  # a slot this part of one away from a whole slot counts as that slot


@dataclass(frozen=True)
class Stretch:
    """Consecutive slots of the schedule, from slot `start` on: `blocks` has (source, block of the
    source, phase) of each slot."""

    start: int
    blocks: list[tuple[str, int, int]]

    @property
    def length(self) -> int:
        return len(self.blocks)


def whole_weights(weights: Mapping[str, float]) -> dict[str, int]:
    """Integers in exactly the proportions of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = math.lcm(*(w.denominator for w in exact.values()))
    return {s: w.numerator * (unit // w.denominator) for s, w in exact.items()}


def plan(
    blocks: Mapping[str, int], weights: Mapping[str, float], period: int
) -> Iterator[Stretch]:
    """The schedule that places every block once, in stretches of `period` slots.

    Its target is the fluid schedule: all sources that are not used up grow at once, in proportion
    to their weights, by one block per slot together. A phase ends where one is used up there.
    With turn v = blocks / weight, a source of n blocks has min(n, w * v) at turn v, and so
    the slot of a turn is the sum of these. Block k may not run before the slot of turn k / w,
    rounded down, and must have run before that of turn (k + 1) / w, rounded up. The blocks that
    have to fit between any two slots are no more than the fluid schedule has there, so earliest
    deadline first among the released blocks meets every deadline: at any slot, over all phases,
    a source is less than one block off the fluid schedule. Weights are taken as exact rationals;
    releases up to 1 / GRAIN before a whole slot, and deadlines after it, are put on it, which still
    leaves room for all blocks as their number between two slots is whole.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    if not left:
        return
    whole = whole_weights({s: weights[s] for s in left})
    ends: list[float] = []  # turns at which a source is used up
    placed, active = [0], [sum(whole.values())]  # before each: blocks of used-up sources, weight
    for turn, s in sorted((n / whole[s], s) for s, n in left.items()):
        if not ends or ends[-1] < turn:
            ends.append(turn)
            placed.append(placed[-1])
            active.append(active[-1])
        placed[-1] += left[s]
        active[-1] -= whole[s]

    def released(source: str, block: int) -> int:
        i, weight = bisect_left(ends, block / whole[source]), whole[source]
        return placed[i] + (block * active[i] * GRAIN + weight) // (weight * GRAIN)

    def due(source: str, block: int) -> int:
        i, weight = bisect_left(ends, (block + 1) / whole[source]), whole[source]
        return placed[i] - (weight - (block + 1) * active[i] * GRAIN) // (weight * GRAIN)

    # The slot where each phase ends; a source that is used up there gives the exact ratio.
    last = {n / whole[s]: s for s, n in left.items()}
    phase_ends = [due(last[turn], left[last[turn]] - 1) for turn in ends]
    done = dict.fromkeys(left, 0)
    waiting = [(0, s) for s in sorted(left)]
    ready: list[tuple[int, str]] = []
    stretch: list[tuple[str, int, int]] = []
    phase = 0
    total = sum(left.values())
    for slot in range(total):
        while waiting and (waiting[0][0] <= slot or not ready):
            _, s = heapq.heappop(waiting)
            heapq.heappush(ready, (due(s, done[s]), s))
        _, s = heapq.heappop(ready)
        while phase_ends[phase] <= slot:
            phase += 1
        stretch.append((s, done[s], phase))
        done[s] += 1
        if done[s] < left[s]:
            heapq.heappush(waiting, (released(s, done[s]), s))
        if len(stretch) == period or slot == total - 1:
            yield Stretch(slot + 1 - len(stretch), stretch)
            stretch = []


def pfair_period(share: Mapping[str, int]) -> dict[str, list[int]]:
    """The slots of each source in one period of sum(share) slots."""
    slots: dict[str, list[int]] = {s: [] for s in share}
    for stretch in plan(share, share, max(1, sum(share.values()))):
        for slot, (source, _, _) in enumerate(stretch.blocks, stretch.start):
            slots[source].append(slot)
    return slots


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    rest_weight: float = 1.0,
    power: float = 0.5,
    block_rows: int = 32,
    doc_id: str = "doc_id",
    source: str = "source",
    period: int = 4096,
) -> DataFrame:
    """Every row of `docs` once, plus `mix_source`, `phase`, `block` and `position` (BIGINT).

    Rows of a source are put in hash order of their id and cut into blocks of `block_rows`.
    Blocks are the jobs of a Pfair schedule: earliest deadline first, by exact target weight, so
    that before any block each source is less than one block off its target (see `plan`). When a
    source has run out a new phase begins, in which the rest keep their proportions: nothing is
    repeated, dropped or cut to reach a weight. `position` counts the rows in schedule order; it
    has gaps where a source's last block is not full.

    `weights` names the sources that have a weight, any number of them; all others, NULL included,
    share `rest_weight` as one source. Without `weights` each source, NULL too, gets its row count
    to `power` (0: all alike, 1: as they come). `period`: slots that the schedule hands on at a
    time; the result does not depend on it. Rows with equal or NULL ids are ordered by the hash of
    all columns. Input columns called like a new one are replaced.
    """
    new = ["mix_source", "phase", "block", "position"]
    kept = docs.select(*[c for c in docs.columns if c.lower() not in new])
    spark = docs.sparkSession
    key, given, spread, tie, rank, slot = (
        fresh_name(kept, n) for n in ("key", "given", "spread", "tie", "rank", "slot")
    )
    keyed = kept.withColumn(
        key, F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(REST))
    )
    weight = F.pow(F.count(F.lit(1)), F.lit(float(power)))
    if weights is not None:
        if any(not 0 < w < math.inf for w in [*weights.values(), rest_weight]):
            raise ValueError("weights must be above 0 and finite")
        named = spark.createDataFrame(
            [(f"={s}", float(w)) for s, w in weights.items()], f"`{key}` string, `{given}` double"
        )
        keyed = keyed.join(F.broadcast(named), key, "left").withColumn(  # as large as the argument
            key, F.when(F.col(given).isNotNull(), F.col(key)).otherwise(REST)
        )
        weight = F.coalesce(F.max(given), F.lit(float(rest_weight)))
    sources = keyed.groupBy(key).agg(
        F.expr(f"(count(1) + {block_rows - 1}) div {block_rows}").alias("blocks"),
        weight.alias("weight"),
    )
    sources = materialise(sources, "mix-sources")
    schedule = materialise(
        _schedule(sources, period).toDF(key, "block", "phase", slot), "mix-schedule"
    )
    ranked = number_rows(
        keyed.withColumn(spread, F.xxhash64(doc_id, F.lit("mix"))).withColumn(
            tie, F.xxhash64(*kept.columns)
        ),
        [key],
        [spread, tie],
        rank,
    ).withColumn("block", F.expr(f"`{rank}` div {block_rows}"))
    placed = ranked.join(schedule, [key, "block"]).withColumn(
        "position", F.expr(f"`{slot}` * {block_rows} + `{rank}` % {block_rows}")
    )
    return placed.select(
        *kept.columns,
        F.when(F.col(key) != REST, F.substring(key, 2, 1 << 30)).alias("mix_source"),
        "phase",
        "block",
        "position",
    )


def _schedule(sources: DataFrame, period: int) -> DataFrame:
    """source, block, phase and slot of every block of the sources (name, blocks, weight).

    One task walks through the slots, as each choice depends on the ones before it; it holds the
    sources and one stretch, and steps once per block and not per row.
    """
    names = ["source", "block", "phase", "slot"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, int] = {}
        weights: dict[str, float] = {}
        for part in parts:
            found, count, weight = (c.to_pylist() for c in part.columns)
            blocks.update(zip(found, count, strict=True))
            weights.update(zip(found, weight, strict=True))
        for stretch in plan(blocks, weights, period):
            source, block, phase = zip(*stretch.blocks, strict=True)
            slots = range(stretch.start, stretch.start + stretch.length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(source, pa.string()), *(pa.array(c, pa.int64()) for c in (block, phase, slots))],
                names,
            )

    schema = "source string, block bigint, phase bigint, slot bigint"
    return sources.coalesce(1).mapInArrow(batches, schema)
