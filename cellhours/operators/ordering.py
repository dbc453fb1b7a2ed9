"""Total-order operators without a single-task window.

Rows are cut into blocks by value. Each block is a window partition of its own; what a block
needs from the ones before it is one summary row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellhours.sources.scratch import materialise

_BLOCK = "_block"


def with_previous(
    df: DataFrame, block: Column, order: list[str], value: Column, out: str
) -> DataFrame:
    """Add `value` of the row before in the order (block, order); NULL on the first row.

    `block` must not decrease along the order, and there must be few enough blocks for one
    summary row each (days, say) to fit a task.
    """
    tagged = df.withColumn(_BLOCK, block).withColumn("_value", F.struct(value.alias("v")))
    inside = Window.partitionBy(_BLOCK).orderBy(*order)
    last = tagged.groupBy(_BLOCK).agg(F.max_by("_value", F.struct(*order)).alias("_last"))
    carried = last.select(_BLOCK, F.lag("_last").over(Window.orderBy(_BLOCK)).alias("_carried"))
    return (
        tagged.withColumn("_before", F.lag("_value").over(inside))
        .join(carried, _BLOCK, "left")
        .withColumn(out, F.coalesce("_before", "_carried").getField("v"))
        .drop(_BLOCK, "_value", "_before", "_carried")
    )


def _step_sql(key: str) -> str:
    """A BIGINT that never falls as a numeric key grows: 2^36 steps per power of two.

    Zero is step 0, the steps of negative keys are those of their absolute values mirrored.
    Infinity and NaN share the highest step.
    """
    size = f"least(abs(cast({key} AS double)), 1.7e308D)"
    power = f"floor(log2({size}))"
    inside = f"({size} / pow(2D, {power}) - 1D) * {float(1 << 36)!r}D"
    step = (
        f"({power} + 1075L) * {1 << 36}L + 1L"
        f" + cast(least(greatest({inside}, 0D), {float((1 << 36) - 1)!r}D) AS bigint)"
    )
    return f"CASE WHEN {key} = 0 THEN 0L WHEN {key} < 0 THEN -({step}) ELSE {step} END"


def running_totals(
    df: DataFrame, key: str, columns: list[str], descending: bool = False
) -> DataFrame:
    """Cumulative sums `cum_<column>` in order of a unique numeric key.

    The key is cut into steps of relative width 2^-36, 65 536 steps make a stretch, 65 536
    stretches a block, and there are at most some 70 000 blocks. Sums run inside each of them and
    then meet the sums ahead, so no task orders more than about 65 536 doubles at once, however
    they are crowded. Steps follow from the key alone, not from a sample, and a task that is run
    again meets the same steps. All levels read one stored copy of the rows.
    """
    sums = [F.sum(c).alias(c) for c in columns]

    def summed(order: str, last: int, *group: str) -> list[Column]:
        by = F.desc(order) if descending else F.asc(order)
        window = Window.partitionBy(*group).orderBy(by)
        frame = window.rowsBetween(Window.unboundedPreceding, last)
        return [F.coalesce(F.sum(c).over(frame), F.lit(0)).alias(f"_in_{c}") for c in columns]

    def added(out: str) -> list[Column]:
        return [(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"{out}{c}") for c in columns]

    rows = materialise(
        df.select(key, *columns, F.expr(_step_sql(f"`{key}`")).alias("_step")), "running-totals"
    )
    steps = rows.groupBy("_step").agg(*sums).withColumn("_stretch", F.shiftright("_step", 16))
    stretches = (
        steps.groupBy("_stretch").agg(*sums).withColumn(_BLOCK, F.shiftright("_stretch", 16))
    )
    blocks = stretches.groupBy(_BLOCK).agg(*sums)
    # The range of a double bounds the number of blocks: safe to broadcast at any scale.
    ahead = blocks.select(_BLOCK, *summed(_BLOCK, -1)).withColumnsRenamed(
        {f"_in_{c}": f"_off_{c}" for c in columns}
    )
    ahead = (
        stretches.select("_stretch", _BLOCK, *summed("_stretch", -1, _BLOCK))
        .join(F.broadcast(ahead), _BLOCK)
        .select("_stretch", *added("_off_"))
    )
    ahead = (
        steps.select("_step", "_stretch", *summed("_step", -1, "_stretch"))
        .join(ahead, "_stretch")
        .select("_step", *added("_off_"))
    )
    inside = rows.select("_step", key, *columns, *summed(key, Window.currentRow, "_step"))
    return inside.join(ahead, "_step").select(key, *columns, *added("cum_"))


def average_ranks(df: DataFrame, value: str, out: str) -> DataFrame:
    """Rank of every distinct value, ties sharing their mean rank."""
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(counted, value, ["n"])
    return ranked.select(
        value, (F.col("cum_n") - (F.col("n") - F.lit(1)) / F.lit(2.0)).alias(out)
    )
