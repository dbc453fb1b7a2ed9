"""What of a batch an append has to move: the slots with news, each report once, as narrow rows.

A batch is first counted by slot, with a digest of its keys. Slots whose count and digest the table
holds already are left out before a row moves, so a replay costs two scans. Of the others every
report crosses the network once: the exchange that brings copies and stored keys together is also
the one that lays the rows out by date.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellhours.functions.timeslots import slot_floor, utc_date
from cellhours.schemas import OBSERVATION_KEY, OBSERVATIONS, SLOT

DATE = "slot_date"
ROWS_PER_TASK = 400_000
# How reports are written. Nearly every time is a new one, so a dictionary of them is built in vain.
REPORT_FILES = {"compression": "zstd", "parquet.enable.dictionary#observed_at": "false"}
_PART = "_part"
_STORED = "_stored"

# NULL is a value of its own here, so a hash takes in which fields are NULL.
_MARKED = [f"{c}, isnull({c})" for c in OBSERVATION_KEY if c != SLOT]
_HASHES = [f"xxhash64({', '.join(fields)})" for fields in (_MARKED, _MARKED[::-1])]
_DIGEST = {
    "_rows": "count(1)",
    # Halves, because the sum of whole hashes would leave the range of a BIGINT.
    **{f"_low_{i}": f"sum({h} & 4294967295L)" for i, h in enumerate(_HASHES)},
    **{f"_high_{i}": f"sum(shiftrightunsigned({h}, 32))" for i, h in enumerate(_HASHES)},
}

# Whole numbers 17 bits each (0: NULL), then two bits for the flag, one for "the slot is the hour
# of the report" and one for "this is a stored key". A row of the exchange has five fields less.
_WHOLE = ("nic", "nac_p", "sil")
_FLAG, _HOUR, _KEPT = 51, 53, 54
_WORDS = ["aircraft_type", "sample_point", "ingest_run_id"]
_NUMBERS = ["altitude_ft", "lat", "lon", "observed_at", "hex"]


def slot_digests(rows: DataFrame) -> DataFrame:
    """Per slot: how many rows there are, and sums over two 64-bit hashes of their keys."""
    return rows.groupBy(SLOT).agg(*[F.expr(sql).alias(name) for name, sql in _DIGEST.items()])


def slots_with_news(mine: DataFrame, theirs: DataFrame | None) -> DataFrame:
    """Slots of a batch that are not stored as they are: slot, rows, and whether any row is stored."""
    if theirs is None:
        return mine.select(SLOT, "_rows", F.lit(False).alias(_STORED))
    held = theirs.select(*[F.col(c).alias(f"_held{c}") for c in theirs.columns])
    joined = mine.join(held, F.col(SLOT).eqNullSafe(F.col(f"_held{SLOT}")), "left")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_held{c}")) for c in _DIGEST])
    return joined.filter(~same).select(SLOT, "_rows", F.col("_held_rows").isNotNull().alias(_STORED))


def only_slots(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """The rows of some slots. There is one slot an hour, so their list may be broadcast."""
    wanted = F.broadcast(slots.select(F.col(SLOT).alias("_wanted")))
    return rows.join(wanted, F.col(SLOT).eqNullSafe(F.col("_wanted")), "left_semi")


def _packed(rows: DataFrame, stored: bool, parts: int) -> DataFrame:
    whole = [
        f"shiftleft(coalesce(cast({c} AS bigint) + 32769L, 0L), {17 * i})"
        for i, c in enumerate(_WHOLE)
    ]
    bits = [
        *whole,
        f"shiftleft(CASE WHEN is_control_region THEN 2L WHEN NOT is_control_region THEN 1L ELSE 0L END, {_FLAG})",
        f"shiftleft(if({SLOT} <=> _hour, 1L, 0L), {_HOUR})",
        f"shiftleft({int(stored)}L, {_KEPT})",
    ]
    return rows.withColumn("_hour", slot_floor("observed_at")).select(
        utc_date(SLOT).alias(DATE),
        F.expr(f"cast(pmod({_HASHES[0]}, {parts}L) AS int)").alias(_PART),
        F.expr(f"if({SLOT} <=> _hour, NULL, {SLOT})").alias("_slot"),
        F.expr(" + ".join(bits)).alias("_bits"),
        *_WORDS,
        *_NUMBERS,
    )


def _unpacked(rows: DataFrame) -> DataFrame:
    def bits(start: int, mask: int) -> str:
        return f"(shiftright(_bits, {start}) & {mask}L)"

    columns = {
        c: F.expr(f"cast(nullif({bits(17 * i, 131071)}, 0L) - 32769L AS smallint)")
        for i, c in enumerate(_WHOLE)
    }
    columns[SLOT] = F.when(F.expr(f"{bits(_HOUR, 1)} = 1"), slot_floor("observed_at")).otherwise(
        F.col("_slot")
    )
    columns["is_control_region"] = F.expr(f"nullif({bits(_FLAG, 3)}, 0L) = 2")
    return rows.withColumns(columns).select(
        DATE, _PART, F.expr(f"{bits(_KEPT, 1)} = 1").alias(_STORED), *OBSERVATIONS.names
    )


def absent_rows(
    batch: DataFrame, keys: DataFrame | None, tasks: int, parts: int, order: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key of the batch that is not among `keys`, laid out and sorted by date.

    Of the rows of a key the smallest by `order` is taken, ties broken by the other columns, NULL
    first. A date is cut by key into `parts`. Copies of a key are sorted together and passed one by
    one, so a key with very many of them fills no memory.
    """
    rows = _packed(batch, False, parts)
    if keys is not None:
        empty = [
            F.col(f.name) if f.name in OBSERVATION_KEY else F.lit(None).cast(f.dataType).alias(f.name)
            for f in OBSERVATIONS.fields
        ]
        rows = rows.unionByName(_packed(keys.select(*empty), True, parts))
    rest = [c for c in OBSERVATIONS.names if c not in OBSERVATION_KEY]
    ranked = [*order, *[c for c in rest if c not in order]]
    placed = _unpacked(rows.repartition(tasks, DATE, _PART))
    # A ranking that asks for the first row only keeps one row of a key at a time.
    copies = Window.partitionBy(DATE, _PART, *OBSERVATION_KEY).orderBy(~F.col(_STORED), *ranked)
    best = placed.withColumn("_rank", F.row_number().over(copies)).filter("_rank = 1")
    return best.filter(~F.col(_STORED)).select(*OBSERVATIONS.names, DATE)


def on_days(days: list[str]) -> Column:
    """Rows whose date is one of `days`, which prunes the folders of a stored table."""
    return F.col(DATE).isin([F.lit(d).cast("date") for d in days])
