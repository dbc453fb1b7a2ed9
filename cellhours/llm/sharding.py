"""Weighted rendezvous hashing of records to shards, in DataFrame expressions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellhours.llm.common import fresh_name, number_rows

_SPREAD = 1 << 53


def rendezvous_shard(key: str, weights: Sequence[float]) -> Column:
    """The shard with the least -ln(u) / weight, u in (0, 1) from a hash of (key, shard).

    A shard wins with a probability in proportion to its weight. Its draw does not depend on the
    other shards, so a new shard only takes the records for which its own draw is the least, and
    a changed weight only moves records to or from that shard. Equal draws go to the lower shard.
    `weights` are positive; NULL keys are hashed like a value.
    """
    if not weights or any(not (w > 0 and math.isfinite(w)) for w in weights):
        raise ValueError("weights must be positive numbers")
    draws = ", ".join(
        "struct(-ln((shiftrightunsigned(xxhash64(`{k}`, {s}), 11) + 0.5D) / {n}D) / {w!r}D AS d, {s} AS s)".format(
            k=key, s=shard, n=_SPREAD, w=float(weight)
        )
        for shard, weight in enumerate(weights)
    )
    return F.expr(f"least({draws}).s" if len(weights) > 1 else "0")


def shard_records(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * 24,
    doc_id: str = "doc_id",
    text: str = "text",
    grown_weight: float | None = 1.0,
) -> DataFrame:
    """Every row of `docs`, plus size, text_crc32, shard, slot and grown_shard.

    `size` is the UTF-8 length of the text plus 8 (a NULL text counts as empty), `text_crc32` its
    CRC-32. The shard is decided by the id and the weights alone, so equal ids stay together. A
    row with a NULL id takes the hash of its text for a key: a record without an id is only as
    stable as its content, and a great many of them still spread. `slot` numbers the rows of a
    shard from 0 in hash order, without a task that sees a whole shard. `grown_shard` is the
    shard after one more of weight `grown_weight` is added (NULL without one). Repeated rows are
    numbered one after the other. Input columns called like a new one are replaced.
    """
    new = ["size", "text_crc32", "shard", "slot", "grown_shard"]
    others = [c for c in docs.columns if c.lower() not in new]
    body, key, spread, slot = (fresh_name(docs, n) for n in ("body", "key", "spread", "slot"))
    if text not in others or doc_id not in others:
        raise ValueError("the id and text columns cannot be called like a new column")
    bytes_of = F.coalesce(F.col(text), F.lit("")).cast("binary")
    grown = (
        rendezvous_shard(key, [*weights, grown_weight])
        if grown_weight
        else F.lit(None).cast("int")
    )
    placed = (
        docs.select(*others)
        .withColumn(key, F.coalesce(F.col(doc_id).cast("string"), F.sha2(bytes_of, 256)))
        .withColumn("size", F.octet_length(bytes_of).cast("bigint") + F.lit(8))
        .withColumn("text_crc32", F.crc32(bytes_of))
        .withColumn("shard", rendezvous_shard(key, weights))
        .withColumn("grown_shard", grown)
        .withColumn(spread, F.xxhash64(key, F.lit("slot"), "text_crc32"))
        .drop(key)
    )
    return number_rows(placed, ["shard"], [spread, "text_crc32", "size"], slot).select(
        *others, "size", "text_crc32", "shard", F.col(slot).alias("slot"), "grown_shard"
    )
