"""Altitude as the feed reports it: a number in feet, or the word "ground"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def altitude_ft(raw: Column) -> Column:
    """Numbers only. Words, booleans, numeric text, null and absent values give NULL, never 0.

    The variant's own type decides, because a cast would also accept ``"35000"`` and ``true``.
    """
    numeric = F.schema_of_variant(raw).rlike(r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(numeric, F.variant_get(raw, "$", "double"))
