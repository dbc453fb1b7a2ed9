"""Array expressions that the built-in functions lack, as plain Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256  # numbers that are summed by appending one at a time


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _appended(lengths: Column) -> Column:
    """0, and the running sums after it; every step copies what there is."""
    return F.aggregate(
        lengths,
        F.array(F.lit(0)),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)),
    )


def prefix_sums(lengths: Column) -> Column:
    """Inclusive running sums of an array of integers, chunk by chunk."""

    def joined(parts: Column) -> Column:
        return let(
            _appended(F.transform(parts, lambda p: F.element_at(p, -1))),
            lambda offsets: F.flatten(
                F.transform(
                    parts,
                    lambda p, c: F.transform(
                        F.slice(p, 2, CHUNK), lambda x: x + F.get(offsets, c)
                    ),
                )
            ),
        )

    return let(
        lengths,
        lambda a: F.when(F.size(a) == 0, a).otherwise(
            let(
                F.transform(
                    F.sequence(F.lit(0), F.floor((F.size(a) - 1) / CHUNK).cast("int")),
                    lambda c: _appended(F.slice(a, c * CHUNK + 1, CHUNK)),
                ),
                joined,
            )
        ),
    )
