"""Slot arithmetic on instants. Nothing here depends on the session time zone.

Most helpers take the name of a timestamp column and return a column. They are written as SQL
text because a whole formula is then one call into the JVM, where the same formula built call by
call costs a round trip per operator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellhours.config import DEFAULT_RULES, Rules


def slot_floor(ts: str, rules: Rules = DEFAULT_RULES) -> Column:
    """Start of the UTC slot an instant falls into (also before 1970)."""
    micros = f"unix_micros({ts})"
    return F.expr(f"timestamp_micros({micros} - pmod({micros}, {rules.slot_micros}L))")


def hour_index_sql(ts: str) -> str:
    seconds = f"unix_seconds({ts})"
    return f"cast(({seconds} - pmod({seconds}, 3600)) div 3600 as int)"


def hour_index(ts: str) -> Column:
    """Whole hours since the epoch; the integer that RANGE frames are ordered by."""
    return F.expr(hour_index_sql(ts))


def hour_of_day(ts: str) -> Column:
    return F.expr(f"pmod({hour_index_sql(ts)}, 24)")


def day_of_week(ts: str) -> Column:
    """Monday = 0. 1970-01-01 was a Thursday, weekday 3."""
    return F.expr(f"cast(pmod(floor(unix_seconds({ts}) / 86400) + 3, 7) as int)")


def utc_date(ts: str | Column) -> Column:
    if isinstance(ts, str):
        return F.expr(f"date_from_unix_date(cast(floor(unix_seconds({ts}) / 86400) as int))")
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / F.lit(86_400)).cast("int"))


def utc_text(ts: str, pattern: str) -> Column:
    """Format an instant in UTC, whatever zone the session uses."""
    naive = f"convert_timezone(current_timezone(), 'UTC', cast({ts} as timestamp_ntz))"
    return F.date_format(F.expr(naive), pattern)


def plus_minutes(ts: Column, minutes: int | Column) -> Column:
    minutes = F.lit(minutes) if isinstance(minutes, int) else minutes
    return F.timestamp_micros(F.unix_micros(ts) + minutes.cast("bigint") * F.lit(60_000_000))


def hours_between(earlier: Column, later: Column) -> Column:
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return micros.cast("double") / F.lit(3.6e9)


def instant_from_utc(naive: str) -> Column:
    """Read a zone-less timestamp column as UTC."""
    since = f"cast({naive} - timestamp_ntz'1970-01-01 00:00:00' as interval second)"
    return F.expr(f"timestamp_micros(cast(cast({since} as decimal(20,6)) * 1000000 as bigint))")
