"""Time helpers on zone-less timestamps. None depends on the session time zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)


def at(moment: datetime) -> Column:
    """A zone-less timestamp literal (``F.lit`` of a datetime would carry a zone)."""
    if moment.tzinfo is not None:
        raise ValueError("give the clock as a UTC datetime without tzinfo")
    return F.expr(f"timestamp_ntz'{moment.isoformat(sep=' ')}'")


def acceptance_limit(as_of: datetime) -> Column:
    """Latest posting time that does not count as being in the future."""
    return at(as_of + timedelta(days=1))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Exact seconds from ``start`` to ``end`` with six decimals."""
    return (end - start).cast("interval second").cast("decimal(20,6)")


def second_boundaries(start: Column, end: Column) -> Column:
    """How many whole-second boundaries lie between the two (not the truncated difference)."""
    ticks = [F.floor(elapsed_seconds(at(EPOCH), moment)).cast("long") for moment in (start, end)]
    return ticks[1] - ticks[0]


def lag_minutes(moment: Column, as_of: datetime) -> Column:
    """Whole minutes from ``moment`` to ``as_of``, rounded down (also below zero); null stays null."""
    return F.floor(elapsed_seconds(moment, at(as_of)) / F.lit(60)).cast("long")


def period_of(moment: Column, grain: str) -> Column:
    """Storage period of a timestamp: its day, or the first day of its month or year."""
    day = moment.cast("date")
    if grain == "day":
        return day
    if grain in ("month", "year"):
        return F.trunc(day, grain)
    raise ValueError(f"grain must be 'day', 'month' or 'year', not {grain!r}")
