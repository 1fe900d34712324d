"""Small column expressions shared by every operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bar sizes and their length in seconds.
BAR_SECONDS = {"5m": 300, "1h": 3600, "4h": 14400, "1d": 86400}

_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}


def bar_seconds(size: str) -> int:
    """Length of a bar size such as ``5m`` or ``4h``."""
    count, unit = size[:-1], size[-1:]
    if not count.isdigit() or unit not in _UNIT_SECONDS or int(count) == 0:
        raise ValueError(f"unknown bar size: {size!r}")
    return int(count) * _UNIT_SECONDS[unit]


def bar_seconds_col(interval: Column) -> Column:
    """Same as :func:`bar_seconds`, for a column of bar sizes; null when it cannot be read."""
    count = F.try_to_number(F.regexp_extract(interval, r"^(\d{1,9})[smhd]$", 1), F.lit("999999999")).cast("long")
    unit = F.substring(interval, -1, 1)
    scale = reduce(
        lambda chain, item: chain.when(unit == item[0], item[1]),
        list(_UNIT_SECONDS.items())[1:],
        F.when(unit == "s", 1),
    )
    return count * scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def hash32(*parts: Column) -> Column:
    """Repeatable pseudo-random integer in [0, 2**32): first eight hex digits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def to_number(value: Column) -> Column:
    """Number or null; dirty text never fails the job."""
    return value.try_cast("double")


def day_of_week(ts: Column) -> Column:
    """Monday is 0, Sunday is 6."""
    return F.weekday(ts)
