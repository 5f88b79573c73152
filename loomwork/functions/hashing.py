"""Repeatable randomness: every draw is a function of the row's key and a seed.

md5 is used because any engine computes the same digest, so a split or a
mask can be checked elsewhere and is the same after a task is retried.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 4294967296.0  # 2**32: eight hex digits


def digest(*parts) -> Column:
    """md5 hex of the parts joined by ':'; parts are columns or plain values."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in columns]))


def number_in(hexed: Column, group: int = 0) -> Column:
    """The group-th eight digits of a digest as a number (four groups, from 0)."""
    return F.conv(F.substring(hexed, 8 * group + 1, 8), 16, 10).cast("long")


def share_of(hexed: Column, group: int = 0) -> Column:
    """The same digits as a double in [0, 1)."""
    return number_in(hexed, group).cast("double") / F.lit(SPAN)


def below(hexed: Column, group, share: float) -> Column:
    """Whether the draw of a digit group is below ``share``, compared as digits."""
    place = 8 * group + 1
    digits = F.substr(hexed, place if isinstance(place, Column) else F.lit(place), F.lit(8))
    return digits < F.lit(f"{round(share * SPAN):08x}")


def coin(*parts) -> Column:
    """Uniform double in [0, 1)."""
    return share_of(digest(*parts))


def draw_int(limit, *parts) -> Column:
    """Integer in 0..limit, limit included, from 60 bits of the digest."""
    top = limit if isinstance(limit, Column) else F.lit(int(limit))
    drawn = F.conv(F.substring(digest(*parts), 1, 15), 16, 10).cast("long")
    return drawn % (top.cast("long") + F.lit(1))


def draw_between(low: float, high: float, *parts) -> Column:
    """Uniform double in [low, high)."""
    return F.lit(float(low)) + coin(*parts) * F.lit(float(high) - float(low))
