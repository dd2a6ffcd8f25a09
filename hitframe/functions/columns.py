"""Scalar column expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitframe.config import Box

_TWO31 = 2147483648
_TWO32 = 4294967296
# One multiplier per independent draw (odd 32-bit constants).
_DRAWS = (2654435761, 2246822519, 3266489917)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_key(*cols: Column | str) -> Column:
    """Long key of a hit, from the columns that identify it."""
    return F.xxhash64(*[_col(c) for c in cols])


def keyed_uniform(key: Column | str, draw: int = 0) -> Column:
    """Reproducible number in [0, 1) from a long key.

    The key is reduced first so that the product always fits a long.
    """
    product = F.pmod(_col(key), F.lit(_TWO31)) * F.lit(_DRAWS[draw])
    return (product % F.lit(_TWO32)).cast("double") / F.lit(float(_TWO32))


def dither(mode: str, key: Column | str | None = None, draw: int = 0, seed: int = 0) -> Column:
    """Fraction of a tick to add to an integer reading.

    ``keyed`` depends only on the hit, so a retried task gives the same values;
    ``rand`` is Spark's seeded generator; ``mid`` is the centre of the tick.
    """
    if mode == "keyed":
        return keyed_uniform(key, draw)
    if mode == "rand":
        return F.rand(seed + draw)
    if mode == "mid":
        return F.lit(0.5)
    raise ValueError(f"unknown dither mode {mode!r}")


def ticks_to_ns(ticks: Column | str, u: Column | str, tick_ns: float) -> Column:
    return (_col(ticks) + _col(u)) * F.lit(tick_ns)


def linear(value: Column | str, gain: Column | str, offset: Column | str) -> Column:
    return _col(value) * _col(gain) + _col(offset)


def asymmetry(a: Column | str, b: Column | str) -> Column:
    """(a - b) / (a + b), null where the sum is zero."""
    a, b = _col(a), _col(b)
    return F.try_divide(a - b, a + b)


def mean_of(cols: list[Column | str]) -> Column:
    """Row mean; null if any input is null."""
    return reduce(add, [_col(c) for c in cols]) / F.lit(float(len(cols)))


def inside(value: Column | str, bounds: tuple[float, float]) -> Column:
    """Strictly between the bounds."""
    value = _col(value)
    return (value > F.lit(float(bounds[0]))) & (value < F.lit(float(bounds[1])))


def in_box(charge: Column | str, timing: Column | str, box: Box) -> Column:
    return inside(charge, box.charge) & inside(timing, box.timing)


def flip_even_channels(edge: Column | str, ch: Column | str) -> Column:
    edge, ch = _col(edge), _col(ch)
    return F.when(ch % 2 == 0, 1 - edge).otherwise(edge)
