"""Position expressions, built from plain numbers and columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import _col


def _staggered(id1: Column, id2: Column, drift: Column, shift: float, half_cell: float) -> Column:
    """True where the hit lies on the usual side of its wire.

    With a positive shift that side is the one two *different* wire ids point to,
    otherwise the one *equal* ids point to; a partner drift length within
    ``abs(shift)`` of the cell edge also selects it.
    """
    usual = (id1 != id2) if shift > 0 else (id1 == id2)
    return usual | (drift > F.lit(half_cell - abs(shift)))


def wire_coordinate(wire_id: Column | str, centre: float, cell: float, shift: float = 0.0) -> Column:
    return (_col(wire_id) - F.lit(centre)) * F.lit(cell) + F.lit(shift)


def left_right(
    id1: str, dl1: str, id2: str, dl2: str, shift: float, cell: float, centres: tuple[float, float]
) -> tuple[Column, Column]:
    """Positions on both planes of a staggered pair.

    A missing partner drift length leaves the usual-side test undecided, which
    counts as "other side"; a missing own drift length gives null.
    """
    i1, d1, i2, d2 = map(_col, (id1, dl1, id2, dl2))
    half = cell / 2.0
    sign = 1.0 if shift > 0 else -1.0
    wire1 = wire_coordinate(i1, centres[0], cell)
    wire2 = wire_coordinate(i2, centres[1], cell, shift)
    side1 = F.when(_staggered(i1, i2, d2, shift, half), F.lit(sign)).otherwise(F.lit(-sign))
    side2 = F.when(_staggered(i1, i2, d1, shift, half), F.lit(-sign)).otherwise(F.lit(sign))
    return wire1 + side1 * d1, wire2 + side2 * d2


def shifted_drift(id1: str, dl1: str, id2: str, dl2: str, shift: float, cell: float) -> Column:
    """Drift length of the second plane with the shift folded in."""
    i1, d1, i2, d2 = map(_col, (id1, dl1, id2, dl2))
    step = F.lit(abs(shift))
    usual = _staggered(i1, i2, d1, shift, cell / 2.0)
    return F.when(usual, d2 - step).otherwise(d2 + step)


def extrapolate(
    up: Column | str, down: Column | str, z_up: float, z_down: float, z: float, mirror: bool
) -> Column:
    """Straight line through two stations, evaluated at ``z``.

    ``mirror`` flips the sign, as the x views are mirrored.
    """
    l1, l2 = z_up - z, z_down - z
    value = (_col(up) * F.lit(l2) - _col(down) * F.lit(l1)) / F.lit(abs(l1) + abs(l2))
    return -value if mirror else value


def strip_inset(id0: Column | str, id1: Column | str, depth: Column | str) -> Column:
    """Signed distance from the strip edge: positive towards higher ids."""
    depth = _col(depth)
    return F.when(_col(id1) == _col(id0) + 1, depth).otherwise(-depth)


def strip_position(
    id0: Column | str, inset: Column | str, centre: int, half_strip: float, mirror_fix: bool = False
) -> Column:
    """Position from the leading strip and the inset.

    Positions fall with the strip id while the inset rises with it; ``mirror_fix``
    turns the inset round so that both point the same way.
    """
    pitch = F.lit(abs(half_strip) * 2.0)
    inset = -_col(inset) if mirror_fix else _col(inset)
    return (F.lit(float(centre)) - _col(id0)) * pitch + inset - F.lit(half_strip)
