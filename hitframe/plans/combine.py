"""Both detectors together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitframe.config import FRAME, WireConfig
from hitframe.functions import extrapolate
from hitframe.sources import select_by_suffix


def join_detectors(
    strips: DataFrame, wires: DataFrame, frame: tuple[str, ...] = FRAME
) -> DataFrame:
    """Frames seen by both. Each side has one row per frame, so no frame is heavy
    and the join is left to the adaptive planner."""
    left = select_by_suffix(strips, frame, ("_pos_x", "_pos_y"))
    right = select_by_suffix(wires, frame, ("_x", "_y"))
    return left.join(right, list(frame))


def detector_residuals(joined: DataFrame, cfg: WireConfig, z: float = 0.0) -> DataFrame:
    """Strip position minus the wire track at the strip detector, per axis."""
    up, down = list(cfg.detectors)[:2]
    rows = []
    for axis, mirror in (("x", True), ("y", False)):
        z_up, z_down = getattr(cfg.upstream, axis), getattr(cfg.downstream, axis)
        track = extrapolate(f"{up}_{axis}", f"{down}_{axis}", z_up, z_down, z, mirror)
        rows.append(
            F.struct(
                F.lit(axis).alias("axis"),
                F.col(f"sr_pos_{axis}").alias("pos"),
                track.alias("track"),
                (F.col(f"sr_pos_{axis}") - track).alias("diff"),
            )
        )
    return joined.select(*cfg.frame, F.inline(F.array(*rows)))
