"""Wire chambers: readout blocks -> events -> positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitframe.config import WireConfig
from hitframe.functions import (
    extrapolate,
    keyed_uniform,
    left_right,
    mean_of,
    row_key,
    shifted_drift,
)
from hitframe.operators import curves as curve_ops
from hitframe.operators import frames, hits
from hitframe.operators.skew import by_size
from hitframe.sources import materialise

_LEADING_VALUES = ["id", "charge", "timing"]


def trigger_times(blocks: DataFrame, cfg: WireConfig, dither: str = "keyed") -> DataFrame:
    """Earliest anode hit of each frame, as a table."""
    anode = hits.anode_hits(blocks, cfg, dither)
    first = hits.earliest_row(anode, "tcal", ["tdc_raw"], cfg.frame)
    return hits.staged_time_zero(
        first.select(
            *cfg.frame, F.col("tcal").alias("sra_timing"), F.col("tdc_raw").alias("sra_tdc_raw")
        )
    )


def mapped_hits(
    raw: DataFrame, triggers: DataFrame, chmap: DataFrame, cfg: WireConfig, rows: int | None = None
) -> DataFrame:
    """Hits of triggered frames on known channels that pass the cuts.

    The map goes first: unmapped channels leave before the shuffle on the frame.
    """
    known = hits.map_channels(raw, hits.wire_channel_map(chmap, cfg), ["femId", "ch"], rows)
    timed = triggers.withColumn("t0", F.col("sra_timing"))
    return hits.subtract_time_zero(known, timed, cfg.frame).where(hits.wire_cut(cfg))


def leading_hits(mapped: DataFrame, cfg: WireConfig) -> DataFrame:
    """Leading hit per frame and plane; the trigger columns ride along."""
    return frames.leading_hit(
        mapped,
        [*cfg.frame, "plane"],
        [*_LEADING_VALUES, "sra_timing", "sra_tdc_raw"],
        ["id", "timing"],
    ).withColumnsRenamed({"sra_timing0": "sra_timing", "sra_tdc_raw0": "sra_tdc_raw"})


def complete_leads(mapped: DataFrame, cfg: WireConfig) -> DataFrame:
    """Leading hits of the frames in which every plane has one.

    The calibration and the drift lengths are defined on these alone. A frame has one
    lead per plane at most and they are placed by frame already, so counting them takes
    neither a join nor another shuffle.
    """
    planes = F.count(F.lit(1)).over(Window.partitionBy(*cfg.frame))
    counted = leading_hits(mapped, cfg).withColumn("_planes", planes)
    return counted.where(F.col("_planes") == len(cfg.planes)).drop("_planes")


def events(leads: DataFrame, cfg: WireConfig, values: list[str] | None = None) -> DataFrame:
    """One row per frame in which every plane has a hit."""
    return frames.one_row_per_frame(
        leads,
        "plane",
        cfg.planes,
        values or ["size", "id0", "charge0", "timing0"],
        "{member}_{value}",
        cfg.frame,
        carry=("sra_timing", "sra_tdc_raw"),
        require_all=True,
    )


def event_hits(
    raw: DataFrame, triggers: DataFrame, chmap: DataFrame, cfg: WireConfig, rows: int | None = None
) -> DataFrame:
    """The hit lists of the events: all their hits with the rank in charge order.

    The hits after the cuts are read several times here, so they become a table. Small
    frames are moved once, for the coincidence and the ranks.
    """

    def lists(mapped: DataFrame, whole: bool) -> DataFrame:
        kept = frames.coincident_hits(mapped, cfg.planes, cfg.frame, whole)
        return frames.ranked_hits(kept, [*cfg.frame, "plane"], frames.by_charge("charge", "id", "timing"), whole)

    mapped = materialise(mapped_hits(raw, triggers, chmap, cfg, rows), "mapped-hits")
    few, many = by_size(mapped, list(cfg.frame))
    ranked = lists(few, True)
    return ranked if many is None else ranked.unionByName(lists(many, False))


def drift_lengths(
    leads: DataFrame,
    curves: DataFrame,
    cfg: WireConfig,
    rows: int | None = None,
    u: Column | None = None,
    curve_keys: tuple[str, ...] = ("plane",),
) -> DataFrame:
    """Drift length ``dl`` of each leading hit; null outside the curve of its plane.

    All planes at once in long form. The curves are broadcast, so the hits keep
    their placement by frame for the step that makes them wide. ``u`` is the
    fraction of the curve interval, by default drawn from the frame and plane, or
    with ``cfg.exact_fraction`` the exact one; ``rows`` bounds the curve points if known;
    ``curve_keys`` adds the run where each has curves of its own.
    """
    if u is None and not cfg.exact_fraction:
        u = keyed_uniform(row_key(*cfg.frame, "plane"), 2)
    return curve_ops.curve_lookup(
        leads, curves, list(curve_keys), "timing0", u, cfg.half_cell, "dl", rows
    )


def drift_events(
    leads: DataFrame,
    curves: DataFrame,
    cfg: WireConfig,
    rows: int | None = None,
    u: Column | None = None,
    curve_keys: tuple[str, ...] = ("plane",),
) -> DataFrame:
    """Events with ``dl`` next to the leading hit of every plane."""
    values = ["dl", "id0", "charge0", "timing0"]
    return events(drift_lengths(leads, curves, cfg, rows, u, curve_keys), cfg, values)


def with_positions(wide: DataFrame, cfg: WireConfig) -> DataFrame:
    """Add ``<plane>_posi`` and the mean of every detector view."""
    cols = {}
    for pair in cfg.pairs:
        a, b = pair.first, pair.second
        pos = left_right(
            f"{a}_id0", f"{a}_dl", f"{b}_id0", f"{b}_dl", pair.shift, cfg.cell, cfg.centre_ids
        )
        for plane, p in zip((a, b), pos):
            move = cfg.layer_shift.get(plane)
            cols[f"{plane}_posi"] = p if move is None else p + F.lit(move)
    wide = wide.withColumns(cols)
    return wide.withColumns(
        {view: mean_of([f"{p}_posi" for p in planes]) for view, planes in cfg.views.items()}
    )


def with_targets(positions: DataFrame, cfg: WireConfig) -> DataFrame:
    """Add the straight line at every target plane; x is mirrored, y is not."""
    up, down = list(cfg.detectors)[:2]
    cols = {}
    for name, z in cfg.targets.items():
        for axis, mirror in (("x", True), ("y", False)):
            z_up, z_down = getattr(cfg.upstream, axis), getattr(cfg.downstream, axis)
            cols[f"{axis}_{name}"] = extrapolate(
                f"{up}_{axis}", f"{down}_{axis}", z_up, z_down, z, mirror
            )
    return positions.withColumns(cols)


def positions(
    blocks: DataFrame,
    chmap: DataFrame,
    curves: DataFrame,
    cfg: WireConfig,
    dither: str = "keyed",
    rows: int | None = None,
    curve_keys: tuple[str, ...] = ("plane",),
) -> DataFrame:
    """The whole chain. The hits are shuffled once, on the frame.

    ``rows`` bounds the curve table if known.
    """
    triggers = trigger_times(blocks, cfg, dither)
    leads = leading_hits(
        mapped_hits(hits.wire_hits(blocks, cfg, dither), triggers, chmap, cfg), cfg
    )
    return with_positions(drift_events(leads, curves, cfg, rows, None, curve_keys), cfg)


def target_table(positions_: DataFrame, cfg: WireConfig) -> DataFrame:
    """Only the view means, the extrapolated points and the raw trigger time."""
    points = [f"{axis}_{t}" for t in cfg.targets for axis in ("x", "y")]
    return with_targets(positions_, cfg).select(*cfg.frame, *cfg.views, *points, "sra_tdc_raw")


def shift_check(wide: DataFrame, cfg: WireConfig) -> DataFrame:
    """Drift lengths of each pair with the shift folded into the second plane,
    in long form and split into equal and different wires."""
    rows = []
    for p in cfg.pairs:
        names = [f"{p.first}_id0", f"{p.first}_dl", f"{p.second}_id0", f"{p.second}_dl"]
        rows.append(
            F.struct(
                F.lit(f"{p.first}-{p.second}").alias("pair"),
                (F.col(names[0]) == F.col(names[2])).alias("same_wire"),
                F.col(names[1]).alias("dl1"),
                shifted_drift(*names, p.shift, cfg.cell).alias("dl2"),
            )
        )
    return wide.select(*cfg.frame, F.inline(F.array(*rows)))
