"""Strip detector: readout blocks -> events -> positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitframe.config import Bins, StripConfig
from hitframe.functions import (
    asymmetry,
    flip_even_channels,
    inside,
    keyed_uniform,
    linear,
    row_key,
    strip_inset,
    strip_position,
)
from hitframe.operators import curves as curve_ops
from hitframe.operators import edges as edge_ops
from hitframe.operators import frames, hits
from hitframe.operators.histograms import bin_of
from hitframe.operators.skew import bounded_broadcast, by_size
from hitframe.sources.stages import materialise

_SLOTS = {"timing": 1, "charge": 3, "id": 3}


def trigger_times(blocks: DataFrame, cfg: StripConfig, dither: str = "keyed") -> DataFrame:
    """Earliest anode hit of each frame, as a table."""
    anode = hits.anode_hits(blocks, cfg, dither)
    return hits.staged_time_zero(hits.earliest_time(anode, frame=cfg.frame))


def timed_edges(edges: DataFrame, triggers: DataFrame, cfg: StripConfig) -> DataFrame:
    """Edges of triggered frames inside the window, with the polarity set right."""
    timed = hits.subtract_time_zero(edges, triggers, cfg.frame).where(inside("timing", cfg.window))
    if cfg.flip_even_channels:
        timed = timed.withColumn("edge", flip_even_channels("edge", "ch"))
    return timed


def side_slots(
    timed: DataFrame,
    chmap: DataFrame,
    cfg: StripConfig,
    rows: int | None = None,
    calib: DataFrame | None = None,
) -> DataFrame:
    """Size and charge-ordered slots per frame and side.

    ``size`` counts all pairs; the slots come from the few pairs per channel that
    can be among the three widest. The edges are written down first, narrow: both
    parts read that table. Small frames are moved once and meet all that goes by
    channel, side or frame in their place. Of large ones both parts are shuffled by
    channel, where the limit of the second has a fresh exchange below it, so that a hot
    channel is cut to a few edges in every task before it moves.

    ``calib`` holds ``side, id, p1, p0``: charges are put through ``charge * p1 + p0``
    before they are ordered. A gain that is not negative keeps the order of the widths of
    a channel, so the widest pairs are the candidates as before; a negative one turns it
    round, and the narrowest are. Strips without constants are left out. Pairs that a
    negative gain makes equal only by rounding go by the narrower one.
    """
    if calib is not None:
        known = calib.select("side", "id", "p1", "p0").where("p1 IS NOT NULL AND p0 IS NOT NULL")
        chmap = chmap.join(known, ["side", "id"])
    timed = materialise(timed.select(*cfg.frame, "ch", "edge", "timing"), "timed-edges")
    chmap = bounded_broadcast(chmap, rows)
    few, many = by_size(timed, list(cfg.frame))
    slots = _side_slots(few, chmap, cfg, calib is not None)
    return slots if many is None else slots.unionByName(_side_slots(many, chmap, cfg, calib is not None))


def _side_slots(timed: DataFrame, chmap: DataFrame, cfg: StripConfig, gains: bool) -> DataFrame:
    channel, keys = [*cfg.frame, "ch"], [*cfg.frame, "side"]
    top = max(_SLOTS.values())
    sizes = (
        edge_ops.pair_summary(timed, channel)
        .join(chmap, "ch")
        .groupBy(*keys)
        .agg(F.sum("n_pairs").alias("size"))
    )
    if not gains:
        pairs = edge_ops.widest_pairs(timed, channel, top).join(chmap, "ch")
    else:
        signed = timed.join(chmap.select("ch", F.col("p1").alias("_gain")), "ch")
        pairs = edge_ops.widest_pairs(signed, channel, top, narrow=F.col("_gain") < 0).join(chmap, "ch")
        pairs = pairs.withColumn("charge", linear("charge", "p1", "p0"))
    return frames.hit_slots(pairs, keys, frames.by_charge("charge", "id", "timing"), _SLOTS, sizes)


def hit_lists(
    timed: DataFrame,
    chmap: DataFrame,
    cfg: StripConfig,
    rows: int | None = None,
    calib: DataFrame | None = None,
) -> DataFrame:
    """All hits per frame and side with their rank in charge order, in long form.

    A hit is a leading edge with the first trailing edge after it. Small frames are moved
    once, for the pairing and the ranks. ``calib`` holds
    ``side, id, p1, p0``: charges are then put through it before they are ordered, and
    hits of strips without constants are left out.
    """
    order = frames.by_charge("charge", "id", "timing")

    def lists(edges: DataFrame, whole: bool) -> DataFrame:
        pairs = edge_ops.nearest_pairs(edges, [*cfg.frame, "ch"], whole=whole)
        placed = hits.map_channels(pairs, chmap, ["ch"], rows)
        if calib is not None:
            placed = hits.linear_calibration(placed, calib, ["side", "id"], rows=rows).where("charge IS NOT NULL")
        return frames.ranked_hits(placed, [*cfg.frame, "side"], order, whole)

    timed = materialise(timed.select(*cfg.frame, "ch", "edge", "timing"), "timed-edges")
    few, many = by_size(timed, list(cfg.frame))
    ranked = lists(few, True)
    return ranked if many is None else ranked.unionByName(lists(many, False))


def pair_occupancy(
    timed: DataFrame,
    chmap: DataFrame,
    cfg: StripConfig,
    bins: Bins,
    cell: float | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Strip id against the charge of all pairs: ``side, id, bin, n``, cells with entries.

    Counted over time cells of width ``cell`` (by default one bin of charge), so a noisy
    channel costs no more than its window has cells; charges are exact for times on that
    grid.
    """
    cell = bins.width if cell is None else cell
    timed = materialise(timed.select(*cfg.frame, "ch", "edge", "timing"), "timed-edges")
    few, many = by_size(timed, list(cfg.frame))
    counts = edge_ops.width_counts(few, [*cfg.frame, "ch"], ["ch"], cell, whole=True)
    if many is not None:
        counts = counts.unionByName(edge_ops.width_counts(many, [*cfg.frame, "ch"], ["ch"], cell))
    placed = hits.map_channels(counts, chmap, ["ch"], rows).withColumn("bin", bin_of("width", bins))
    return placed.where("bin IS NOT NULL").groupBy("side", "id", "bin").agg(F.sum("n").alias("n"))


def side_by_side(slots: DataFrame, cfg: StripConfig) -> DataFrame:
    """One row per frame with ``_x`` and ``_y`` columns; a missing side is null."""
    slots = slots.withColumn("q0q1", asymmetry("charge0", "charge1"))
    values = [c for c in slots.columns if c not in (*cfg.frame, "side")]
    return frames.one_row_per_frame(
        slots, "side", cfg.sides, values, "{value}_{member}", cfg.frame
    )


def events(
    blocks: DataFrame,
    chmap: DataFrame,
    cfg: StripConfig,
    dither: str = "keyed",
    calib: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Strip events and the triggers they belong to."""
    triggers = trigger_times(blocks, cfg, dither)
    timed = timed_edges(hits.strip_edges(blocks, cfg, dither), triggers, cfg)
    return side_by_side(side_slots(timed, chmap, cfg, calib=calib), cfg), triggers


def adjacent_events(wide: DataFrame, cfg: StripConfig) -> DataFrame:
    """Events with two to six hits and neighbouring leading strips on each side."""
    return wide.where(
        frames.multiplicity_cut(cfg.max_size, cfg.sides) & frames.neighbour_cut(cfg.sides)
    )


def positions(
    wide: DataFrame,
    curves: DataFrame,
    cfg: StripConfig,
    rows: int | None = None,
    u: Column | None = None,
    curve_keys: tuple[str, ...] = ("side",),
) -> DataFrame:
    """Positions from the charge asymmetry, both sides in one lookup.

    One row per frame comes in, two leave the array and one goes out again; the
    placement by frame stays, so nothing is shuffled here.
    """
    sides = [
        F.struct(
            F.lit(s).alias("side"),
            F.col(f"id0_{s}").alias("id0"),
            F.col(f"id1_{s}").alias("id1"),
            asymmetry(f"charge0_{s}", f"charge1_{s}").alias("q0q1"),
        )
        for s in cfg.sides
    ]
    long = adjacent_events(wide, cfg).select(*cfg.frame, F.inline(F.array(*sides)))
    if u is None and not cfg.exact_fraction:
        u = keyed_uniform(row_key(*cfg.frame, "side"), 2)
    found = curve_ops.curve_lookup(
        long,
        curves.withColumnRenamed("plane", "side"),
        list(curve_keys),
        "q0q1",
        u,
        1.0,
        "_cdf",
        rows,
    )
    ins, pos = None, None
    for s in cfg.sides:
        half = cfg.half_strip[s]
        here = F.col("side") == s
        depth = strip_inset("id0", "id1", F.col("_cdf") * F.lit(abs(half)))
        place = strip_position("id0", "ins", cfg.centre_strip[s], half, cfg.mirror_fix)
        ins = F.when(here, depth) if ins is None else ins.when(here, depth)
        pos = F.when(here, place) if pos is None else pos.when(here, place)
    placed = found.withColumn("ins", ins).withColumn("pos", pos)
    return frames.one_row_per_frame(
        placed, "side", cfg.sides, ["pos", "ins"], "sr_{value}_{member}", cfg.frame
    )
