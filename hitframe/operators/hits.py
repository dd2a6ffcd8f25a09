"""From readout blocks to calibrated, mapped and cut hits (one row per hit)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitframe.config import (
    ANODE_MODULE,
    FRAME,
    STRIP_MODULE,
    TRIGGER_CHANNEL,
    WIRE_MODULE,
    Module,
    StripConfig,
    WireConfig,
)
from hitframe.functions import columns as C
from hitframe.sources.stages import materialise

from .skew import bounded_broadcast


def of_module(module: Module) -> Column:
    """Plain comparisons on top-level columns, so they reach the Parquet scan."""
    return (F.col("femType") == module.fem_type) & F.col("femId").isin(*module.fem_ids)


def explode_hits(blocks: DataFrame, *keep: str) -> DataFrame:
    """One row per hit. A block without hits gives no row."""
    return blocks.select(
        *[k for k in keep if k != "frame_id"],
        F.col("decoded.hbf.hbfNumber").alias("frame_id"),
        F.inline("decoded.data"),
    )


def wire_hits(
    blocks: DataFrame, cfg: WireConfig, dither: str = "keyed", seed: int = 0,
    module: Module = WIRE_MODULE,
) -> DataFrame:
    hits = explode_hits(blocks.where(of_module(module)), *cfg.frame, "femId")
    key = C.row_key(*cfg.frame, "femId", "ch", "time", "tot")
    return hits.select(
        *cfg.frame,
        "femId",
        "ch",
        C.ticks_to_ns("time", C.dither(dither, key, 0, seed), cfg.tick_ns).alias("tcal"),
        C.ticks_to_ns("tot", C.dither(dither, key, 1, seed), cfg.tick_ns).alias("charge"),
    )


def anode_hits(
    blocks: DataFrame, cfg: WireConfig | StripConfig, dither: str = "keyed", seed: int = 0,
    module: Module = ANODE_MODULE, channel: int = TRIGGER_CHANNEL,
) -> DataFrame:
    hits = explode_hits(blocks.where(of_module(module)), *cfg.frame).where(F.col("ch") == channel)
    key = C.row_key(*cfg.frame, "ch", "time", "tot")
    return hits.select(
        *cfg.frame,
        C.ticks_to_ns("time", C.dither(dither, key, 0, seed), cfg.tick_ns).alias("tcal"),
        F.col("time").alias("tdc_raw"),
    )


def strip_edges(
    blocks: DataFrame, cfg: StripConfig, dither: str = "keyed", seed: int = 0,
    module: Module = STRIP_MODULE,
) -> DataFrame:
    hits = explode_hits(blocks.where(of_module(module)), *cfg.frame)
    key = C.row_key(*cfg.frame, "ch", "time", "tot")
    return hits.select(
        *cfg.frame,
        "ch",
        F.col("tot").cast("int").alias("edge"),
        C.ticks_to_ns("time", C.dither(dither, key, 0, seed), cfg.tick_ns).alias("tcal"),
    )


def earliest_time(
    hits: DataFrame, time: str = "tcal", frame: tuple[str, ...] = FRAME
) -> DataFrame:
    """Time zero of each frame."""
    return hits.groupBy(*frame).agg(F.min(time).alias("t0"))


def earliest_row(
    hits: DataFrame, time: str, carry: list[str], frame: tuple[str, ...] = FRAME
) -> DataFrame:
    """The earliest hit of each frame with its companion columns.

    A minimum over (time, companions) instead of a ranked window: it combines
    before the shuffle and orders equal times.
    """
    first = F.min(F.struct(time, *carry)).alias("_first")
    return hits.groupBy(*frame).agg(first).select(*frame, "_first.*")


def staged_time_zero(t0: DataFrame) -> DataFrame:
    """Write the time zeros down: one narrow row per triggered frame, computed once
    for all the joins that need it."""
    return materialise(t0, "time-zero")


def subtract_time_zero(
    hits: DataFrame,
    t0: DataFrame,
    frame: tuple[str, ...] = FRAME,
    time: str = "tcal",
    zero: str = "t0",
) -> DataFrame:
    """Timing relative to the trigger; frames without one are dropped.

    Both sides grow with the data, so neither is broadcast by hint; Spark does it
    where the size of ``t0`` allows. ``t0`` has one row per frame, so a frame with
    very many hits is heavy on one side only and the adaptive skew split cuts that
    side. The split needs an exchange right below the join on both sides: hand in
    ``t0`` as a table (``staged_time_zero``), not as an open aggregation.
    """
    joined = hits.join(t0, list(frame))
    return joined.withColumn("timing", F.col(time) - F.col(zero)).drop(time, zero)


def wire_channel_map(chmap: DataFrame, cfg: WireConfig) -> DataFrame:
    """Plane name and wire number of each channel.

    Done on the map (one row per channel), so the hits only pay for one join.
    """
    n = cfg.wires_per_plane
    named = None
    for detector, planes in cfg.detectors.items():
        names = F.array(*[F.lit(f"{detector}_{p}") for p in planes])
        part = (
            chmap.where((F.col("detector") == detector) & F.col("id").between(0, n * len(planes) - 1))
            .select(
                "femId",
                "ch",
                "detector",
                F.element_at(names, (F.floor(F.col("id") / n) + 1).cast("int")).alias("plane"),
                (F.col("id") % n).cast("int").alias("id"),
            )
        )
        named = part if named is None else named.unionByName(part)
    return named


def map_channels(hits: DataFrame, chmap: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """Inner join: hits on unmapped channels are dropped, the key columns go."""
    return hits.join(bounded_broadcast(chmap, rows), keys).drop(*keys)


def linear_calibration(
    hits: DataFrame, calib: DataFrame, keys: list[str], value: str = "charge", rows: int | None = None
) -> DataFrame:
    """``value * p1 + p0`` per channel; null for a channel without constants."""
    joined = hits.join(bounded_broadcast(calib, rows), keys, "left")
    return joined.withColumn(value, C.linear(value, "p1", "p0")).drop("p1", "p0")


def wire_cut(cfg: WireConfig) -> Column:
    """Charge and timing box of the detector a hit belongs to."""
    cut = F.lit(False)
    for detector, box in cfg.cuts.items():
        cut = cut | ((F.col("detector") == detector) & C.in_box("charge", "timing", box))
    return cut
