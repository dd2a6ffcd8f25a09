"""Calibration jobs: all planes, sides, runs and pulser settings in one job each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitframe.config import (
    ASYMMETRY_BINS,
    CDF_TOLERANCE,
    DRIFT_BINS,
    DRIFT_BOX,
    DRIFT_CHARGE_BINS,
    PULSER_CHARGE_BINS,
    PULSER_ID_BINS,
    Bins,
    Box,
    StripConfig,
    WireConfig,
)
from hitframe.functions import in_box
from hitframe.operators import curves, frames, histograms

from .strip import adjacent_events


def drift_curves(
    leads: DataFrame,
    cfg: WireConfig,
    groups: list[str],
    box: Box = DRIFT_BOX,
    time_bins: Bins = DRIFT_BINS,
    charge_bins: Bins = DRIFT_CHARGE_BINS,
) -> DataFrame:
    """Drift curves from leading hits, away from the edge wires."""
    counts = drift_counts(leads, cfg, groups, box, time_bins, charge_bins)
    return curves_of_counts(counts, time_bins, groups)


def drift_counts(
    leads: DataFrame,
    cfg: WireConfig,
    groups: list[str],
    box: Box = DRIFT_BOX,
    time_bins: Bins = DRIFT_BINS,
    charge_bins: Bins = DRIFT_CHARGE_BINS,
) -> DataFrame:
    """Entries per timing bin, ``groups + [bin, n]``: what a drift curve is made of.

    The grid of timing and charge is projected on timing, so hits outside either
    range do not count.
    """
    kept = leads.where(
        frames.edge_wire_veto(cfg.wires_per_plane - 1) & in_box("charge0", "timing0", box)
    )
    grid = histograms.hist2d(kept, "timing0", time_bins, "charge0", charge_bins, groups)
    return histograms.project_x(grid, groups)


def curves_of_counts(counts: DataFrame, bins: Bins, groups: list[str]) -> DataFrame:
    """Curves from entries per bin. Counts of several runs, or of parts of one, add up,
    so a curve over all of them does not read the hits again."""
    merged = counts.groupBy(*groups, "bin").agg(F.sum("n").cast("long").alias("n"))
    return curves.cdf_curve(histograms.fill_bins(merged, bins.n, groups), bins, groups, CDF_TOLERANCE)


def asymmetry_curves(
    wide: DataFrame, cfg: StripConfig, groups: list[str], bins: Bins = ASYMMETRY_BINS
) -> DataFrame:
    """Asymmetry curves per side (column ``plane``) from strip events."""
    return curves_of_counts(asymmetry_counts(wide, cfg, groups, bins), bins, [*groups, "plane"])


def asymmetry_counts(
    wide: DataFrame, cfg: StripConfig, groups: list[str], bins: Bins = ASYMMETRY_BINS
) -> DataFrame:
    """Entries per asymmetry bin and side, ``groups + [plane, bin, n]``."""
    rows = [
        F.struct(F.lit(s).alias("plane"), F.col(f"q0q1_{s}").alias("q0q1")) for s in cfg.sides
    ]
    long = adjacent_events(wide, cfg).select(*groups, F.inline(F.array(*rows)))
    return histograms.hist1d(long, "q0q1", bins, [*groups, "plane"], dense=False)


def pulser_modes(
    hits: DataFrame,
    groups: list[str],
    n_ids: int = 32,
    id_bins: Bins = PULSER_ID_BINS,
    charge_bins: Bins = PULSER_CHARGE_BINS,
) -> DataFrame:
    """Most frequent charge bin per strip id and pulser setting.

    Ids without any entry get bin 0, the first of equally empty bins.
    """
    grid = histograms.hist2d(hits, "id", id_bins, "charge", charge_bins, groups)
    found = histograms.mode_bin(
        grid.where(F.col("bin_x") < n_ids), [*groups, "bin_x"], "bin_y"
    ).select(*groups, F.col("bin_x").alias("bin"), F.col("mode_bin").alias("n"))
    return histograms.fill_bins(found, n_ids, groups).select(
        *groups, F.col("bin").cast("int").alias("id"), F.col("n").cast("int").alias("mode_bin")
    )


def occupancy(hits: DataFrame, groups: list[str], id_bins: Bins, charge_bins: Bins) -> DataFrame:
    """Channel occupancy: id against charge, before time zero and cuts."""
    return histograms.hist2d(hits, "id", id_bins, "charge", charge_bins, groups)
