"""Fixed-bin histograms as DataFrames.

Counting combines before the shuffle, so a crowded bin costs no more than an empty
one. What comes out is bounded by bins times groups, whatever goes in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitframe.config import Bins


def bin_of(value: Column | str, bins: Bins) -> Column:
    """Bin number; null outside ``[lo, hi)``. Rounding never reaches bin ``n``."""
    value = F.col(value) if isinstance(value, str) else value
    inside = (value >= F.lit(float(bins.lo))) & (value < F.lit(float(bins.hi)))
    number = F.floor((value - F.lit(float(bins.lo))) / F.lit(bins.width))
    return F.when(inside, F.least(number, F.lit(bins.n - 1).cast("long")))


def bin_centre(number: Column | str, bins: Bins) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.lit(float(bins.lo)) + (number + F.lit(0.5)) * F.lit(bins.width)


def hist1d(
    df: DataFrame, value: Column | str, bins: Bins, groups: list[str] | None = None, dense: bool = True
) -> DataFrame:
    """Counts per bin: columns ``groups + [bin, n]``; ``dense`` adds empty bins."""
    groups = groups or []
    counts = (
        df.select(*groups, bin_of(value, bins).alias("bin"))
        .where(F.col("bin").isNotNull())
        .groupBy(*groups, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return fill_bins(counts, bins.n, groups) if dense else counts


def fill_bins(counts: DataFrame, n_bins: int, groups: list[str]) -> DataFrame:
    """Add the empty bins of each group. A group has at most ``n_bins`` rows here."""
    filled = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
    return (
        counts.groupBy(*groups)
        .agg(filled.alias("_filled"))
        .select(*groups, "_filled", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("_i"))
        .select(
            *groups,
            F.col("_i").cast("long").alias("bin"),
            F.coalesce(F.try_element_at("_filled", F.col("_i").cast("long")), F.lit(0)).alias("n"),
        )
    )


def hist2d(
    df: DataFrame,
    x: Column | str,
    x_bins: Bins,
    y: Column | str,
    y_bins: Bins,
    groups: list[str] | None = None,
) -> DataFrame:
    """Counts on a grid: ``groups + [bin_x, bin_y, n]``, cells with entries only."""
    groups = groups or []
    return (
        df.select(*groups, bin_of(x, x_bins).alias("bin_x"), bin_of(y, y_bins).alias("bin_y"))
        .where(F.col("bin_x").isNotNull() & F.col("bin_y").isNotNull())
        .groupBy(*groups, "bin_x", "bin_y")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def hist2d_arrays(
    df: DataFrame,
    x: str,
    x_bins: Bins,
    y: str,
    y_bins: Bins,
    groups: list[str] | None = None,
) -> DataFrame:
    """``hist2d`` over two parallel array columns, element by element."""
    groups = groups or []
    flat = df.select(*groups, F.inline(F.arrays_zip(F.col(x).alias("_x"), F.col(y).alias("_y"))))
    return hist2d(flat, "_x", x_bins, "_y", y_bins, groups)


def project_x(grid: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Sum the grid over y: ``groups + [bin, n]``."""
    return _project(grid, "bin_x", groups or [])


def project_y(
    grid: DataFrame, first: int, last: int, groups: list[str] | None = None
) -> DataFrame:
    """Sum the grid over the x bins ``first..last`` (both included)."""
    return _project(grid.where(F.col("bin_x").between(first, last)), "bin_y", groups or [])


def _project(grid: DataFrame, axis: str, groups: list[str]) -> DataFrame:
    return grid.groupBy(*groups, F.col(axis).alias("bin")).agg(F.sum("n").alias("n"))


def mode_bin(counts: DataFrame, groups: list[str], bin: str = "bin", n: str = "n") -> DataFrame:
    """Bin of largest count per group, the lowest one on a tie."""
    top = F.max(F.struct(F.col(n).alias("n"), (-F.col(bin)).alias("_neg")))
    return (
        counts.groupBy(*groups)
        .agg(top.alias("_top"))
        .select(*groups, (-F.col("_top._neg")).alias("mode_bin"), F.col("_top.n").alias("n"))
    )
