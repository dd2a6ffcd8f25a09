"""Efficiencies, residuals and resolutions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitframe.config import FRAME, RESOLUTION_LIMIT, Bins
from hitframe.functions import mean_of
from hitframe.sources.stages import materialise

from .frames import cluster_cut
from .histograms import hist1d
from .statistics import exact_quantiles, peak_fit


def efficiency(
    events: DataFrame, triggers: DataFrame, groups: tuple[str, ...] = ()
) -> DataFrame:
    """Frames with a three-strip cluster per triggered frame, in percent.

    One row per group that has triggers (per run, say), or one in all; null without
    triggers. Both sides are reduced to a row per group before they meet.
    """
    n_triggers = F.count(F.lit(1)).alias("n_triggers")
    n_clusters = F.count_if(cluster_cut())
    if groups:
        clusters = events.groupBy(*groups).agg(n_clusters.alias("n_clusters"))
        both = triggers.groupBy(*groups).agg(n_triggers).join(clusters, list(groups), "left")
        both = both.withColumn("n_clusters", F.coalesce("n_clusters", F.lit(0)))
    else:
        clusters = events.select(n_clusters).scalar()
        both = triggers.agg(n_triggers).withColumn("n_clusters", clusters)
    percent = F.try_divide(F.col("n_clusters") * F.lit(100.0), F.col("n_triggers"))
    return both.select(*groups, "n_triggers", "n_clusters", percent.alias("efficiency"))


def slot_efficiency(
    events: DataFrame, sides: tuple[str, ...] = ("x", "y"), groups: tuple[str, ...] = ()
) -> DataFrame:
    """Share of frames with a third strip among those with a first, per group and side."""
    counts = events.groupBy(*groups).agg(
        *[F.count_if(F.col(f"charge{i}_{s}") > 0).alias(f"_{i}_{s}") for s in sides for i in (0, 2)]
    )
    rows = [
        F.struct(F.lit(s).alias("side"), F.col(f"_0_{s}").alias("n0"), F.col(f"_2_{s}").alias("n2"))
        for s in sides
    ]
    return counts.select(*groups, F.inline(F.array(*rows))).withColumn(
        "efficiency", F.try_divide(F.col("n2").cast("double"), F.col("n0"))
    )


def residual_columns(
    df: DataFrame, pairs: tuple[tuple[str, str], ...], suffix: str = "_posi",
    frame: tuple[str, ...] = FRAME,
) -> DataFrame:
    """Differences between planes in long form: ``pair, diff`` per frame and pair."""
    rows = [
        F.struct(
            F.lit(f"{a}-{b}").alias("pair"),
            (F.col(a + suffix) - F.col(b + suffix)).alias("diff"),
        )
        for a, b in pairs
    ]
    return df.select(*frame, F.inline(F.array(*rows)))


def resolution(
    df: DataFrame,
    views: dict[str, tuple[str, ...]],
    limit: float = RESOLUTION_LIMIT,
    groups: tuple[str, ...] = (),
) -> DataFrame:
    """Position resolution per group and view (um) from the spread around the plane mean.

    The spread sums the accepted residuals but divides by all rows; the variant
    over accepted rows is returned next to it.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_all")]
    for view, planes in views.items():
        mean = mean_of([f"{p}_posi" for p in planes])
        for p in planes:
            diff = F.col(f"{p}_posi") - mean
            kept = F.abs(diff) < limit
            aggs.append(F.sum(F.when(kept, diff * diff)).alias(f"{view}|{p}|ss"))
            aggs.append(F.count_if(kept).alias(f"{view}|{p}|n"))
    total = df.groupBy(*groups).agg(*aggs)

    def spread(view: str, planes: tuple[str, ...], over: str | None) -> Column:
        terms = []
        for p in planes:
            n = F.col("n_all") if over is None else F.col(f"`{view}|{p}|{over}`")
            terms.append(F.try_divide(F.col(f"`{view}|{p}|ss`"), n))
        k = float(len(planes))
        return F.sqrt(mean_of(terms) * F.lit(k - 1.0)) / F.lit(k) * F.lit(1000.0)

    rows = [
        F.struct(
            F.lit(view).alias("view"),
            F.col("n_all"),
            spread(view, planes, None).alias("resolution_um"),
            spread(view, planes, "n").alias("resolution_accepted_um"),
        )
        for view, planes in views.items()
    ]
    return total.select(*groups, F.inline(F.array(*rows)))


def residual_summary(
    df: DataFrame, value: str, groups: list[str], bounds: tuple[float, float]
) -> DataFrame:
    """Mean, spread and exact quartiles of a residual distribution inside ``bounds``.

    ``quartile_width`` is the half width between the outer quartiles, which tails do not
    widen. The residuals are written down, since the quartiles read them several times.
    """
    v = F.col(value)
    inside = materialise(df.where((v >= bounds[0]) & (v < bounds[1])).select(*groups, value), "residuals")
    moments = inside.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.avg(v).alias("centre"), F.stddev_samp(v).alias("width")
    )
    q = exact_quantiles(inside, value, groups, (0.25, 0.5, 0.75)).alias("q")
    match = F.lit(True)
    for g in groups:
        match = match & F.col(f"m.{g}").eqNullSafe(F.col(f"q.{g}"))
    return moments.alias("m").join(q, match).select(
        "m.*", F.col("q1").alias("median"), ((F.col("q2") - F.col("q0")) / 2).alias("quartile_width")
    )


def residual_peaks(
    df: DataFrame, value: str, groups: list[str], bins: Bins, rounds: int = 5
) -> DataFrame:
    """Centre and width of the Gaussian core of each residual distribution."""
    return peak_fit(hist1d(df, value, bins, groups, dense=False), bins, groups, rounds)
