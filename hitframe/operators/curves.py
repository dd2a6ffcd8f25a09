"""Calibration curves: building them from histograms and looking values up."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitframe.config import CDF_TOLERANCE, Bins

from hitframe.sources.stages import materialise

from .histograms import bin_centre

# Points of all curves together that are sent to every executor: 16 bytes each.
MAX_CURVE_POINTS = 4_000_000
# a curve has fewer than 2 to this power points
MAX_POINT_BITS = 20


def cdf_curve(
    counts: DataFrame,
    bins: Bins,
    groups: list[str],
    tolerance: float = CDF_TOLERANCE,
    x: str = "centre",
) -> DataFrame:
    """Trimmed cumulative distribution per group: ``groups + [bin, x, tx]``.

    ``counts`` is a dense histogram, so no window sees more than ``bins.n`` rows.
    The curve runs from the first bin with ``tx >= tolerance`` to the first one
    with ``tx >= 1 - tolerance``. ``x`` is the bin centre, or with ``upper_edge``
    the end of the bin that ``tx`` covers. A group without entries has no curve.
    """
    whole = Window.partitionBy(*groups)
    running = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bin_, tx = F.col("bin"), F.col("tx")
    tolerance_ = F.lit(tolerance)
    place = (
        bin_centre("bin", bins)
        if x == "centre"
        else F.lit(float(bins.lo)) + (bin_ + 1) * F.lit(bins.width)
    )
    return (
        counts.withColumn("_total", F.sum("n").over(whole))
        .where(F.col("_total") > 0)
        .withColumn("tx", F.sum("n").over(running) / F.col("_total"))
        .withColumn("_first", F.min(F.when(tx >= tolerance_, bin_)).over(whole))
        .withColumn("_last", F.min(F.when(tx >= 1 - tolerance_, bin_)).over(whole))
        .where(bin_.between(F.col("_first"), F.col("_last")))
        .select(*groups, "bin", place.alias("x"), "tx")
    )


def curve_intervals(curves: DataFrame, keys: list[str]) -> DataFrame:
    """Neighbouring curve points as ``keys + [lo, hi, tx_lo, tx_hi]``.

    The window runs per curve, each of a few hundred points.
    """
    along = Window.partitionBy(*keys).orderBy("x")
    return curves.select(
        *keys,
        F.lag("x").over(along).alias("lo"),
        F.col("x").alias("hi"),
        F.lag("tx").over(along).alias("tx_lo"),
        F.col("tx").alias("tx_hi"),
    ).where(F.col("lo").isNotNull())


def curve_table(curves: DataFrame, keys: list[str]) -> DataFrame:
    """One row per curve: ``keys + [xs, txs, steps, even]``, the points in order of x.

    ``steps`` is the number of points per unit of x, which makes the place of a value in
    an evenly spaced curve a multiplication; ``even`` says that this is at most one off
    for every value. A curve has as many points as its histogram has bins, a few hundred,
    so the arrays are small.
    """
    points = F.sort_array(F.collect_list(F.struct("x", "tx")))
    rows = curves.where("x IS NOT NULL").groupBy(*keys).agg(points.alias("_p"))
    first, last = F.col("_p")[0]["x"], F.element_at("_p", -1)["x"]
    table = rows.select(
        *keys,
        F.col("_p.x").alias("xs"),
        F.col("_p.tx").alias("txs"),
        F.try_divide(F.size("_p") - 1, last - first).alias("steps"),
    )
    # the guess grows with the value, so it is enough to look at the points
    off = F.filter("xs", lambda x, i: ~_guess(x).between(i - 1, i))
    return table.withColumn("even", F.coalesce(F.size(off) == 0, F.lit(False)))


def _guess(value: Column) -> Column:
    return F.floor((value - F.get("xs", F.lit(0))) * F.col("steps")).cast("int")


def _place(value: Column, even: bool) -> Column:
    """Number of the last point at or before ``value``, which lies within the curve.

    The evenly spaced guess and its neighbours are tried; where not all curves are even,
    what they do not meet is searched by halves.
    """
    guess = F.col("_guess")
    here = lambda i: (F.get("xs", i) <= value) & (value < F.get("xs", i + 1))
    tried = F.when(here(guess), guess).when(here(guess - 1), guess - 1).when(here(guess + 1), guess + 1)
    if even:
        return tried
    halves = F.array(*[F.lit(1 << b) for b in reversed(range(MAX_POINT_BITS))])
    searched = F.aggregate(
        halves,
        F.lit(0),
        lambda at, step: F.when(F.get("xs", at + step) <= value, at + step).otherwise(at),
    )
    return tried.otherwise(searched)


def interval_lookup(
    df: DataFrame, curves: DataFrame, keys: list[str], value: str, points: int | None = None, even: bool = False
) -> DataFrame:
    """Add ``lo, hi, tx_lo, tx_hi``: the curve points around ``value``; null outside.

    A left join on ``keys`` with one row per curve, then the place in its arrays:
    ``lo <= value < hi``, whatever the spacing, and no row is listed more than once. The
    curves are written down, one row each, and tell whether all are evenly spaced: then
    the place stays in generated code, else it ends in a search. ``points`` bounds the
    points of all curves if known, else they are counted; with ``even`` as well, which holds
    for curves straight from ``cdf_curve``, nothing is written first. Beyond ``MAX_CURVE_POINTS`` the
    same join shuffles; each curve is one row, so only the rows that look up are heavy
    and the skew split can cut them.
    """
    # The keys get names of their own: the curves often come from the very rows
    # they are looked up for, and equal names would then mean equal columns.
    table = curve_table(curves, keys).withColumnsRenamed({k: f"_of_{k}" for k in keys})
    if points is None or not even:
        table = materialise(table, "curve-table")
        found = table.agg(F.sum(F.size("xs")).alias("n"), F.min("even").alias("even")).first()
        points = (found["n"] or 0) if points is None else points
        even = found["even"] is not False
    table = table.drop("even")
    right = F.broadcast(table) if points <= MAX_CURVE_POINTS else table
    match = reduce(and_, [F.col(key) == F.col(f"_of_{key}") for key in keys])
    v = F.col(value)
    first, last = F.get("xs", F.lit(0)), F.element_at("xs", -1)
    inside = (v >= first) & (v < last)
    joined = df.join(right, match, "left").withColumn("_guess", F.when(inside, _guess(v)))
    placed = joined.withColumn("_at", F.when(inside, _place(v, even)))
    cells = {
        "lo": F.get("xs", F.col("_at")),
        "hi": F.get("xs", F.col("_at") + 1),
        "tx_lo": F.get("txs", F.col("_at")),
        "tx_hi": F.get("txs", F.col("_at") + 1),
    }
    helpers = ["xs", "txs", "steps", "_guess", "_at", *[f"_of_{k}" for k in keys]]
    return placed.withColumns(cells).drop(*helpers)


def interpolate(u: Column, scale: float) -> Column:
    """Value at the fraction ``u`` of the interval found, times ``scale``."""
    return (F.col("tx_lo") + (F.col("tx_hi") - F.col("tx_lo")) * u) * F.lit(float(scale))


def exact_fraction(value: str) -> Column:
    """How far ``value`` lies along the interval found."""
    return (F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo"))


def curve_lookup(
    df: DataFrame,
    curves: DataFrame,
    keys: list[str],
    value: str,
    u: Column | None,
    scale: float,
    out: str,
    points: int | None = None,
    even: bool = False,
) -> DataFrame:
    """Add ``out``: the curve of each row's ``keys`` at ``value``, null outside it.

    ``u`` is the fraction of the interval to take; None takes the exact one.
    """
    found = interval_lookup(df, curves, keys, value, points, even)
    u = exact_fraction(value) if u is None else u
    return found.withColumn(out, interpolate(u, scale)).drop("lo", "hi", "tx_lo", "tx_hi")


def curves_in_force(runs: DataFrame, curves: DataFrame, planes: list[str], order: str = "run_no") -> DataFrame:
    """Which calibration serves which run: ``planes + [order, curve_no, curve_version]``.

    An as-of join. ``runs`` names the runs and planes that ask (repeats count once),
    ``curves`` has a row ``planes + [order, version]`` per calibration taken. A run uses,
    plane by plane, the latest calibration taken at it or before it, of several at one
    place the one of highest version; both are null before the first. Rows are runs, not
    hits: the hits join this table by their run.
    """
    taken = curves.groupBy(*planes, order).agg(F.max("version").alias("_version"))
    wanted = runs.select(*planes, order).distinct()
    both = wanted.withColumn("_asked", F.lit(True)).unionByName(
        taken.withColumn("_asked", F.lit(False)), allowMissingColumns=True
    )
    # at one place the calibration comes before the run that asks
    past = Window.partitionBy(*planes).orderBy(order, "_asked")
    given = F.when(~F.col("_asked"), F.struct(F.col(order).alias("at"), "_version"))
    served = both.withColumn("_last", F.last(given, ignorenulls=True).over(past)).where("_asked")
    return served.select(
        order, *planes, F.col("_last.at").alias("curve_no"), F.col("_last._version").alias("curve_version")
    )
