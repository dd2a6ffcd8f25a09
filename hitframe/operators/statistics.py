"""Order statistics and peak fits per group, without gathering a group anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitframe.config import Bins
from hitframe.sources.stages import materialise

from .skew import bounded_broadcast

# ranges that each round cuts an interval into
CUTS = 1024
# an interval with no more values than this is sorted
FEW = 4096


def _same(keys: list[str], left: str, right: str) -> Column:
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return match


def _in_range(values: DataFrame, ranges: DataFrame, groups: list[str]) -> DataFrame:
    """Values with the interval of their group that they lie in."""
    v, r = values.alias("v"), bounded_broadcast(ranges).alias("r")
    inside = (F.col("v._v") >= F.col("r._lo")) & (F.col("v._v") <= F.col("r._hi"))
    return v.join(r, _same(groups, "v", "r") & inside).select("r.*", "v._v")


def exact_quantiles(
    df: DataFrame, value: str, groups: list[str], fractions: tuple[float, ...] = (0.5,)
) -> DataFrame:
    """``groups + [q0, q1, ...]``: exact quantiles, linear between neighbouring values.

    Selection by counting: the interval that holds a wanted rank is cut into ``CUTS``
    ranges, their counts say which of them holds it, and its smallest and largest value
    are the next interval. Each round is one grouped count over the values that are still
    in an interval; an interval whose values are all equal is an answer, one with at most
    ``FEW`` values is sorted. So no group is ever sorted or held as a whole, and a group
    that holds most of the rows costs no more than another.

    Nulls and NaN do not count; a group without other values has no row. Infinite values
    are an error, as intervals around them cannot be cut.
    """
    v = F.col(value).cast("double")
    infinite = F.abs(v) == F.lit(float("inf"))
    checked = F.when(infinite, F.raise_error(F.lit("infinite value"))).otherwise(v)
    values = df.select(*groups, checked.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    values = materialise(values, "values")
    whole = values.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    whole = materialise(whole.where("_n > 0"), "value-ranges")
    at = [F.lit(float(f)) * (F.col("_n") - 1) for f in fractions]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in at])))
    # a wanted rank, the interval that holds it, the values in it and those below it
    state = whole.select(
        *groups, F.explode(ranks).alias("_rank"), "_lo", "_hi", F.col("_n").alias("_in"), F.lit(0).cast("long").alias("_below")
    )
    open_ = (F.col("_lo") < F.col("_hi")) & (F.col("_in") > FEW)
    done = state.where(~open_)
    state = state.where(open_)
    while not state.isEmpty():
        ranges = state.select(*groups, "_lo", "_hi", "_below").distinct()
        place = F.floor((F.col("_v") - F.col("_lo")) * (F.lit(float(CUTS)) / (F.col("_hi") - F.col("_lo"))))
        cells = (
            _in_range(values, ranges, groups)
            .groupBy(*groups, "_lo", "_hi", "_below", F.least(place, F.lit(CUTS - 1).cast("long")).alias("_cell"))
            .agg(F.count(F.lit(1)).alias("_in"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
        )
        before = Window.partitionBy(*groups, "_lo", "_hi").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("_start", F.col("_below") + F.coalesce(F.sum("_in").over(before), F.lit(0)))
        s, c = state.select(*groups, "_rank", "_lo", "_hi").alias("s"), cells.alias("c")
        holds = (F.col("s._rank") >= F.col("c._start")) & (F.col("s._rank") < F.col("c._start") + F.col("c._in"))
        same = _same([*groups, "_lo", "_hi"], "s", "c")
        found = s.join(c, same & holds).select(
            *[F.col(f"s.{g}") for g in groups],
            "s._rank",
            F.col("c._from").alias("_lo"),
            F.col("c._to").alias("_hi"),
            "c._in",
            F.col("c._start").alias("_below"),
        )
        found = materialise(found, "quantile-ranges")
        done = done.unionByName(found.where(~open_))
        state = found.where(open_)
    done = materialise(done, "quantile-ends")
    few = done.where("_lo < _hi")
    lists = (
        _in_range(values, few.select(*groups, "_lo", "_hi").distinct(), groups)
        .groupBy(*groups, "_lo", "_hi")
        .agg(F.sort_array(F.collect_list("_v")).alias("_sorted"))
    )
    f, ls = few.alias("f"), lists.alias("l")
    sorted_ = f.join(ls, _same([*groups, "_lo", "_hi"], "f", "l")).select(
        *[F.col(f"f.{g}") for g in groups],
        "f._rank",
        F.get("l._sorted", (F.col("f._rank") - F.col("f._below")).cast("int")).alias("_x"),
    )
    known = done.where("_lo = _hi").select(*groups, "_rank", F.col("_lo").alias("_x")).unionByName(sorted_)
    w, k = whole.alias("w"), known.alias("k")
    cells = []
    for i, p in enumerate(at):
        low = F.max(F.when(F.col("_rank") == F.floor(p), F.col("_x")))
        high = F.max(F.when(F.col("_rank") == F.ceil(p), F.col("_x")))
        part = F.max(p - F.floor(p))
        cells.append((low + (high - low) * part).alias(f"q{i}"))
    both = w.join(k, _same(groups, "w", "k")).select("w.*", "k._rank", "k._x")
    # without groups an empty table would give a row of nulls
    return both.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), *cells).where("_n > 0").drop("_n")


def peak_fit(
    counts: DataFrame, bins: Bins, groups: list[str], rounds: int = 5, floor: float = 0.1
) -> DataFrame:
    """``groups + [n, height, centre, width]``: a Gaussian fitted to each histogram.

    The logarithm of a Gaussian is a parabola, so the fit is linear: least squares of the
    log counts, weighted by the counts at first and then by the fitted curve, ``rounds``
    times in all. The sums of the normal equations are taken over the bins of a group in
    one window partitioning; nothing leaves Spark and a group has at most ``bins.n`` rows.
    Bins below ``floor`` times the highest one do not count. A histogram with fewer than
    three such bins, or without a maximum, has null results; ``n`` counts the entries used.
    """
    whole = Window.partitionBy(*groups)
    n = F.col("n").cast("double")
    # places from -1/2 to 1/2 keep the sums of powers apart from each other's rounding
    u = (F.col("bin") + F.lit(0.5)) / F.lit(float(bins.n)) - F.lit(0.5)
    rows = (
        counts.withColumn("_top", F.max(n).over(whole))
        .where((n > 0) & (n >= F.lit(float(floor)) * F.col("_top")))
        .select(*groups, n.alias("_n"), u.alias("_u"), F.log(n).alias("_y"), n.alias("_w"))
    )
    for _ in range(rounds):
        sums = {f"_s{i}": F.sum(F.col("_w") * F.pow("_u", F.lit(float(i)))).over(whole) for i in range(5)}
        sums |= {f"_t{i}": F.sum(F.col("_w") * F.pow("_u", F.lit(float(i))) * F.col("_y")).over(whole) for i in range(3)}
        solved = rows.withColumns(sums).withColumns(
            {name: value for name, value in zip(("_a", "_b", "_c"), _parabola())}
        )
        fitted = F.exp(F.col("_a") + (F.col("_b") + F.col("_c") * F.col("_u")) * F.col("_u"))
        rows = solved.withColumn("_w", F.when(F.col("_c") < 0, fitted).otherwise(F.col("_n"))).drop(*sums)
    first = lambda c: F.max(c).alias(c)  # noqa: E731  constant within a group
    ends = rows.groupBy(*groups).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_bins"), *map(first, ("_a", "_b", "_c")))
    a, b, c = (F.col(x) for x in ("_a", "_b", "_c"))
    is_peak = (c < 0) & (F.col("_bins") >= 3)
    span = F.lit(float(bins.hi) - float(bins.lo))
    return ends.select(
        *groups,
        F.col("_n").cast("long").alias("n"),
        F.when(is_peak, F.exp(a - b * b / (4 * c))).alias("height"),
        F.when(is_peak, F.lit(float(bins.lo)) + (-b / (2 * c) + F.lit(0.5)) * span).alias("centre"),
        F.when(is_peak, F.sqrt(F.lit(-0.5) / c) * span).alias("width"),
    )


def _parabola() -> tuple[Column, Column, Column]:
    """Solution of the normal equations, by determinants; null where they have none."""
    s = [F.col(f"_s{i}") for i in range(5)]
    t = [F.col(f"_t{i}") for i in range(3)]

    def det(x, y, z):
        return (
            x[0] * (y[1] * z[2] - y[2] * z[1])
            - x[1] * (y[0] * z[2] - y[2] * z[0])
            + x[2] * (y[0] * z[1] - y[1] * z[0])
        )

    rows = [s[0:3], s[1:4], s[2:5]]
    base = det(*rows)
    out = []
    for i in range(3):
        put = [[t[r] if c == i else rows[r][c] for c in range(3)] for r in range(3)]
        out.append(F.try_divide(det(*put), base))
    return tuple(out)
