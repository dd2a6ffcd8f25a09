"""Leading/trailing edges of a channel.

Every leading edge of a channel pairs with every trailing edge of it in the same
frame, so m leading and n trailing edges stand for m*n hits. What later stages
need from them - the number of hits and the widest few - follows from m, n and the
outermost edges, so the product itself is not formed on the way to positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitframe.config import LEADING, TRAILING

from hitframe.sources.stages import materialise

from .frames import placed_in_ranges, top_hits
from .skew import all_known, by_size


def pair_summary(edges: DataFrame, keys: list[str], time: str = "timing") -> DataFrame:
    """Number and width range of all pairs per channel, from one grouped pass."""
    lead, trail = F.col("edge") == LEADING, F.col("edge") == TRAILING
    t = F.col(time)
    m, n = F.count_if(lead), F.count_if(trail)
    # the product of two row counts can pass the range of a long
    pairs = m.cast("decimal(19,0)") * n.cast("decimal(18,0)")
    # the same rows as in the other functions, so that both can read one shuffle
    both = edges.where(F.col("edge").isin(LEADING, TRAILING))
    return (
        both.groupBy(*keys)
        .agg(
            pairs.cast("decimal(38,0)").alias("n_pairs"),
            (F.min(F.when(trail, t)) - F.max(F.when(lead, t))).alias("width_min"),
            (F.max(F.when(trail, t)) - F.min(F.when(lead, t))).alias("width_max"),
            (m * F.sum(F.when(trail, t)) - n * F.sum(F.when(lead, t))).alias("width_sum"),
        )
        .where(F.col("n_pairs") > 0)
    )


def widest_pairs(
    edges: DataFrame, keys: list[str], k: int, time: str = "timing", narrow: Column | None = None
) -> DataFrame:
    """Pairs among which the ``k`` widest of each channel are, at most O(k log k).

    Counted from the earliest leading and the latest trailing edge, the pair (i, j)
    has i*j - 1 pairs at least as wide, so only i*j <= k can matter. Pairs of equal
    width come in order of their leading time; two that agree in both are the same.

    Where ``narrow`` holds, a condition on the channel, the narrowest ones are wanted:
    there the same count starts from the latest leading and the earliest trailing edge.
    """
    t = F.col(time)
    outward = F.when(F.col("edge") == LEADING, t).otherwise(-t)
    if narrow is not None:
        outward = F.when(narrow, -outward).otherwise(outward)
    outermost = [outward.asc()]
    both = edges.where(F.col("edge").isin(LEADING, TRAILING))
    top = top_hits(both, [*keys, "edge"], outermost, k)
    cell = {
        (edge, i): F.max(F.when((F.col("edge") == edge) & (F.col("rank") == i), t))
        for edge in (LEADING, TRAILING)
        for i in range(1, k + 1)
    }
    wide = top.groupBy(*keys).agg(*[c.alias(f"_{e}_{i}") for (e, i), c in cell.items()])
    pairs = [
        F.struct(F.col(f"_{LEADING}_{i}").alias("timing"), F.col(f"_{TRAILING}_{j}").alias("timing_trail"))
        for i in range(1, k + 1)
        for j in range(1, k // i + 1)
    ]
    return (
        wide.select(*keys, F.inline(F.array(*pairs)))
        .where(F.col("timing").isNotNull() & F.col("timing_trail").isNotNull())
        .withColumn("charge", F.col("timing_trail") - F.col("timing"))
    )


def nearest_pairs(edges: DataFrame, keys: list[str], time: str = "timing", whole: bool = False) -> DataFrame:
    """Each leading edge with the first trailing edge after it in its channel.

    At most one hit per leading edge, so the lists grow with the edges and not with
    their product. A leading edge without a later trailing one gives no hit. Small
    channels are paired as they are; ``whole`` says that all are small and placed already
    (``skew.by_size``), so that nothing moves. Edges without a key give no hit.
    """
    both = edges.where(F.col("edge").isin(LEADING, TRAILING) & all_known(keys)).select(*keys, "edge", time)
    many = None
    if not whole:
        both, many = by_size(materialise(both, "edges"), keys)
    onward = Window.partitionBy(*keys).orderBy(*_onward(time))
    near = both.withColumn(
        "timing_trail", _trailing(time).over(onward.rowsBetween(Window.unboundedPreceding, -1))
    ).where(F.col("edge") == LEADING)
    if many is not None:
        near = near.unionByName(_near_in_ranges(many, keys, time))
    return near.where(F.col("timing_trail").isNotNull()).select(
        *keys, F.col(time).alias("timing"), "timing_trail", (F.col("timing_trail") - F.col(time)).alias("charge")
    )


def _trailing(time: str) -> Column:
    return F.min(F.when(F.col("edge") == TRAILING, F.col(time)))


def _onward(time: str) -> list[Column]:
    """From late to early; at equal times the trailing edge is not after the leading one."""
    return [F.col(time).desc(), F.col("edge").asc()]


def _near_in_ranges(edges: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Leading edges with their ``timing_trail``, for channels of any size.

    The edges are cut into ranges of (keys, time): the partner is looked for in the own
    range, else it is the earliest trailing edge of the later ranges, so a channel of
    any share is spread over many tasks.
    """
    # at equal times the trailing edge comes first, so it is not after the leading one
    placed = placed_in_ranges(edges, keys, [F.col(time).asc(), F.col("edge").desc()])
    pieces = [*keys, "_range"]
    onward = Window.partitionBy(*pieces).orderBy(*_onward(time))
    later = Window.partitionBy(*keys).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = (
        placed.groupBy(*pieces).agg(_trailing(time).alias("_first")).withColumn("_beyond", F.min("_first").over(later))
    ).drop("_first")
    near = placed.withColumn(
        "_own", _trailing(time).over(onward.rowsBetween(Window.unboundedPreceding, -1))
    ).where(F.col("edge") == LEADING)
    return (
        near.join(beyond, pieces)
        .withColumn("timing_trail", F.coalesce("_own", "_beyond"))
        .select(*keys, "edge", time, "timing_trail")
    )


def pair_edges(edges: DataFrame, keys: list[str], time: str = "timing") -> DataFrame:
    """All hits of the channels, for lists and occupancies of every hit.

    The output is the product per channel and frame by definition. It is an equi-join
    on (frame, channel), which the adaptive skew split cuts on both sides.
    """
    lead = edges.where(F.col("edge") == LEADING).select(*keys, F.col(time).alias("timing"))
    trail = edges.where(F.col("edge") == TRAILING).select(*keys, F.col(time).alias("timing_trail"))
    return lead.join(trail, keys).withColumn("charge", F.col("timing_trail") - F.col("timing"))


def width_counts(
    edges: DataFrame, keys: list[str], groups: list[str], cell: float, time: str = "timing", whole: bool = False
) -> DataFrame:
    """Widths of all pairs as ``groups + [width, n]``, without forming the pairs.

    ``keys`` name a channel within a frame, ``groups`` those of them to count by. Edges
    are counted per time cell of a channel first, and the counts of leading and trailing
    cells multiply: a cross-correlation. A channel meets in at most (window / cell)
    squared rows, however many edges it has. Widths are differences of cells times
    ``cell``: exact for times on that grid, else less than one cell off. ``whole`` says
    that all channels are small and placed already (``skew.by_size``): then leading and
    trailing cells meet where they lie.
    """
    both = edges.where(F.col("edge").isin(LEADING, TRAILING))
    cells = both.groupBy(*keys, "edge", F.floor(F.col(time) / F.lit(float(cell))).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    if not whole:
        # read from both sides of the join below
        cells = materialise(cells, "edge-cells")
    lead = cells.where(F.col("edge") == LEADING).select(*keys, F.col("_cell").alias("_from"), F.col("_n").alias("_m"))
    trail = cells.where(F.col("edge") == TRAILING).select(*keys, "_cell", "_n")
    # the product of two row counts can pass the range of a long
    pairs = F.col("_m").cast("decimal(19,0)") * F.col("_n").cast("decimal(18,0)")
    return (
        lead.join(trail, keys)
        .select(*groups, (F.col("_cell") - F.col("_from")).alias("_width"), pairs.cast("decimal(28,0)").alias("_pairs"))
        .groupBy(*groups, "_width")
        .agg(F.sum("_pairs").alias("n"))
        .select(*groups, (F.col("_width") * F.lit(float(cell))).alias("width"), "n")
    )
