"""From hits to one row per frame: slots, ranked lists, coincidence, sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitframe.config import FRAME
from hitframe.sources.stages import materialise

from .skew import all_known, by_size


def by_charge(charge: str = "charge", *ties: str) -> list[Column]:
    """Charge descending; ties in ascending order make the order total."""
    return [F.col(charge).desc(), *[F.col(t).asc() for t in ties]]


def leading_hit(
    hits: DataFrame, keys: list[str], values: list[str], ties: list[str], charge: str = "charge"
) -> DataFrame:
    """Hit of largest charge per group as ``<value>0`` columns, with the group size.

    One pass with a fixed-size buffer per group: it combines before the shuffle,
    and needs none where the hits are already placed by frame. Equal charges go by
    ``ties`` in their order, then by the remaining ``values``, so the order is total.
    """
    rest = [v for v in values if v not in ties and v != charge]
    best = F.min(F.struct((-F.col(charge)).alias("_neg"), *ties, *rest, charge))
    return (
        hits.groupBy(*keys)
        .agg(best.alias("_best"), F.count(F.lit(1)).alias("size"))
        .select(*keys, "size", *[F.col(f"_best.{v}").alias(f"{v}0") for v in values])
    )


def group_sizes(hits: DataFrame, keys: list[str]) -> DataFrame:
    return hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))


def top_hits(hits: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` hits of each group, with ``rank`` from 1.

    A filter on row_number lets Spark keep only ``k`` rows per group before the
    shuffle as well as after it, so a group of any size costs ``k`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return hits.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def hit_slots(
    hits: DataFrame,
    keys: list[str],
    order: list[Column],
    slots: dict[str, int],
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Scalar slots of the charge-ordered list: ``{"id": 3}`` gives id0, id1, id2.

    Missing positions are null. ``sizes`` replaces the plain row count where the
    rows at hand are only the candidates for the slots.
    """
    top = top_hits(hits, keys, order, max(slots.values())).select(*keys, "rank", *slots)
    cells = [
        F.max(F.when(F.col("rank") == i + 1, F.col(c))).alias(f"{c}{i}")
        for c, n in slots.items()
        for i in range(n)
    ]
    sizes = group_sizes(hits, keys) if sizes is None else sizes
    # Both parts are placed by the keys already, and a grouped union needs neither
    # a join nor another exchange.
    both = top.unionByName(sizes.select(*keys, "size"), allowMissingColumns=True)
    return both.groupBy(*keys).agg(F.max("size").alias("size"), *cells)


def placed_in_ranges(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The rows as a table, cut into ``_range`` pieces along (keys, order).

    A group of any share lies in several pieces. The cuts come from sampling, so they
    are written down once; everything after reads that table and a retried task sees
    the same pieces.
    """
    placed = rows.repartitionByRange(*[F.col(k) for k in keys], *order)
    return materialise(placed.withColumn("_range", F.spark_partition_id()), "ranges")


def ranked_hits(hits: DataFrame, keys: list[str], order: list[Column], whole: bool = False) -> DataFrame:
    """The whole charge-ordered list of each group, one row per hit with its rank.

    Long form on purpose: a list in one cell would have to fit one task, whatever
    the size of the group. Small groups are ranked as they are; ``whole`` says that all
    are small and placed already (``skew.by_size``), so that nothing moves. Hits without
    a key are in no list.
    """
    hits = hits.where(all_known(keys))
    columns = [*keys, *[c for c in hits.columns if c not in keys], "rank"]
    many = None
    if not whole:
        hits, many = by_size(materialise(hits, "hits"), keys)
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).select(*columns)
    if many is None:
        return ranked
    return ranked.unionByName(_ranked_in_ranges(many, keys, order).select(*columns))


def _ranked_in_ranges(hits: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The same for groups of any size.

    All hits are cut into ranges of the order, so a group of any share lies in several,
    and the rank is the number of the group's rows in earlier ranges plus the position
    in the own range.
    """
    placed = placed_in_ranges(hits, keys, order)
    pieces = [*keys, "_range"]
    # one row per group and range: the window below sees at most one per range
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy(*pieces)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*pieces, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(Window.partitionBy(*pieces).orderBy(*order))
    return (
        placed.withColumn("_local", local)
        .join(before, pieces)
        .withColumn("rank", F.col("_local") + F.col("_before"))
        .drop("_range", "_local", "_before")
    )


def one_row_per_frame(
    groups: DataFrame,
    by: str,
    members: list[str] | tuple[str, ...],
    values: list[str],
    name: str,
    frame: tuple[str, ...] = FRAME,
    carry: tuple[str, ...] = (),
    require_all: bool = False,
) -> DataFrame:
    """Wide frames from one row per (frame, member).

    Equals the full outer join of the members, or with ``require_all`` their inner
    join (a coincidence), in a single grouped pass. ``name`` is a pattern such as
    ``"{value}_{member}"``; ``carry`` are columns that are constant in a frame.
    """
    cells = [
        F.max(F.when(F.col(by) == m, F.col(v))).alias(name.format(value=v, member=m))
        for m in members
        for v in values
    ]
    wide = groups.where(F.col(by).isin(*members)).groupBy(*frame).agg(
        F.count(F.lit(1)).alias("_members"), *cells, *[F.max(c).alias(c) for c in carry]
    )
    if require_all:
        wide = wide.where(F.col("_members") == len(members))
    return wide.drop("_members")


def coincident_hits(
    hits: DataFrame,
    planes: list[str] | tuple[str, ...],
    frame: tuple[str, ...] = FRAME,
    whole: bool = False,
) -> DataFrame:
    """All hits of the frames in which every plane has at least one.

    The surviving frames are written down, one number each, so that the semi-join
    has an exchange on both sides and can split a frame with very many hits. ``whole``
    says that all frames are small and placed already (``skew.by_size``): then the frames
    meet their hits where they lie.
    """
    bits = F.lit(0).cast("long")
    for i, plane in enumerate(planes):
        bits = F.when(F.col("plane") == plane, F.lit(1 << i).cast("long")).otherwise(bits)
    frames = (
        hits.groupBy(*frame)
        .agg(F.bit_or(bits).alias("_planes"))
        .where(F.col("_planes") == (1 << len(planes)) - 1)
        .select(*frame)
    )
    if not whole:
        frames = materialise(frames, "coincident-frames")
    return hits.join(frames, list(frame), "left_semi")


def multiplicity_cut(
    limit: int, sides: tuple[str, ...] = ("x", "y"), above: int | None = 1
) -> Column:
    """More than ``above`` (None: any number) and fewer than ``limit`` hits on every side."""
    cut = F.lit(True)
    for s in sides:
        cut = cut & (F.col(f"size_{s}") < limit)
        if above is not None:
            cut = cut & (F.col(f"size_{s}") > above)
    return cut


def neighbour_cut(sides: tuple[str, ...] = ("x", "y"), second: str = "id1") -> Column:
    """The named strip is next to the leading one on every side."""
    cut = F.lit(True)
    for s in sides:
        cut = cut & (F.abs(F.col(f"id0_{s}") - F.col(f"{second}_{s}")) == 1)
    return cut


def cluster_cut(sides: tuple[str, ...] = ("x", "y")) -> Column:
    """Three charged strips with both lesser ones next to the leading one."""
    cut = neighbour_cut(sides, "id1") & neighbour_cut(sides, "id2")
    for s in sides:
        cut = cut & (F.col(f"charge2_{s}") > 0)
    return cut


def edge_wire_veto(last: int, wire: str = "id0") -> Column:
    return (F.col(wire) > 0) & (F.col(wire) < last)
