"""Guards for broadcasts, and groups of very different size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitframe.sources.stages import materialise

# Largest table that is ever sent to every executor. Rows of the tables concerned
# (maps, curves, group keys) are a few numbers wide, so this is some ten megabytes.
MAX_BROADCAST_ROWS = 200_000
# A group of up to so many rows is left whole; larger ones are spread over tasks.
WHOLE_GROUP = 10_000
# Rows of whole groups that a task is given: with more data the tasks become more.
TASK_ROWS = 250_000


def bounded_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast if it is known to be small.

    ``rows`` is an upper bound the caller can prove (a histogram cannot have more
    rows than bins times groups). Without one the table is counted, reading no
    more than the limit. A larger table is returned unmarked: the join then
    shuffles both sides and splits skewed partitions.
    """
    if rows is None:
        rows = df.limit(MAX_BROADCAST_ROWS + 1).count()
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def all_known(keys: list[str]) -> Column:
    """None of the keys is null."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def by_size(table: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """``(few, many)``: the rows of the small groups, placed by the keys, and of the large.

    What groups ``few`` by the keys and any further columns needs no other shuffle, and
    a task gets some ``TASK_ROWS`` rows of it, however many there are. ``many`` is not
    placed, and None where no group has more than ``WHOLE_GROUP`` rows. Every row is in
    one of the two, those with null keys as well. The rows are read several times, so a
    table that is written down should be handed in.
    """
    sizes = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large = materialise(
        sizes.where(F.col("_rows") > WHOLE_GROUP).select(*[F.col(k).alias(f"_large_{k}") for k in keys]), "large-groups"
    )
    few, many = table, None
    if not large.isEmpty():
        large = bounded_broadcast(large)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_large_{k}")) for k in keys])
        few, many = table.join(large, same, "left_anti"), table.join(large, same, "left_semi")
    tasks = max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // TASK_ROWS))
    return few.repartition(tasks, *keys), many
