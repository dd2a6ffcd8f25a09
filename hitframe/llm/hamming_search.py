"""Exact nearest binary codes by multi-index hashing with growing radii."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitframe.sources.stages import materialise

from .common import for_python

BITS, SEGMENTS = 64, 8
WIDTH = BITS // SEGMENTS
# Codes that give each query a first bound on its k-th distance. The bound only
# prunes: a larger sample makes it tighter, never the result different.
SAMPLE = 8192


def sign_code(vector: Column) -> Column:
    """Bit i is set if element i is positive; more than 64 elements are an error."""
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.size(vector) > BITS, F.raise_error(F.lit(f"more than {BITS} elements"))).when(
        vector.isNotNull(), code
    )


def _segment(code: Column, at: int) -> Column:
    return F.shiftrightunsigned(code, WIDTH * at).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _segments(code: Column) -> Column:
    return F.array(*[_segment(code, i) for i in range(SEGMENTS)])


def _masks(radius: int) -> Column:
    """All values of a segment's width with ``radius`` bits set."""
    return F.array(*[F.lit(m).cast("long") for m in range(1 << WIDTH) if m.bit_count() == radius])


def _found_first(apart: Column, segment: Column, radius: int) -> Column:
    """Whether this probe is the first to meet the pair: no segment is nearer, and
    none before this one is as near. Every pair is thus verified once."""
    found = F.lit(True)
    for i in range(SEGMENTS):
        here = F.bit_count(_segment(apart, i))
        found = found & (here >= radius) & ((here > radius) | (segment <= i))
    return found


def _nearest(rows: DataFrame, keep: int) -> DataFrame:
    window = Window.partitionBy("q").orderBy("distance", F.col("ids")[0], "code")
    return rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= keep).drop("_rank")


def _first_bounds(queries: DataFrame, index: DataFrame, keep: int) -> DataFrame:
    """``(q, bound)``: the distance of the ``keep``-th nearest sampled code."""
    sample = [r["code"] for r in index.orderBy(F.xxhash64("code"), "code").limit(SAMPLE).select("code").collect()]
    for_python(queries.sparkSession, 1024)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        codes = np.array(sample, np.int64)
        for batch in batches:
            q = batch.column(0).to_numpy()
            if len(codes) < keep:
                bound = np.full(len(q), BITS)
            else:
                apart = np.bitwise_count((q[:, None] ^ codes[None, :]).view(np.uint64))
                bound = np.partition(apart, keep - 1, axis=1)[:, keep - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bound.astype(np.int32))], names=["q", "bound"]
            )

    return queries.mapInArrow(run, "q long, bound int")


def nearest_codes(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(key, rank, neighbor_id, distance)``: the k nearest other rows of each query row.

    Neighbours are ordered by Hamming distance of the sign codes, then id. Rows are
    gathered by code with their k + 1 smallest ids, so copies of a code cost no more
    than one, and each code is indexed under each of its segments. Round r probes the
    segment values at distance r and verifies whole codes. After it every code within
    ``SEGMENTS * (r + 1) - 1`` has been met, since a farther one alone can differ by
    more than r in all segments; a query ends when its k-th distance is within that.

    Rows without a vector or an id neither search nor are found. Vectors without
    elements have code 0. Rows that repeat an id are one row if their codes agree,
    else each is found, and as a query the row's own id is left out. Other columns
    are not read. Fewer than k rows are returned only if there are no more.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), sign_code(F.col(vector)).alias("code"), is_query.alias("_query")
    ).where("id IS NOT NULL AND code IS NOT NULL").distinct()
    rows = materialise(rows, "codes")
    keep = k + 1  # a query row is among its own nearest
    first = Window.partitionBy("code").orderBy("id")
    index = materialise(
        rows.withColumn("_at", F.row_number().over(first))
        .where(F.col("_at") <= keep)
        .groupBy("code")
        .agg(F.sort_array(F.collect_list("id")).alias("ids")),
        "code-index",
    )
    buckets = index.select("code", "ids", F.posexplode(_segments(F.col("code"))).alias("segment", "value"))
    queries = rows.where("_query").select(F.col("code").alias("q")).distinct()
    active = materialise(_first_bounds(queries, index, keep), "bounds")
    best, finished = None, []
    for radius in range(WIDTH + 1):
        probes = active.select("q", "bound", F.posexplode(_segments(F.col("q"))).alias("segment", "_own")).select(
            "q", "bound", "segment", F.explode(F.transform(_masks(radius), lambda m: m.bitwiseXOR(F.col("_own")))).alias("value")
        )
        apart = F.col("q").bitwiseXOR(F.col("code"))
        met = (
            probes.join(buckets, ["segment", "value"])
            .where((F.bit_count(apart) <= F.col("bound")) & _found_first(apart, F.col("segment"), radius))
            .select("q", "code", "ids", F.bit_count(apart).alias("distance"))
        )
        met = met if best is None else met.unionByName(best.join(active.select("q"), "q", "left_semi"))
        best = materialise(_nearest(met, keep), "nearest-codes")
        upto = Window.partitionBy("q").orderBy("distance", F.col("ids")[0], "code")
        kth = (
            best.withColumn("_rows", F.sum(F.size("ids")).over(upto))
            .groupBy("q")
            .agg(F.min(F.when(F.col("_rows") >= keep, F.col("distance"))).alias("_kth"))
        )
        covered = SEGMENTS * (radius + 1) - 1
        # without k rows yet the first bound stays
        state = materialise(
            active.join(kth, "q", "left").select(
                "q",
                F.least("bound", "_kth").alias("bound"),
                (F.coalesce("_kth", F.lit(BITS + 1)) <= covered).alias("_done"),
            ),
            "bounds",
        )
        finished.append(best.join(state.where("_done"), "q", "left_semi"))
        active = state.where("NOT _done").select("q", "bound")
        if active.isEmpty():
            break
    else:
        finished.append(best.join(active, "q", "left_semi"))  # all rows met, fewer than k
    found = finished[0]
    for more in finished[1:]:
        found = found.unionByName(more)
    pairs = (
        rows.where("_query")
        .select("id", F.col("code").alias("q"))
        .join(found, "q")
        .select("id", F.explode("ids").alias("neighbor_id"), "distance")
        .where("id != neighbor_id")
        .groupBy("id", "neighbor_id")
        .agg(F.min("distance").alias("distance"))
    )
    order = Window.partitionBy("id").orderBy("distance", "neighbor_id")
    return (
        pairs.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(F.col("id").alias(key), F.col("rank").cast("long").alias("rank"), "neighbor_id", F.col("distance").cast("long").alias("distance"))
    )
