"""Exact integer k-means over vectors kept as subvector dictionaries."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitframe.sources.stages import materialise

from .common import arrow_rows, for_python

# dimensions of a block: each distinct pair of components is one dictionary entry
BLOCK = 2
# vectors that share one set of dictionaries
CHUNK = 1 << 15
# Components beyond this would let a squared distance of 64 of them pass a long.
LARGEST = 1 << 27


def grid_vectors(vectors: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """``(id, v)``: whole vectors of ``dims`` finite components, as integers floor(scale * x)."""
    x = F.col(vector).cast("array<double>")
    odd = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf")))
    whole = vectors.select(F.col(key).cast("long").alias("id"), x.alias("x")).where(
        (F.size("x") == dims) & ~F.exists("x", odd)
    )
    steps = F.transform("x", lambda e: F.floor(e * F.lit(float(scale))))
    large = F.exists("x", lambda e: F.abs(e * F.lit(float(scale))) > F.lit(float(LARGEST)))
    checked = F.when(large, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(steps)
    return whole.select("id", checked.cast("array<int>").alias("v"))


def first_centroids(rows: DataFrame, k: int) -> list[list[int]]:
    """The vectors of smallest SHA-256 of ``1:<id>``, in that order; at most ``k`` rows."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    first = rows.where("id IS NOT NULL").select(digest.alias("h"), "v").orderBy("h", "v").limit(k)
    return [list(r["v"]) for r in first.collect()]


def encode_chunks(rows: DataFrame, dims: int) -> DataFrame:
    """``(ids, missing, codes, entries, sizes)``: a chunk of vectors in dictionary form.

    Each block of dimensions has a dictionary of its distinct subvectors in the chunk;
    a vector is one code a block. Nothing is lost: entry for entry the codes give the
    components back. A chunk is bounded in rows, so memory is, whatever the vectors are.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = ["ids", "missing", "codes", "entries", "sizes"]

        def chunk(parts):
            ids = pa.concat_arrays([p[0] for p in parts])
            v = np.concatenate([p[1] for p in parts])
            codes, entries = [], []
            for at in range(0, dims, BLOCK):
                block = v[:, at : at + BLOCK].astype(np.int64)
                # two components of 32 bits as one number; a last odd one stands alone
                number = block[:, 0] << 32 | (block[:, -1] & 0xFFFFFFFF)
                _, first, code = np.unique(number, return_index=True, return_inverse=True)
                codes.append(code.astype(np.uint16 if len(first) <= 1 << 16 else np.uint32))
                entries.append(v[first, at : at + BLOCK].astype(np.int32))
            wide = np.uint32 if any(c.dtype == np.uint32 for c in codes) else np.uint16
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([ids.fill_null(0).to_numpy().tobytes()], pa.binary()),
                    pa.array([np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes()], pa.binary()),
                    pa.array([np.stack(codes).astype(wide).tobytes()], pa.binary()),
                    pa.array([b"".join(e.tobytes() for e in entries)], pa.binary()),
                    pa.array([[len(e) for e in entries]], pa.list_(pa.int32())),
                ],
                names=names,
            )

        parts, held = [], 0
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy()
            parts.append((batch.column(0), flat.reshape(-1, dims)))
            held += batch.num_rows
            if held >= CHUNK:
                yield chunk(parts)
                parts, held = [], 0
        if held:
            yield chunk(parts)

    schema = "ids binary, missing binary, codes binary, entries binary, sizes array<int>"
    return rows.select("id", "v").mapInArrow(run, schema)


def _assigned(batch, centroids, dims: int):
    """Per chunk of a batch: ids, nulls, codes, dictionaries, nearest centroid, distance.

    The distance of every dictionary entry to every centroid's block is worked out once;
    a vector's distances are the sums of the entries that its codes name. Ties go to the
    smaller number.
    """
    import numpy as np

    blocks = -(-dims // BLOCK)
    for row in batch.to_pylist():
        ids = np.frombuffer(row["ids"], np.int64)
        n = len(ids)
        missing = np.unpackbits(np.frombuffer(row["missing"], np.uint8), count=n).astype(bool)
        codes = np.frombuffer(row["codes"], np.uint8)
        codes = codes.view(np.uint16 if len(codes) == 2 * n * blocks else np.uint32).reshape(blocks, n)
        flat, at, entries = np.frombuffer(row["entries"], np.int32).astype(np.int64), 0, []
        total = np.zeros((n, len(centroids)), np.int64)
        for b, size in enumerate(row["sizes"]):
            width = min(BLOCK, dims - b * BLOCK)
            entry = flat[at : at + size * width].reshape(size, width)
            at += size * width
            entries.append(entry)
            apart = entry[:, None, :] - centroids[None, :, b * BLOCK : b * BLOCK + width]
            total += (apart * apart).sum(axis=2)[codes[b]]
        nearest = total.argmin(axis=1)
        yield ids, missing, codes, entries, nearest, total[np.arange(n), nearest]


def _sums(chunks: DataFrame, centroids, dims: int) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of each centroid's vectors: k rows of sums come back.

    A task hands on one row per centroid and component, from how often each dictionary
    entry stands in each cluster.
    """
    import numpy as np

    k = len(centroids)

    def run(batches):
        import pyarrow as pa

        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, _, codes, entries, nearest, _ in _assigned(batch, centroids, dims):
                counts += np.bincount(nearest, minlength=k)
                for b, entry in enumerate(entries):
                    times = np.bincount(nearest * len(entry) + codes[b], minlength=k * len(entry))
                    sums[:, b * BLOCK : b * BLOCK + entry.shape[1]] += times.reshape(k, -1) @ entry
        used = np.flatnonzero(counts)
        each = np.concatenate([counts[used, None], sums[used]], axis=1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, dims + 1), pa.int32()),
                pa.array(np.tile(np.arange(dims + 1), len(used)), pa.int32()),
                pa.array(each.ravel()),
            ],
            names=["cluster", "place", "n"],
        )

    rows = chunks.mapInArrow(run, "cluster int, place int, n long")
    total = rows.groupBy("cluster", "place").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"))
    out: dict[int, list[int]] = {}
    for r in total.collect():
        out.setdefault(r["cluster"], [0] * (dims + 1))[r["place"]] = int(r["n"])
    return {c: (v[0], v[1:]) for c, v in out.items()}


def _distances(chunks: DataFrame, centroids, dims: int) -> DataFrame:
    """``(id, cluster, distance)`` of every vector."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for ids, missing, _, _, nearest, distance in _assigned(batch, centroids, dims):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, mask=missing),
                        pa.array(nearest.astype(np.int32)),
                        pa.array(distance),
                    ],
                    names=["id", "cluster", "distance"],
                )

    return chunks.mapInArrow(run, "id long, cluster int, distance long")


def _per_cluster(cluster: Column, values: list) -> Column:
    """One literal per cluster, taken by its number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), cluster + 1)


def cluster_vectors(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(key, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per vector.

    Vectors become integers floor(scale * x). The first centroids are those of smallest
    SHA-256 of ``1:<id>``; each round puts every vector to its nearest centroid by squared
    distance (ties: the smaller number) and moves each centroid that has any to the floor
    of their exact mean. After the rounds vectors are assigned once more.

    The vectors are written once, as chunks with one dictionary per block of dimensions;
    rounds read these alone, without any shuffle but that of the k sums.

    Vectors that are null, of another length, or with a null or non-finite component are
    left out. A vector without an id takes part but is never a first centroid. Rows that
    repeat an id are vectors of their own; as first centroids they go in the order of
    their components. With fewer vectors than ``k`` there are as many centroids as vectors
    with an id. Tables without any give no rows. Components beyond 2**27 are an error,
    since distances would pass a long. Other columns are not read.
    """
    import numpy as np

    spark = vectors.sparkSession
    for_python(spark, 8192)
    rows = grid_vectors(vectors, key, vector, dims, scale)
    start = first_centroids(rows, k)
    names = [key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    if not start:
        empty = "id long, cluster int, distance long, cluster_inertia long, inertia long, sha string"
        return spark.createDataFrame([], empty).toDF(*names)
    chunks = materialise(encode_chunks(rows, dims), "vector-chunks")
    centroids = np.array(start, np.int64)
    with arrow_rows(spark, 4):
        for _ in range(rounds):
            for c, (count, sums) in _sums(chunks, centroids, dims).items():
                centroids[c] = [s // count for s in sums]
        placed = materialise(_distances(chunks, centroids, dims), "vector-distances")
    # the total of a cluster must fit the long it is returned as
    inertia = [0] * len(centroids)
    totals = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).cast("long").alias("n"))
    for r in totals.collect():
        inertia[r["cluster"]] = r["n"]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return placed.select(
        F.col("id").alias(key),
        "cluster",
        "distance",
        _per_cluster(F.col("cluster"), inertia).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        _per_cluster(F.col("cluster"), digests).alias("centroid_sha256"),
    )
