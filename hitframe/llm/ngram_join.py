"""Exact Jaccard self-join on word shingles as a join in a metric space."""

from __future__ import annotations

import hashlib
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitframe.session import drop_paths, release_shuffles, scratch_path, scratch_scope
from hitframe.sources.stages import materialise, write_bucketed

from .common import BLANKS, for_python
from .components import components

SHINGLE = 5
# 100 * intersection >= PERCENT * union
PERCENT = 80
# shingles are counted in 2**ORDER_BITS classes to tell common ones from rare ones
ORDER_BITS = 16
# pivot rounds before what is left of a posting is joined directly
ROUNDS = 4
# postings with more members than this get another pivot round
LARGE = 64
# bytes of a word that is hashed with the others
SHORT_WORD = 64
# 64-bit words of a set's short parity sketch
SKETCH_WORDS = 8
# a long sketch has so many bits for each shingle at least
BITS_EACH = 2


def _number(name: str, i: int) -> int:
    """A fixed odd 64-bit number."""
    return int.from_bytes(hashlib.blake2b(f"{name} {i}".encode(), digest_size=8).digest(), "big") | 1


@lru_cache(maxsize=4)
def _factors(n: int):
    """One factor per place of a shingle, one per length below n, and one to mix with."""
    import numpy as np

    return np.array([_number("place", i) for i in range(2 * n)], np.uint64)


@lru_cache(maxsize=1)
def _blanks():
    """Which bytes are white space."""
    import numpy as np

    blank = np.zeros(256, bool)
    blank[[ord(c) for c in BLANKS]] = True
    return blank


def word_hashes(text: str):
    """A 64-bit hash of each word, lower-cased for A-Z, cut at [\x20\x09-\x0D].

    Words of up to ``SHORT_WORD`` bytes are mixed eight bytes at a time, all words at
    once: each step multiplies and folds what came before, so no sum over places can
    be made to agree. Longer words have a digest of their own.
    """
    import numpy as np

    raw = text.encode().lower()
    data = np.frombuffer(raw + bytes(8), np.uint8)
    ends = np.flatnonzero(np.diff(_blanks()[data[: len(raw)]], prepend=True, append=True))
    starts, sizes = ends[::2], ends[1::2] - ends[::2]
    # the number of the eight bytes from each place on
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    keep = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    first, second = np.uint64(_number("word", 0)), np.uint64(_number("word", 1))
    hashes = sizes.astype(np.uint64) * second
    live = np.flatnonzero(sizes <= SHORT_WORD)
    at = 0
    while len(live):
        part = np.ascontiguousarray(eight[starts[live] + at]).view("<u8").ravel()
        part = part & keep[np.minimum(sizes[live] - at, 8)]
        mixed = (hashes[live] ^ part) * first
        mixed ^= mixed >> np.uint64(32)
        mixed *= second
        hashes[live] = mixed ^ (mixed >> np.uint64(29))
        at += 8
        live = live[sizes[live] > at]
    for i in np.flatnonzero(sizes > SHORT_WORD):
        word = raw[starts[i] : starts[i] + sizes[i]]
        hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "big")
    return hashes * _factors(1)[0]


def shingle_set(text: str | None, n: int = SHINGLE):
    """Sorted distinct 64-bit hashes of the n-word shingles of the whole text.

    A text of fewer than n words is one shingle; one without words has none. A shingle
    is a mixed sum of word hashes times place factors, so unequal shingles of two
    texts meet with a probability of some 2**-60 each.
    """
    import numpy as np

    hashes = word_hashes(text or "")
    if not len(hashes):
        return hashes
    factors = _factors(n)
    size = min(n, len(hashes))
    count = len(hashes) - size + 1
    mixed = np.full(count, factors[n + size - 1])
    for i in range(size):
        mixed += hashes[i : i + count] * factors[i]
    mixed ^= mixed >> np.uint64(29)
    mixed *= factors[n]
    mixed ^= mixed >> np.uint64(32)
    mixed.sort()
    return mixed[np.diff(mixed, prepend=~mixed[:1]) != 0]


def prefix_size(n: int, percent: int) -> int:
    """A set of size n shares one of so many of its shingles with any set it links to."""
    return n - -(-percent * n // 100) + 1


def _digests(docs: DataFrame, shingle: int) -> DataFrame:
    """``(_id, n, digest)`` per document, and rows ``(place, times)`` of shingle counts."""
    places = 1 << ORDER_BITS

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = ["_id", "n", "digest", "place", "times"]
        counts = np.zeros(places, np.int64)
        for batch in batches:
            sets = [shingle_set(t, shingle) for t in batch.column(1).to_pylist()]
            rows = len(sets)
            classes = np.concatenate([*sets, np.empty(0, np.uint64)]) >> np.uint64(64 - ORDER_BITS)
            counts += np.bincount(classes.astype(np.int64), minlength=places)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.sha256(s.tobytes()).digest() for s in sets], pa.binary()),
                    pa.nulls(rows, pa.int32()),
                    pa.nulls(rows, pa.int64()),
                ],
                names=names,
            )
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(used), pa.int64()),
                pa.nulls(len(used), pa.int64()),
                pa.nulls(len(used), pa.binary()),
                pa.array(used, pa.int32()),
                pa.array(counts[used]),
            ],
            names=names,
        )

    return docs.mapInArrow(run, "_id long, n long, digest binary, place int, times long")


def _order(spark: SparkSession, digests: DataFrame):
    """How common the shingles of each class are, over all documents.

    One number per class, whatever the size of the input, so it can go everywhere.
    """
    import numpy as np

    ranks = np.zeros(1 << ORDER_BITS, np.int64)
    rows = digests.where("place IS NOT NULL").groupBy("place").agg(F.sum("times").alias("times"))
    for r in rows.collect():
        ranks[r["place"]] = r["times"]
    return spark.sparkContext.broadcast(ranks)


def _postings(docs: DataFrame, order, shingle: int, percent: int) -> DataFrame:
    """``(token, set, id, n)``: the rarest shingles of each set, enough to meet all links."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        times = order.value
        for batch in batches:
            tokens, sizes, keys = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, shingle)
                rank = times[(s >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
                size = prefix_size(len(s), percent) if len(s) else 0
                tokens.append(s[np.lexsort((s, rank))[:size]])
                sizes.append(len(s))
                keys.append(int.from_bytes(hashlib.sha256(s.tobytes()).digest()[:8], "little", signed=True))
            each = [len(t) for t in tokens]
            repeat = lambda values: np.repeat(np.array(values, np.int64), each)
            row = pa.array(np.repeat(np.arange(len(each)), each))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens).view(np.int64) if tokens else np.empty(0, np.int64)),
                    pa.array(repeat(keys)),
                    batch.column(0).take(row),
                    pa.array(repeat(sizes)),
                ],
                names=["token", "set", "id", "n"],
            )

    return docs.mapInArrow(run, "token long, set long, id long, n long")


def _shared(postings: DataFrame) -> DataFrame:
    """``(token, id, n)`` of tokens that two sets or more have, copies of a set as one.

    One shuffle by token; the runs of equal tokens are then read in order, holding
    one row back, so a token of any frequency needs no more memory than another.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = None  # the last row, and whether it was part of a run already
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = np.stack([c.to_numpy() for c in batch.columns])
            if held is not None:
                cols = np.concatenate([held[0], cols], axis=1)
            token, key = cols[0], cols[1]
            same = token[1:] == token[:-1]
            new = np.concatenate([[True], ~same | (key[1:] != key[:-1])])
            if held is not None:
                new[0] = held[1]
            cols = cols[:, new]
            if not cols.shape[1]:
                continue
            token = cols[0]
            same = token[1:] == token[:-1]
            shared = np.concatenate([[held is not None and held[2]], same]) | np.concatenate([same, [False]])
            out = cols[:, :-1][:, shared[:-1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[i]) for i in (0, 2, 3)], names=["token", "id", "n"]
            )
            held = (cols[:, -1:], True, bool(shared[-1]))
        if held is not None and held[2]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(held[0][i]) for i in (0, 2, 3)], names=["token", "id", "n"]
            )

    # the smallest id of a set comes first and stands for it
    ordered = postings.repartition("token").sortWithinPartitions("token", "set", "id")
    return ordered.mapInArrow(run, "token long, id long, n long")


def _long_sketch_bits(n: int) -> int:
    """A power of two, so that the sketch of a set folds to that of a smaller one."""
    return max(64 * SKETCH_WORDS, 1 << (BITS_EACH * n - 1).bit_length())


def _sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """``(id, n, s0, s1, ..., long)``: size and parity sketches of each set.

    Every shingle flips one of the bits. Two sketches differ in no more bits than
    the sets have unshared shingles, which bounds their distance from below. The
    short sketch has few bits for all sets alike, the long one grows with the set.
    """
    names = [f"s{i}" for i in range(SKETCH_WORDS)]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def flipped(s, bits: int):
            flips = np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
            return np.packbits(flips.astype(np.uint8))

        for batch in batches:
            rows = np.zeros((batch.num_rows, SKETCH_WORDS), np.int64)
            sizes, long = [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                s = shingle_set(text, shingle)
                rows[at] = flipped(s, 64 * SKETCH_WORDS).view(np.int64)
                sizes.append(len(s))
                long.append(flipped(s, _long_sketch_bits(len(s))).tobytes())
            words = [pa.array(rows[:, i].copy()) for i in range(SKETCH_WORDS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *words, pa.array(long, pa.binary())],
                names=["id", "n", *names, "long"],
            )

    schema = "id long, n long, " + ", ".join(f"{x} long" for x in names) + ", long binary"
    return docs.select("_id", "_text").mapInArrow(run, schema)


def unshared(a: bytes, b: bytes) -> int:
    """How many shingles, at least, only one of the sets of two long sketches has."""
    import numpy as np

    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    folded = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ folded).sum())


def _far(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """``(a, b, bound)`` of pairs: a distance they have at least, by the long sketches."""
    side = lambda x: sketches.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("long").alias(f"long_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "n_a", "n_b", "long_a", "long_b")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            sizes = [batch.column(i).to_numpy() for i in (2, 3)]
            long = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)
            only = np.maximum(np.array([unshared(a, b) for a, b in long], np.int64), np.abs(sizes[0] - sizes[1]))
            bound = 2 * only / (sizes[0] + sizes[1] + only)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(bound, pa.float64())], names=["a", "b", "bound"])

    return both.mapInArrow(run, "a long, b long, bound double")


def _sketched(rows: DataFrame, sketches: DataFrame, side: str) -> DataFrame:
    """Rows with the size and the sketch of the set in the column ``side``."""
    words = [F.col(f"s{i}").alias(f"_{side}{i}") for i in range(SKETCH_WORDS)]
    return rows.join(sketches.select(F.col("id").alias(side), F.col("n").alias(f"_n{side}"), *words), side)


def _bound() -> Column:
    """A distance that the sets a and b have at least, from their sizes and sketches."""
    differing = F.lit(0)
    for i in range(SKETCH_WORDS):
        differing = differing + F.bit_count(F.col(f"_a{i}").bitwiseXOR(F.col(f"_b{i}")))
    unshared = F.greatest(differing.cast("long"), F.abs(F.col("_na") - F.col("_nb")))
    return 2 * unshared / (F.col("_na") + F.col("_nb") + unshared)


def _buckets_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _by_id(docs: DataFrame) -> tuple[DataFrame, str]:
    """The texts as a table bucketed by id, and its name.

    They are joined again and again; the buckets keep them from being shuffled with
    each join, only the narrow pairs move.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "candidates")
    name = "candidates_" + path.rsplit("-", 1)[1]
    buckets = _buckets_of(spark)
    writer = docs.repartition(buckets, "_id").write.bucketBy(buckets, "_id").sortBy("_id")
    writer.option("path", path).saveAsTable(name)
    return spark.table(name), name


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """``(a, b, common, whole)`` of distinct pairs, from the two whole texts."""

    def named(side: str) -> DataFrame:
        return docs.select(F.col("_id").alias(side), F.col("_text").alias(f"_text_{side}"))

    whole = pairs.join(named("b"), "b").join(named("a"), "a")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        last, left = None, None
        for batch in batches:
            a, b, text_a, text_b = [c.to_pylist() for c in batch.columns]
            common, union = [], []
            for i in range(len(a)):
                if (a[i], text_a[i]) != last:  # pairs of one a come one after another
                    last, left = (a[i], text_a[i]), shingle_set(text_a[i], shingle)
                right = shingle_set(text_b[i], shingle)
                both = len(np.intersect1d(left, right, assume_unique=True))
                common.append(both)
                union.append(len(left) + len(right) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(union, pa.int64())],
                names=["a", "b", "common", "whole"],
            )

    return whole.select("a", "b", "_text_a", "_text_b").mapInArrow(
        run, "a long, b long, common long, whole long"
    )


def _may_link(n1: str, n2: str, percent: int) -> Column:
    """Sizes that do not rule a link out."""
    return (F.col(n1) * 100 >= F.col(n2) * percent) & (F.col(n2) * 100 >= F.col(n1) * percent)


def _ordered(a: str, b: str) -> tuple[Column, Column]:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _links(shared: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between distinct sets: enough of them to connect all that are connected.

    The sets that share a token are a region. Its pivot is the set of which most
    tokens are shared, as the common origin of copies is. After a round the distances
    to the pivot are known, exact within the link distance r and bounded from below
    beyond it. Those within r (the ball) are connected through the pivot and need no
    more comparison among each other. By the triangle inequality a set at distance x
    can link to a ball member at distance y only if x - y <= r, so only sets up to 2r
    away are compared with the ball members they can reach, once per pivot, and only if
    the links found otherwise do not connect them to the ball.
    The sets outside the ball are a smaller region: a large one goes on with another
    pivot, a small one, or what is left after the last round, is joined directly. No
    pair is compared twice, and texts are read only for pairs that no bound excludes.
    """
    # distances of small whole numbers differ by far more than this allowance
    radius = (100 - percent) / 100 + 1e-9
    spark = docs.sparkSession
    path = scratch_path(spark, "sketches")
    # in buckets like the texts, so that they go to the pairs without being moved
    sketches = write_bucketed(_sketches(docs, shingle), path, ["id"], _buckets_of(spark), placed=True)
    degrees = shared.groupBy("id").agg(F.count(F.lit(1)).alias("_shared"), F.max("n").alias("_n"))
    prefix = F.col("_n") - F.ceil(F.col("_n") * percent / 100) + 1
    # the share of shared tokens, then the smallest id, in one decimal that hash
    # aggregates can hold: all tokens of a group of copies agree on one pivot
    share = F.floor(F.col("_shared") / prefix * 1_000_000).cast("decimal(10,0)") * F.lit(Decimal(10**20))
    place = F.lit(Decimal(2**63 - 1)) - F.col("id").cast("decimal(20,0)")
    weights = degrees.select("id", (share + place).cast("decimal(31,0)").alias("weight"))
    region = materialise(shared.join(weights, "id").select("token", "id", "n", "weight"), "region")
    small, done, near = None, None, None

    def unlinked(bounded: DataFrame) -> DataFrame:
        far = bounded.where(F.col("bound") > radius)
        return far.select("a", "b", F.col("bound").alias("d"), F.lit(False).alias("linked"))

    def verify(close: DataFrame) -> DataFrame:
        """Distances of pairs: exact for those that the long sketches do not rule out."""
        bounded = materialise(_far(close, sketches), "bounded-pairs")
        exact = _verified(bounded.where(F.col("bound") <= radius).select("a", "b"), docs, shingle).select(
            "a",
            "b",
            (1 - F.col("common") / F.col("whole")).alias("d"),
            (F.col("common") * 100 >= F.col("whole") * percent).alias("linked"),
        )
        return materialise(exact.unionByName(unlinked(bounded)), "verified-pairs")

    def compare(pairs: DataFrame) -> None:
        """Bound or verify the pairs not seen yet and remember them."""
        nonlocal done
        new = pairs.distinct() if done is None else pairs.distinct().join(done, ["a", "b"], "left_anti")
        both = _sketched(_sketched(new, sketches, "b"), sketches, "a")
        bounded = materialise(both.select("a", "b", _bound().alias("bound")), "bounded-pairs")
        found = verify(bounded.where(F.col("bound") <= radius).select("a", "b")).unionByName(unlinked(bounded))
        done = found if done is None else done.unionByName(found)
        release_shuffles(docs.sparkSession)

    for _ in range(ROUNDS):
        heads = region.groupBy("token").agg(F.max("weight").alias("_top"))
        pivot = F.lit(Decimal(2**63 - 1)) - (F.col("_top") % F.lit(Decimal(10**20))).cast("decimal(20,0)")
        heads = heads.select("token", pivot.cast("long").alias("pivot"))
        members = region.join(heads, "token").where("id != pivot")
        compare(members.select(*_ordered("pivot", "id")))
        distances = done.select(F.col("a").alias("pivot"), F.col("b").alias("id"), "d").unionByName(
            done.select(F.col("b").alias("pivot"), F.col("a").alias("id"), "d")
        )
        measured = materialise(members.join(distances, ["pivot", "id"]), "measured")
        around = measured.where(F.col("d") <= 2 * radius).select("pivot", "id", "d")
        near = around if near is None else near.unionByName(around)
        left = measured.where(F.col("d") > radius).select(*region.columns)
        large = left.groupBy("token").count().where(F.col("count") > LARGE).select("token")
        direct = left.join(large, "token", "left_anti")
        small = direct if small is None else small.unionByName(direct)
        region = materialise(left.join(large, "token", "left_semi"), "large-regions")
        if region.isEmpty():
            break
    # the sketches come along, so that only pairs that no bound excludes leave the join
    rest = materialise(small.unionByName(region).select("token", "id"), "rest")
    one = _sketched(rest.withColumnRenamed("id", "a"), sketches, "a")
    two = _sketched(rest.withColumnRenamed("id", "b"), sketches, "b")
    compare(one.join(two, "token").where((F.col("a") < F.col("b")) & (_bound() <= radius)).select("a", "b"))
    links = materialise(done.where("linked").select("a", "b"), "set-links")
    edge = _reached(materialise(near.distinct(), "pivot-distances"), links, sketches, radius)
    return links.unionByName(verify(edge.join(done, ["a", "b"], "left_anti")).where("linked").select("a", "b"))


def _reached(near: DataFrame, links: DataFrame, sketches: DataFrame, radius: float) -> DataFrame:
    """Pairs ``(a, b)`` of a set beyond a pivot's ball and a ball member that may link.

    A pivot has one ball, whatever tokens it was met by. What the links connect to the
    ball already needs no comparison with it, and the bounds are part of the join.
    """
    roots = components(links)
    root = lambda side: roots.select(F.col("id").alias(side), F.col("root").alias(f"_root_{side}"))
    outside = (
        near.where(F.col("d") > radius)
        .join(root("pivot"), "pivot")  # a pivot without a link has no ball
        .join(root("id"), "id", "left")
        .where("_root_id IS NULL OR _root_id != _root_pivot")
        .select("pivot", F.col("id").alias("a"), F.col("d").alias("_x"))
    )
    ball = near.where(F.col("d") <= radius).select("pivot", F.col("id").alias("b"), F.col("d").alias("_y"))
    met = _sketched(outside, sketches, "a").join(_sketched(ball, sketches, "b"), "pivot")
    # sets of too unlike sizes are beyond the bound as well
    met = met.where((F.col("_x") - F.col("_y") <= radius) & (_bound() <= radius))
    return met.select(*_ordered("a", "b")).distinct()


def jaccard_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """``(key, n_shingles, component_id)`` per document, links taken transitively.

    Two documents link when their shingle sets have a Jaccard index of at least
    ``percent`` / 100, in whole numbers. Equal sets are one node from the start.
    Documents without words link with nothing and are their own component, also
    when they repeat. A row without an id takes the component of its equals; alone
    it has none. Rows that repeat an id with another text count as one document
    for linking, the one with its links merged. Other columns are not read; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    for_python(spark)
    texts = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
    digests = materialise(_digests(texts, shingle), "shingle-digests")
    order = _order(spark, digests)
    rows = digests.where("place IS NULL").select("_id", "n", "digest")
    sets = rows.where("n > 0").groupBy("digest").agg(F.min("_id").alias("_first"))
    known = texts.where("_id IS NOT NULL")
    with scratch_scope() as made:
        shared = materialise(_shared(_postings(known, order, shingle, percent)), "shared-tokens")
        release_shuffles(spark)
        # only these texts are ever compared
        candidates, name = _by_id(
            known.join(shared.select(F.col("id").alias("_id")).distinct(), "_id", "left_semi")
        )
        release_shuffles(spark)
        roots = components(_links(shared, candidates, shingle, percent))
        spark.sql(f"DROP TABLE {name}")  # the entry; the files are scratch
    # all but the roots has been used up, and a chain of stages needs the disk
    drop_paths(spark, made[:-1])
    release_shuffles(spark)
    classes = sets.join(roots.withColumnRenamed("id", "_first"), "_first", "left").select(
        "digest", F.coalesce("root", "_first").alias("_component")
    )
    placed = rows.where("n > 0").join(classes, "digest").select("_id", "n", "_component")
    alone = rows.where("n = 0").select("_id", "n", F.col("_id").alias("_component"))
    return placed.unionByName(alone).select(
        F.col("_id").alias(key), F.col("n").alias("n_shingles"), F.col("_component").alias("component_id")
    )
