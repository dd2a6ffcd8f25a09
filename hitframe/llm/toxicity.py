"""Toxicity scores from the nearest labelled examples, by exact TF-IDF cosine."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitframe.sources.stages import materialise

from .common import for_python

# labelled rows of each class that examples and term weights are fitted on
PER_CLASS = 4000
# terms that tell the classes apart, at most
TERMS = 512
NEIGHBOURS = 15
# examples per block of the inverted index
BLOCK = 64
CACHED = 1 << 18
# All other words are one more term, so that a lone hit in a long text weighs less
# than in a short one. Its weight is REST times the root of their number, as the
# length of a vector of that many equal terms would be.
REST_TERM, REST = -1, 0.5

_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES = range(4, 9)


def word_terms(word: str) -> list[str]:
    """The word and its proper beginnings, so that inflected and compound forms meet."""
    return [word + "$", *[word[:n] for n in _PREFIXES if n < len(word)]]


def is_held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def _example_ids(labels: DataFrame, key: str, per_class: int) -> DataFrame:
    """Up to ``per_class`` labelled ids of each class outside the held-out fold."""
    rows = (
        labels.where(F.col(key).isNotNull() & F.col("toxic").isin(0, 1) & ~is_held_out(key))
        .groupBy(key)
        .agg(F.max("toxic").cast("int").alias("_toxic"))
    )
    picked = [
        rows.where(F.col("_toxic") == c).orderBy(F.xxhash64(key), key).limit(per_class) for c in (0, 1)
    ]
    return picked[0].unionByName(picked[1]).withColumnRenamed(key, "_id")


def _terms_of(texts: DataFrame) -> DataFrame:
    """``(toxic, term)`` once per example and term."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {*_WORD.findall((text or "").lower())}
                terms = [*{t for w in words for t in word_terms(w)}]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([toxic] * len(terms), pa.int32()), pa.array(terms, pa.string())],
                    names=["_toxic", "_term"],
                )

    return texts.select("_toxic", "_text").mapInArrow(run, "_toxic int, _term string")


def choose_terms(examples: DataFrame, sizes: dict[int, int], limit: int = TERMS) -> list[str]:
    """The terms that lean most towards toxic examples, by their log-likelihood ratio.

    Of a word's beginnings that occur in the same examples only the longest stays.
    """
    toxic, clean = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    counts = _terms_of(examples).groupBy("_term").agg(
        F.sum("_toxic").alias("_a"), F.sum(1 - F.col("_toxic")).alias("_b")
    )
    rate = (F.col("_a") + F.col("_b")) / (toxic + clean)

    def part(seen: Column, of: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (rate * of))).otherwise(0.0)

    a, b = F.col("_a"), F.col("_b")
    ratio = 2 * (part(a, toxic) + part(b, clean))
    leaning = counts.where((a >= 5) & (a / toxic > 8 * (b / clean)))
    rows = leaning.withColumn("_ratio", ratio).orderBy(F.desc("_ratio"), "_term").limit(4 * limit).collect()
    seen = {r["_term"]: (r["_a"], r["_b"]) for r in rows}
    kept = [
        t
        for t in seen
        if not any(o != t and o.rstrip("$").startswith(t) and seen[o] == seen[t] for o in seen)
    ]
    return kept[:limit]


@lru_cache(maxsize=4)
def _lookup(terms: tuple[str, ...]) -> tuple[dict[str, int], dict[str, tuple[int, ...]]]:
    return {t: i for i, t in enumerate(terms)}, {}


def count_terms(text: str | None, terms: tuple[str, ...]) -> dict[int, int]:
    """How often each chosen term occurs in the whole text, and the number of its words."""
    place, known = _lookup(terms)
    words = Counter(_WORD.findall((text or "").lower()))
    found = Counter({REST_TERM: words.total()})
    for word, n in words.items():
        ids = known.get(word)
        if ids is None:
            if len(known) >= CACHED:
                known.clear()
            ids = known[word] = tuple(place[t] for t in word_terms(word) if t in place)
        for i in ids:
            found[i] += n
    return found


def _count_all(docs: DataFrame, key: str, text: str, terms: tuple[str, ...]) -> DataFrame:
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("_terms", T.ArrayType(T.IntegerType())),
            T.StructField("_counts", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [sorted(count_terms(t, terms).items()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([[i for i, _ in f] for f in found], pa.list_(pa.int32())),
                    pa.array([[n for _, n in f] for f in found], pa.list_(pa.int32())),
                ],
                names=schema.names,
            )

    return docs.select(key, text).mapInArrow(run, schema)


@dataclass
class BlockMaxIndex:
    """Inverted index over unit vectors, with the largest weight of each term and block.

    A block is a range of examples. For a query the bound of a block is the sum of
    its terms' largest weights there; blocks are scored in full from the highest
    bound on, until no bound exceeds the k-th similarity found.
    """

    ids: list[int]
    labels: list[int]
    vectors: list[dict[int, float]]
    idf: dict[int, float]
    block: int = BLOCK
    most: dict = field(init=False)
    postings: dict = field(init=False)

    def __post_init__(self):
        import numpy as np

        self.most, self.postings = {}, {}
        blocks = -(-len(self.ids) // self.block)
        for at, vector in enumerate(self.vectors):
            b, place = divmod(at, self.block)
            for term, weight in vector.items():
                if term not in self.most:
                    self.most[term] = np.zeros(blocks)
                self.most[term][b] = max(self.most[term][b], weight)
                places, weights = self.postings.setdefault((term, b), ([], []))
                places.append(place)
                weights.append(weight)
        self.postings = {k: (np.array(p), np.array(w)) for k, (p, w) in self.postings.items()}

    def nearest(self, vector: dict[int, float], k: int) -> list[tuple[float, int]]:
        """``(similarity, example)`` of the k most similar ones, zeros left out."""
        import numpy as np

        shared = [t for t in vector if t in self.most]
        if not shared:
            return []
        bounds = sum(vector[t] * self.most[t] for t in shared)
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or len(best) == k and bounds[b] <= -best[-1][0]:
                break
            scores = np.zeros(self.block)
            for t in shared:
                if (found := self.postings.get((t, b))) is not None:
                    scores[found[0]] += vector[t] * found[1]
            # negative similarity first: sorting puts ties in the order of examples
            best += [(-scores[i], int(b) * self.block + int(i)) for i in np.flatnonzero(scores)]
            best = sorted(best)[:k]
        return [(min(1.0, -s), i) for s, i in best]


def unit_vector(counts: dict[int, int], idf: dict[int, float]) -> dict[int, float]:
    weights = {
        t: REST * math.sqrt(1 + n) if t == REST_TERM else (1 + math.log(n)) * idf[t]
        for t, n in counts.items()
    }
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return {t: w / norm for t, w in weights.items()}


def isotonic(x: list[float], y: list[float], w: list[float]) -> list[tuple[float, float]]:
    """Steps of the non-decreasing fit to (x, y): pool neighbours that are out of order."""
    pools: list[list[float]] = []  # largest x, weighted sum of y, weight
    for xi, yi, wi in sorted(zip(x, y, w)):
        if pools and pools[-1][0] == xi:
            pools[-1][1] += yi * wi
            pools[-1][2] += wi
        else:
            pools.append([xi, yi * wi, wi])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [last[0], pools[-1][1] + last[1], pools[-1][2] + last[2]]
    return [(p[0], p[1] / p[2]) for p in pools]


@dataclass
class ToxicityModel:
    """Terms, examples and calibration; a bounded object that goes to every task."""

    terms: tuple[str, ...]
    index: BlockMaxIndex
    steps: list[tuple[float, float]]
    neighbours: int

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of toxic votes, each weighted by similarity, drawn to 0 by one clean vote."""
        toxic = sum(s for s, i in near if self.index.labels[i])
        return toxic / (1 + sum(s for s, _ in near))

    def score(self, counts: dict[int, int]) -> tuple[float, list[tuple[float, int]]]:
        near = self.index.nearest(unit_vector(counts, self.index.idf), self.neighbours)
        return self.calibrated(self.vote(near)), near

    def calibrated(self, vote: float) -> float:
        import numpy as np

        if not self.steps:
            return vote
        return float(np.interp(vote, *zip(*self.steps)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    per_class: int = PER_CLASS,
    neighbours: int = NEIGHBOURS,
) -> tuple[ToxicityModel, DataFrame]:
    """The model, and the term counts of all documents that it was weighted with.

    Terms, examples and the calibration come from at most ``per_class`` labelled rows
    of each class outside the held-out fold. The inverse document frequencies count
    every document.
    """
    for_python(docs.sparkSession)
    ids = materialise(_example_ids(labels, key, per_class), "example-ids")
    texts = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    # at most 2 * per_class rows; an id that repeats keeps its first text in order
    examples = materialise(
        texts.join(F.broadcast(ids), "_id").groupBy("_id", "_toxic").agg(F.min("_text").alias("_text")),
        "examples",
    )
    sizes = {r["_toxic"]: r["n"] for r in examples.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    terms = tuple(choose_terms(examples, sizes)) if len(sizes) == 2 else ()
    counted = materialise(_count_all(docs, key, text, terms), "term-counts")
    total = counted.count()
    idf = {i: 1.0 for i in range(len(terms))}
    chosen = F.filter("_terms", lambda t: t != REST_TERM)
    for r in counted.select(F.explode(chosen).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():
        idf[r["t"]] = math.log((1 + total) / r["n"])
    rows = _count_all(examples, "_id", "_text", terms).join(F.broadcast(ids), "_id").orderBy("_id").collect()
    vectors = [unit_vector(dict(zip(r["_terms"], r["_counts"])), idf) for r in rows]
    # examples of like content side by side, so that a block has few terms
    order = sorted(range(len(rows)), key=lambda i: (sorted(vectors[i]), rows[i]["_id"]))
    index = BlockMaxIndex(
        [rows[i]["_id"] for i in order],
        [rows[i]["_toxic"] for i in order],
        [vectors[i] for i in order],
        idf,
    )
    model = ToxicityModel(terms, index, [], neighbours)
    known = {
        r["_toxic"]: r["n"]
        for r in labels.where(F.col("toxic").isin(0, 1) & ~is_held_out(key))
        .groupBy(F.col("toxic").cast("int").alias("_toxic"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    votes, weights = [], []
    for at, vector in enumerate(index.vectors):
        near = [(s, i) for s, i in index.nearest(vector, neighbours + 1) if i != at][:neighbours]
        votes.append(model.vote(near))
        weights.append(known[index.labels[at]] / sizes[index.labels[at]])
    model.steps = isotonic(votes, index.labels, weights)
    return model, counted


def score(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    per_class: int = PER_CLASS,
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """``(key, held_out, score, predicted, evidence)`` for every row of ``docs``.

    The text is all that a score reads. Texts without any chosen term, null and empty
    ones among them, share the examples without one and so one calibrated score. Without labelled rows of both classes every score is 0. A null id is
    scored like any other and is not held out. Evidence lists the nearest examples
    with their labels and similarities. Repeated rows are scored as often as they
    come; other columns are not read.
    """
    model, counted = fit(docs, labels, key, text, per_class, neighbours)
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("score", T.DoubleType()),
            T.StructField("evidence", T.ArrayType(T.StructType(
                [
                    T.StructField("example", T.LongType()),
                    T.StructField("toxic", T.IntegerType()),
                    T.StructField("similarity", T.DoubleType()),
                ]
            ))),
        ]
    )

    def run(batches):
        import pyarrow as pa

        done: dict[tuple, tuple[float, list]] = {}
        for batch in batches:
            scores, evidence = [], []
            for terms, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = (*zip(terms, counts),)
                if found not in done:
                    if len(done) >= CACHED:
                        done.clear()
                    value, near = model.score(dict(found))
                    done[found] = value, [
                        {"example": model.index.ids[i], "toxic": model.index.labels[i], "similarity": s}
                        for s, i in near[:3]
                    ]
                value, near = done[found]
                scores.append(value)
                evidence.append(near)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, _evidence_type())],
                names=schema.names,
            )

    scored = counted.mapInArrow(run, schema)
    return scored.select(
        key,
        F.coalesce(is_held_out(key), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def _evidence_type():
    import pyarrow as pa

    return pa.list_(pa.struct([("example", pa.int64()), ("toxic", pa.int32()), ("similarity", pa.float64())]))
