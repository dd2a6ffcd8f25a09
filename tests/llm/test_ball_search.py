"""Ranked search and clustering against plain loops, and against their SQL."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from hitframe.llm import ball_search, centroids

DOCS = "doc_id long, text string, item_id string, score string, query string"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def brute(docs, items, k):
    sets = [(i, Counter(terms(t))) for i, t in docs]
    sets = [(i, c, sum(c.values())) for i, c in sets if c]
    n, total = len(sets), sum(s[2] for s in sets)
    df = Counter(t for _, c, _ in sets for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c, size in sets:
            m = 75 + (25 * size * n) // total
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score and i is not None:
                scores.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def ranked(spark, docs, items, k=20, parts=3):
    d = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in docs], DOCS).repartition(parts)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    out = ball_search.rank_documents(d, b, k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted([tuple(r) for r in out.collect()], key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["w%d" % int(rng.paretovariate(0.7)) for _ in range(400)] + ["Äpfel", "ÉTÉ", "don't", "A-b_c", "日本"]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 3, 20, 200]))) for _ in range(n // 2)]
    texts += [rng.choice(texts) + rng.choice(["", " extra", "!"]) for _ in range(n - len(texts))]
    return [(i, t) for i, t in enumerate(texts)], [(i, " ".join(rng.choices(words, k=12))) for i in range(15)]


@pytest.mark.parametrize("seed", [1, 2])
def test_ranking_equals_brute_force(spark, seed):
    docs, items = corpus(seed, 700)
    assert ranked(spark, docs, items) == brute(docs, items, 20)


def test_ranking_edges(spark):
    docs = [(1, None), (2, ""), (3, "..."), (None, "a b"), (4, "A b"), (4, "a B"), (5, "a " * 5000), (6, "c"), (7, "b a")]
    items = [(1, "a"), (1, "a"), (2, None), (3, "a a A b"), (None, "C"), (4, "unknown"), (5, "")]
    assert ranked(spark, docs, items, 3) == brute(docs, items, 3)
    assert ranked(spark, [], items) == []
    assert ranked(spark, [(1, None)], items) == []
    assert ranked(spark, docs, []) == []


def test_queries_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ball_search, "QUERIES", 4)
    docs, items = corpus(5, 200)
    assert ranked(spark, docs, items, 5) == brute(docs, items, 5)


def test_equal_scores_go_by_id(spark):
    docs = [(i, "rare needle") for i in range(30)] + [(100 + i, f"other{i % 7} needle") for i in range(1900)]
    index = ball_search.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    row = index.first().asDict()
    import numpy as np

    best = [[]]
    known = {b"rare": 0}
    weights = ball_search._weights(np.array([30]), len(docs))
    ball_search._search_tree(
        {"terms": bytes(row["terms"]), "tree": bytes(row["tree"])}, known, weights,
        np.array([[1]]), np.array([1.0]), len(docs), 2 * len(docs), best, 20,
    )
    assert sorted(-d for _, d in best[0]) == list(range(20))


def test_tree_holds_every_document_once():
    import numpy as np

    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 9, 1000)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    found = np.concatenate([np.sort(rng.choice(50, s, replace=False)) for s in sizes])
    order, nodes = ball_search._tree(starts, found, np.ones(len(found)), 50)
    assert sorted(order) == list(range(1000))
    leaves = sorted((a, b) for a, b, child in nodes.tolist() if not child)
    assert [a for a, _ in leaves] == [0, *[b for _, b in leaves][:-1]] and leaves[-1][1] == 1000
    assert max(b - a for a, b in leaves) <= ball_search.LEAF


# --- clustering -------------------------------------------------------------


def clusters(rows, k, rounds, dims, scale=64):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [(hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centres = [list(v) for _, v in sorted(named)[:k]]
    if not centres:
        return []
    apart = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((apart(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, g in groups.items():
            centres[j] = [sum(x) // len(g) for x in zip(*g)]
    placed = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in placed:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    total = sum(inertia.values())
    return sorted([(i, j, d, inertia[j], total, sha[j]) for i, d, j in placed], key=str)


def clustered(spark, rows, k=4, rounds=3, dims=6):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, id int")
    out = centroids.cluster_vectors(df.repartition(3), k, rounds, dims)
    return sorted([tuple(r) for r in out.collect()], key=str)


def as_float32(v):
    import numpy as np

    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


@pytest.mark.parametrize("dims", [6, 5, 1])
def test_clusters_equal_brute_force(spark, dims):
    rng = random.Random(dims)
    rows = [(i, as_float32([rng.gauss(i % 5, 0.3) for _ in range(dims)])) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(50)]
    assert clustered(spark, rows, 4, 3, dims) == clusters(rows, 4, 3, dims)


def test_cluster_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.5]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [-inf, 0.0]), (None, [3.0, 3.0]), (9, [0.5, -0.5]), (10, [1.0, 2.0, 3.0]), (11, [-4.0, 1.25]), (11, [2.0, 2.0]),
    ]
    rows = [(i, as_float32(v)) for i, v in rows]
    for k in (1, 2, 4, 20):
        assert clustered(spark, rows, k, 2, 2) == clusters(rows, k, 2, 2)
    assert clustered(spark, [], 3, 2, 2) == []
    assert clustered(spark, [(None, [1.0, 1.0])], 3, 2, 2) == []


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        clustered(spark, [(1, [3.0e38, 0.0])], 1, 1, 2)


def test_chunks_give_the_vectors_back(spark, monkeypatch):
    monkeypatch.setattr(centroids, "CHUNK", 16)
    rng = random.Random(0)
    rows = [(i, [rng.randint(-3, 3) for _ in range(5)]) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, v array<int>").coalesce(1)
    import numpy as np

    batch = centroids.encode_chunks(df, 5).toArrow()
    out = []
    for ids, _, codes, entries, _, _ in centroids._assigned(batch, np.zeros((1, 5), np.int64), 5):
        v = np.concatenate([e[c] for e, c in zip(entries, codes)], axis=1)
        out += list(zip(ids.tolist(), v.tolist()))
    assert sorted(out) == rows
