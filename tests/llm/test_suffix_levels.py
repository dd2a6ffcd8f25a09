"""Passages that repeat, against plain sets of byte strings."""

import hashlib
import random

import pytest

from hitframe.llm import suffix_levels
from hitframe.llm.suffix_levels import remove_repeats

SCHEMA = "doc_id long, text string, id string, mark string, spans string"


def brute(rows, width=50):
    first = {}
    datas = [(i, (t or "").encode()) for i, t in rows]
    for i, data in datas:
        if i is not None:
            for p in range(len(data) - width + 1):
                w = data[p : p + width]
                first[w] = min(i, first.get(w, i))
    out = []
    for i, data in datas:
        gone = bytearray(len(data))
        for p in range(len(data) - width + 1):
            if i is not None and first[data[p : p + width]] < i:
                gone[p : p + width] = b"\1" * width
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, width=50, parts=3):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA).repartition(parts)
    out = remove_repeats(df, width).collect()
    return sorted(
        [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out], key=str
    )


def passages(seed, docs=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeiounst") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randint(5, 60)) for _ in range(6)] + ["=" * 90, "é" * 40, "ab" * 45]
    rows = []
    for i in range(docs):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            cut = rng.choice(shared)
            parts += [cut[rng.randint(0, 5) :], text(rng.randint(0, 12))]
        rows.append((i * 7 % docs, rng.choice(["", " ", "\n"]).join(parts)))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rows = passages(seed)
    assert found(spark, rows) == brute(rows)


def test_small_batches_and_many_levels(spark, monkeypatch):
    monkeypatch.setattr(suffix_levels, "BATCH_ROWS", 16)
    monkeypatch.setattr(suffix_levels, "PIECE", 97)
    rows = passages(9, 30)
    ids, marks, texts = [i for i, _ in rows], [0] * len(rows), [t.encode() for _, t in rows]
    import numpy as np
    import pyarrow as pa

    data, ends = suffix_levels._joined(pa.array(texts, pa.binary()))
    heat = np.zeros(suffix_levels.CLASSES, np.uint8)
    place, text, _, low, high = suffix_levels._segments(data, ends, 50, heat)
    begin = np.concatenate([[0], ends[:-1]])[text]
    lists = [np.array(ids)[text], np.array(marks)[text], place - begin, *[np.empty(0, np.int64)] * 3]
    lines, covered = suffix_levels._lines(data, place, low, high, 50)
    block = suffix_levels._pack(lists, [low.astype(np.uint8), high.astype(np.uint8), lines[covered]])
    out = suffix_levels._shard_spans(50)(pa.table({"block": pa.array([block], pa.binary())}))
    spans = {}
    for i, span in zip(out["id"].to_pylist(), out["span"].to_pylist()):
        spans.setdefault(i, []).append(span)
    for i, _, removed, *_ in brute(rows):
        covered = set()
        for s in spans.get(i, []):
            covered |= set(range(s >> 8, (s >> 8) + (s & 255)))
        assert len(covered) == removed


@pytest.mark.parametrize("width", [32, 79])
def test_other_widths(spark, width):
    rows = passages(5, 30)
    assert found(spark, rows, width) == brute(rows, width)


def test_edges(spark):
    p, q = "the quick brown fox jumps over the lazy dog again and again. ", "0123456789" * 6
    rows = [
        (None, p),
        (None, None),
        (5, None),
        (6, ""),
        (7, p),
        (7, p),
        (7, q + p),
        (7, p + q),
        (8, "x" + p),
        (9, p[:49]),
        (10, p[:50]),
        (11, q + p + q),
        (-3, p + p + p),
        (12, "z" * 3000),
        (13, "z" * 70),
    ]
    assert found(spark, rows) == brute(rows)


def test_long_text_and_empty_table(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(600_000))
    rows = [(2, long), (1, long[1000:1200] + "-" + long[-300:]), (3, long[200_000:500_000])]
    got = {r[0]: r[1:4] for r in found(spark, rows)}
    assert got == {1: (501, 0, 0), 2: (600_000, 500, 2), 3: (300_000, 300_000, 1)}
    assert found(spark, []) == []


def test_many_copies_leave_one_row_per_batch(spark):
    passage = "a passage that a large part of all documents has in common with others"
    rows = [(i, passage) for i in range(500)]
    out = {r.doc_id: r.n_removed for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: len(passage) * (i > 0) for i in range(500)}
