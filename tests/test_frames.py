import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hitframe.operators import frames

KEYS = ["frame_id", "side"]
ORDER = ("charge", "id", "tie")


@pytest.fixture(scope="module")
def some_hits(spark):
    rnd = random.Random(5)
    rows = [
        (rnd.randrange(40), rnd.choice("xy"), rnd.randrange(6), float(rnd.randrange(5)), n)
        for n in range(900)
    ]
    # one frame holds a third of all rows, with many equal charges
    rows += [(999, "x", rnd.randrange(6), float(rnd.randrange(3)), 1000 + n) for n in range(450)]
    schema = "frame_id long, side string, id int, charge double, tie long"
    return rows, spark.createDataFrame(rows, schema).repartition(7).cache()


def lists(rows):
    groups = defaultdict(list)
    for f, s, i, q, t in rows:
        groups[f, s].append((-q, i, t))
    return {k: sorted(v) for k, v in groups.items()}


def test_slots_match_sorted_lists(some_hits):
    rows, df = some_hits
    out = frames.hit_slots(df, KEYS, frames.by_charge(*ORDER), {"id": 3, "charge": 3, "tie": 1})
    want = lists(rows)
    got = out.collect()
    assert len(got) == len(want)
    for r in got:
        best = want[r.frame_id, r.side]
        assert r["size"] == len(best)
        for i in range(3):
            q, wire = (-best[i][0], best[i][1]) if i < len(best) else (None, None)
            assert (r[f"charge{i}"], r[f"id{i}"]) == (q, wire)
        assert r.tie0 == best[0][2]


def test_slots_limit_rows_before_the_shuffle(some_hits):
    _, df = some_hits
    out = frames.hit_slots(df, KEYS, frames.by_charge(*ORDER), {"id": 3})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2
    assert "Join" not in plan


def test_leading_hit_is_first_slot(some_hits):
    rows, df = some_hits
    got = {
        (r.frame_id, r.side): (r["size"], r.id0, r.charge0, r.tie0)
        for r in frames.leading_hit(df, KEYS, ["id", "charge", "tie"], ["id", "tie"]).collect()
    }
    assert got == {k: (len(v), v[0][1], -v[0][0], v[0][2]) for k, v in lists(rows).items()}


@pytest.mark.parametrize("ranges", [1, 8, 40])
def test_ranks_of_a_group_in_one_or_many_ranges(spark, some_hits, ranges):
    """With 40 ranges the heavy frame, a third of all rows, lies in about thirteen."""
    rows, df = some_hits
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        out = frames.ranked_hits(df, KEYS, frames.by_charge(*ORDER)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    got = {(r.frame_id, r.side, r["rank"]): (-r.charge, r.id, r.tie) for r in out}
    want = {(*k, i + 1): h for k, v in lists(rows).items() for i, h in enumerate(v)}
    assert got == want


def test_rank_does_not_depend_on_partitioning(some_hits):
    _, df = some_hits
    a = frames.ranked_hits(df, KEYS, frames.by_charge(*ORDER))
    b = frames.ranked_hits(df.repartition(3, "tie"), KEYS, frames.by_charge(*ORDER))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_single_pass_equals_joins(some_hits):
    _, df = some_hits
    leads = frames.leading_hit(df, KEYS, ["id"], ["id", "tie"])
    both = frames.one_row_per_frame(leads, "side", ("x", "y"), ["id0"], "{value}_{member}")
    x = leads.where("side = 'x'").select("frame_id", F.col("id0").alias("id0_x"))
    y = leads.where("side = 'y'").select("frame_id", F.col("id0").alias("id0_y"))
    want = x.join(y, "frame_id", "outer")
    assert both.exceptAll(want).isEmpty() and want.exceptAll(both).isEmpty()
    inner = frames.one_row_per_frame(
        leads, "side", ("x", "y"), ["id0"], "{value}_{member}", require_all=True
    )
    want = x.join(y, "frame_id")
    assert inner.exceptAll(want).isEmpty() and want.exceptAll(inner).isEmpty()


def test_coincident_hits(spark):
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, "a"), (3, "b"), (3, "c")]
    df = spark.createDataFrame(rows, "frame_id long, plane string")
    got = sorted(map(tuple, frames.coincident_hits(df, ["a", "b"]).collect()))
    assert got == [(1, "a"), (1, "b"), (1, "b")]


def test_cuts_drop_undecided_rows(spark):
    cols = "size_x int, size_y int, id0_x int, id1_x int, id2_x int, charge2_x double, id0_y int, id1_y int, id2_y int, charge2_y double"
    rows = [
        (2, 6, 4, 5, None, None, 9, 8, None, None),
        (1, 6, 4, None, None, None, 9, 8, None, None),
        (3, 7, 4, 5, 3, 1.0, 9, 8, 10, 2.0),
        (3, None, 4, 5, 3, 1.0, None, None, None, None),
        (3, 3, 4, 5, 3, 0.0, 9, 8, 10, 2.0),
    ]
    df = spark.createDataFrame(rows, cols)
    assert df.where(frames.multiplicity_cut(7)).count() == 2
    assert df.where(frames.neighbour_cut()).count() == 3
    assert df.where(frames.cluster_cut()).count() == 1


def test_edge_wire_veto(spark):
    df = spark.createDataFrame([(0,), (1,), (14,), (15,)], "id0 int")
    assert [r[0] for r in df.where(frames.edge_wire_veto(15)).collect()] == [1, 14]


def test_multiplicity_with_and_without_a_lower_bound(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (7, 2), (0, 6)], "size_x int, size_y int")
    assert df.where(frames.multiplicity_cut(7)).count() == 1
    assert df.where(frames.multiplicity_cut(7, above=None)).count() == 3
