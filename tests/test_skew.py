"""One frame with a third of all hits, under thresholds small enough to matter."""

import pytest
from pyspark.sql import functions as F

from hitframe.operators import edges, frames, hits
from hitframe.sources import materialise

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def tight(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def wire_like(spark, n=60_000):
    frame = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    return spark.range(0, n, 1, 16).select(
        frame.alias("frame_id"),
        (F.xxhash64("id") % 1000 / 10.0).alias("tcal"),
        (F.col("id") % 4).cast("int").alias("ch"),
        (F.col("id") % 16).cast("int").alias("id"),
        (F.xxhash64("id", F.lit(1)) % 100 / 1.0).alias("charge"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_frame_is_split_in_the_time_zero_join(tight):
    h = wire_like(tight)
    t0 = hits.staged_time_zero(hits.earliest_time(h))
    joined = hits.subtract_time_zero(h, t0)
    plan = final_plan(joined)
    assert "SortMergeJoin(skew=true)" in plan, plan[:3000]
    assert joined.count() == 60_000


def test_grouping_after_the_split_still_combines_first(tight):
    h = wire_like(tight)
    t0 = hits.staged_time_zero(hits.earliest_time(h))
    leads = frames.leading_hit(
        hits.subtract_time_zero(h, t0), ["frame_id", "ch"], ["id", "charge", "timing"], ["id", "timing"]
    )
    plan = final_plan(leads)
    assert "skew=true" in plan
    # partial aggregate, exchange of at most one row per group and task, final one
    top = plan[: plan.index("SortMergeJoin")]
    assert top.count("SortAggregate") == 2 and "Exchange hashpartitioning" in top
    want = h.groupBy("frame_id", "ch").count()
    assert leads.count() == want.count()


def test_hot_frame_is_split_in_the_coincidence(tight):
    h = wire_like(tight).withColumn("plane", F.concat(F.lit("p"), F.col("ch")))
    out = frames.coincident_hits(h, ["p0", "p1", "p2", "p3"])
    assert "skew=true" in final_plan(out)
    ok = h.groupBy("frame_id").agg(F.countDistinct("plane").alias("n")).where("n = 4")
    assert out.count() == h.join(ok, "frame_id").count()


def test_hot_channel_is_split_on_both_sides_of_the_pairing(tight):
    n = 6_000
    e = tight.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("frame_id"),
        F.lit(1).alias("ch"),
        (F.col("id") % 2).cast("int").alias("edge"),
        F.col("id").cast("double").alias("timing"),
    )
    summary = edges.pair_summary(e, ["frame_id", "ch"])
    hot = n // 3
    assert int(summary.agg(F.max("n_pairs")).first()[0]) == (hot // 2) ** 2
    top = edges.widest_pairs(e, ["frame_id", "ch"], 3)
    # the product of the hot channel has a million pairs; five candidates remain
    assert top.where("frame_id = -7").count() == 5


def test_hot_channel_is_cut_before_and_after_the_shuffle_behind_the_frame_join(tight):
    """Through the time-zero join, as the strip chain runs it."""
    from hitframe.config import StripConfig
    from hitframe.plans import strip

    e = tight.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id") % 500).alias("frame_id"),
        (F.col("id") % 4).cast("int").alias("ch"),
        (F.xxhash64("id") % 2 == 0).cast("int").alias("edge"),
        (F.xxhash64("id") % 1000 / 10.0).alias("tcal"),
    )
    triggers = hits.staged_time_zero(hits.earliest_time(e))
    cfg = StripConfig()
    timed = strip.timed_edges(e, triggers, cfg)
    assert "SortMergeJoin(skew=true)" in final_plan(timed)
    chmap = tight.range(4).select(F.col("id").cast("int").alias("ch"), F.col("id").cast("int").alias("id"), F.lit("x").alias("side"))
    plan = final_plan(strip.side_slots(timed, chmap, cfg, rows=4))
    assert "Partial" in plan and "WindowGroupLimit" in plan
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "edge" in line]
    assert any("Partial" in x for x in limits) and any("Final" in x for x in limits), limits


def test_slots_of_a_hot_frame_leave_three_rows_per_task(tight):
    h = wire_like(tight).withColumn("tie", F.monotonically_increasing_id())
    out = frames.hit_slots(h, ["frame_id"], frames.by_charge("charge", "id", "tie"), {"id": 3, "charge": 3})
    got = out.where("frame_id = 7").first()
    want = [r.charge for r in h.where("frame_id = 7").orderBy(F.desc("charge")).limit(3).collect()]
    assert [got.charge0, got.charge1, got.charge2] == want
    assert got["size"] == h.where("frame_id = 7").count()


def test_hot_curve_is_split_where_the_curves_are_too_many_to_broadcast(tight):
    from hitframe.operators import curves

    v = tight.range(0, 60_000, 1, 16).select(
        "id",
        F.when(F.col("id") >= 0, "p").otherwise("q").alias("plane"),
        F.when(F.col("id") % 3 == 0, 5.05).otherwise(F.col("id") % 100 / 10.0).alias("v"),
    )
    points = tight.range(101).select(
        F.lit("p").alias("plane"), (F.col("id") / 10.0).alias("x"), (F.col("id") / 100.0).alias("tx")
    )
    out = curves.interval_lookup(v, materialise(points, "points"), ["plane"], "v", 10**9)
    plan = final_plan(out)
    assert "SortMergeJoin(skew=true)" in plan, plan[:3000]
    assert out.count() == 60_000
    assert out.where("lo is null").isEmpty()


def tables_written(spark, run):
    """Result rows, and the labels of the tables written on the way."""
    from hitframe import session

    mark = session.scratch_mark(spark)
    rows = sorted(tuple(r) for r in run().collect())
    paths = session._written[spark.sparkContext.applicationId][mark:]
    return rows, {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in paths}


def some_edges(spark):
    """Frame 7 holds a third of the edges."""
    return spark.range(0, 3_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).alias("frame_id"),
        (F.col("id") % 4).cast("int").alias("ch"),
        (F.xxhash64("id") % 2 == 0).cast("int").alias("edge"),
        (F.xxhash64("id", F.lit(1)) % 1000 / 10.0).alias("timing"),
    )


def strip_results(spark):
    from hitframe.config import Bins, StripConfig
    from hitframe.plans import strip

    e, cfg = some_edges(spark), StripConfig()
    chmap = spark.range(4).select(
        F.col("id").cast("int").alias("ch"),
        (F.col("id") / 2).cast("int").alias("id"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("side"),
    )
    return {
        "lists": lambda: strip.hit_lists(e, chmap, cfg, 4),
        "slots": lambda: strip.side_slots(e, chmap, cfg, 4),
        "pairs": lambda: strip.pair_occupancy(e, chmap, cfg, Bins(0.0, 50.0, 25), 0.1, 4),
    }


@pytest.mark.parametrize("name", ["lists", "slots", "pairs"])
def test_small_frames_are_moved_once_and_large_ones_in_pieces(spark, monkeypatch, name):
    from hitframe.operators import skew

    run = strip_results(spark)[name]
    whole, written = tables_written(spark, run)
    # no ranges are cut and no cells written where every frame is small
    assert written == {"timed-edges", "large-groups"}
    monkeypatch.setattr(skew, "WHOLE_GROUP", 100)
    pieces, written = tables_written(spark, run)
    assert whole == pieces and whole
    if name != "slots":
        assert written & {"ranges", "edge-cells"}


def test_small_frames_need_one_shuffle_for_all_that_goes_by_them(spark):
    plan = final_plan(strip_results(spark)["slots"]())
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moves and all("hashpartitioning(frame_id" in m and "REPARTITION_BY_NUM" in m for m in moves), moves


def test_event_hits_of_small_and_large_frames(spark, monkeypatch):
    from hitframe.operators import skew

    h = wire_like(spark, 6_000).withColumn("plane", F.concat(F.lit("p"), F.col("ch"))).drop("ch")
    h = materialise(h.withColumnRenamed("tcal", "timing"), "hits")
    planes, order = ["p0", "p1", "p2", "p3"], frames.by_charge("charge", "id", "timing")

    def whole():
        few, many = skew.by_size(h, ["frame_id"])
        assert many is None
        return frames.ranked_hits(frames.coincident_hits(few, planes, whole=True), ["frame_id", "plane"], order, True)

    got, written = tables_written(spark, whole)
    assert written == {"large-groups"}
    monkeypatch.setattr(skew, "WHOLE_GROUP", 50)
    want, written = tables_written(
        spark, lambda: frames.ranked_hits(frames.coincident_hits(h, planes), ["frame_id", "plane"], order)
    )
    assert got == want and got and "ranges" in written


def test_groups_by_size_keep_every_row_and_grow_in_tasks(spark, monkeypatch):
    from hitframe.operators import skew

    rows = [(None, i) for i in range(30)] + [(1, i) for i in range(3)] + [(2, i) for i in range(25)] + [(None, 5)]
    table = materialise(spark.createDataFrame(rows, "k int, v int"), "rows")
    monkeypatch.setattr(skew, "WHOLE_GROUP", 20)
    monkeypatch.setattr(skew, "TASK_ROWS", 2)
    few, many = skew.by_size(table, ["k"])
    assert sorted(r.k for r in few.collect()) == [1] * 3
    assert many.count() == 56 and many.where("k IS NULL").count() == 31
    assert few.rdd.getNumPartitions() == 30
