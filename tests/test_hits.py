from pyspark.sql import functions as F

from hitframe import schemas
from hitframe.config import ANODE_MODULE, WIRE_MODULE, Box, WireConfig
from hitframe.operators import hits, skew


def block(tf, fem_type, fem, frame, data):
    return (tf, fem_type, fem, ((frame,), data))


def blocks(spark, rows):
    return spark.createDataFrame(rows, schemas.BLOCKS)


def test_routing_and_explode(spark):
    df = blocks(
        spark,
        [
            block(1, 5, 616, 7, [(3, 100, 50), (4, 101, 51)]),
            block(2, 5, 617, 7, []),
            block(3, 5, 614, 7, [(4, 90, 9), (5, 80, 9)]),
            block(4, 7, 616, 7, [(1, 1, 1)]),
            block(5, 5, 618, 8, None),
        ],
    )
    flat = hits.explode_hits(df.where(hits.of_module(WIRE_MODULE)), "femId")
    assert sorted(map(tuple, flat.collect())) == [(616, 7, 3, 100, 50), (616, 7, 4, 101, 51)]
    anode = hits.anode_hits(df, WireConfig(tick_ns=1.0), "mid")
    assert [tuple(r) for r in anode.collect()] == [(7, 90.5, 90)]
    assert hits.of_module(ANODE_MODULE) is not None


def test_earliest_hit(spark):
    df = spark.createDataFrame([(1, 5.0, 50), (1, 4.0, 40), (2, 9.0, 90)], "frame_id long, tcal double, raw long")
    assert sorted(map(tuple, hits.earliest_time(df).collect())) == [(1, 4.0), (2, 9.0)]
    rows = hits.earliest_row(df, "tcal", ["raw"]).collect()
    assert sorted(map(tuple, rows)) == [(1, 4.0, 40), (2, 9.0, 90)]
    # the ranked window of the same order picks the same rows
    df.createOrReplaceTempView("trig")
    want = spark.sql(
        "select frame_id, tcal, raw from (select *, row_number() over "
        "(partition by frame_id order by tcal, raw) r from trig) where r = 1"
    )
    got = hits.earliest_row(df, "tcal", ["raw"])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_frames_without_trigger_are_dropped(spark):
    h = spark.createDataFrame([(1, 10.0), (3, 10.0)], "frame_id long, tcal double")
    t0 = spark.createDataFrame([(1, 4.0), (2, 1.0)], "frame_id long, t0 double")
    assert [tuple(r) for r in hits.subtract_time_zero(h, t0).collect()] == [(1, 6.0)]


def test_channel_map(spark):
    cfg = WireConfig()
    chmap = spark.createDataFrame(
        [(0, 616, 1, "dc31"), (17, 616, 2, "dc31"), (127, 617, 9, "dc31"), (63, 618, 3, "dc32"), (64, 618, 4, "dc32")],
        "id int, femId int, ch int, detector string",
    )
    named = hits.wire_channel_map(chmap, cfg)
    got = {(r.femId, r.ch): (r.plane, r.id) for r in named.collect()}
    assert got == {
        (616, 1): ("dc31_x1", 0),
        (616, 2): ("dc31_x2", 1),
        (617, 9): ("dc31_y4", 15),
        (618, 3): ("dc32_y2", 15),
    }
    h = spark.createDataFrame([(616, 2, 1.0), (616, 99, 2.0)], "femId int, ch int, q double")
    out = hits.map_channels(h, named, ["femId", "ch"]).collect()
    assert [(r.plane, r.id, r.q) for r in out] == [("dc31_x2", 1, 1.0)]


def test_linear_calibration_keeps_unknown_ids(spark):
    h = spark.createDataFrame([(0, 2.0), (1, 3.0)], "id int, charge double")
    c = spark.createDataFrame([(0, 2.0, 1.0)], "id int, p1 double, p0 double")
    got = sorted(map(tuple, hits.linear_calibration(h, c, ["id"]).collect()))
    assert got == [(0, 5.0), (1, None)]


def test_wire_cut_per_detector(spark):
    cfg = WireConfig(cuts={"dc31": Box((10, 150), (-60, 0)), "dc32": Box((10, 150), (-5, 0))})
    rows = [("dc31", 20.0, -10.0), ("dc32", 20.0, -10.0), ("dc32", 20.0, -1.0), ("dc31", 10.0, -1.0)]
    df = spark.createDataFrame(rows, "detector string, charge double, timing double")
    assert df.where(hits.wire_cut(cfg)).count() == 2


def test_broadcast_only_when_bounded(spark, monkeypatch):
    small = spark.range(50)
    big = spark.range(1000).withColumn("v", F.col("id"))
    monkeypatch.setattr(skew, "MAX_BROADCAST_ROWS", 40)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan(big.join(skew.bounded_broadcast(small), "id"))
        assert "BroadcastHashJoin" in plan(big.join(skew.bounded_broadcast(small, 40), "id"))
        assert "SortMergeJoin" in plan(big.join(skew.bounded_broadcast(small, 41), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
