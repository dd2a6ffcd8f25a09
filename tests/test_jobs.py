"""The stages end to end through tables, one run at a time and many at once."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from hitframe import schemas, session, sources
from hitframe.config import RPA_STRIPS, WireConfig
from hitframe.plans import jobs

MANY = ("runname", "frame_id")


@pytest.fixture(scope="module")
def wire_map(spark):
    rows = [(c, 616 + c // 64, c % 64, "dc31") for c in range(128)]
    rows += [(c, 618, c, "dc32") for c in range(64)]
    return spark.createDataFrame(rows, "id int, femId int, ch int, detector string")


@pytest.fixture(scope="module")
def strip_map(spark):
    rows = [(c, c + 32, "x") for c in range(32)] + [(c, c, "y") for c in range(32)]
    return spark.createDataFrame(rows, "id int, ch int, side string")


@pytest.fixture(scope="module")
def block_table(spark, tmp_path_factory):
    """Two runs with the same frame numbers, as one table partitioned by run."""
    path = str(tmp_path_factory.mktemp("blocks") / "raw")
    for run, seed in (("run1", 1), ("run2", 2)):
        rnd, rows = random.Random(seed), []
        for frame in range(60):
            t0 = 1_000_000 + rnd.randrange(1000)
            rows.append((1, 5, 614, ((frame,), [(4, t0, 9)])))
            for fem in (616, 617, 618):
                data = [
                    (c, t0 - rnd.randrange(100, 55000), rnd.randrange(25000, 130000))
                    for c in rnd.sample(range(64), 40)
                ]
                rows.append((1, 5, fem, ((frame,), data)))
            edges = []
            for side in (0, 32):
                first = rnd.randrange(28)
                for k in range(3):
                    lead = t0 - rnd.randrange(33_000, 47_000)
                    width = 3000 - 900 * k + rnd.randrange(600)
                    edges += [(side + first + k, lead, 0), (side + first + k, lead + width, 1)]
            rows.append((1, 7, 615, ((frame,), edges)))
        df = spark.createDataFrame(rows, schemas.BLOCKS)
        sources.write_stage(df, path, run)
    return path


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_wire_jobs(spark, block_table, wire_map, tmp_path):
    many, one = replace(WireConfig(), frame=MANY), WireConfig()
    blocks = sources.read_blocks(spark, block_table)
    leads, curves, pos = (str(tmp_path / n) for n in ("leads", "curves", "pos"))

    mark = session.scratch_mark(spark)
    jobs.wire_leads(blocks, wire_map, many, leads)
    assert session.scratch_mark(spark) == mark
    found = sources.read_stage(spark, leads)
    assert found.groupBy("runname", "frame_id").count().where("count != 12").isEmpty()
    assert found.select("runname").distinct().count() == 2

    jobs.calibrate_drift(found, many, curves)
    table = sources.read_curves(spark, curves)
    assert table.select("run", "plane").distinct().count() == 24

    by_run = table.withColumnRenamed("run", "runname")
    jobs.wire_positions(blocks, wire_map, by_run, many, pos, curve_keys=("runname", "plane"))
    both = sources.read_stage(spark, pos)
    assert not both.isEmpty()

    # the first run on its own gives its part of the table, up to the dither
    alone = str(tmp_path / "alone")
    run1 = blocks.where("runname = 'run1'").drop("runname")
    jobs.wire_positions(run1, wire_map, table.where("run = 'run1'"), one, alone, "run1")
    keys = ["frame_id", "sra_tdc_raw", "dc31_x1_id0", "dc32_y2_id0"]
    assert same(
        sources.read_stage(spark, alone, "run1").select(*keys),
        both.where("runname = 'run1'").select(*keys),
    )

    points = str(tmp_path / "points")
    jobs.wire_positions(run1, wire_map, table.where("run = 'run1'"), one, points, "run1", True)
    assert "x_z400" in sources.read_stage(spark, points).columns

    lists = str(tmp_path / "lists")
    jobs.wire_hit_lists(blocks, wire_map, many, lists)
    first = sources.read_stage(spark, lists).where("rank = 1")
    assert first.count() == found.count()


def test_strip_jobs_and_join(spark, block_table, strip_map, wire_map, tmp_path):
    cfg = replace(RPA_STRIPS, frame=MANY)
    blocks = sources.read_blocks(spark, block_table)
    events, curves, pos = (str(tmp_path / n) for n in ("events", "curves", "pos"))
    report = jobs.strip_events(blocks, strip_map, cfg, events).collect()
    assert {r.runname for r in report} == {"run1", "run2"} and sum(r.n_triggers for r in report) == 120
    assert all(0 <= r.efficiency <= 100 for r in report)

    table = sources.read_stage(spark, events)
    assert table.groupBy(*MANY).count().where("count > 1").isEmpty()
    jobs.calibrate_asymmetry(table, cfg, curves)
    by_run = sources.read_curves(spark, curves).withColumnRenamed("run", "runname")
    jobs.strip_positions(table, by_run, cfg, pos, curve_keys=("runname", "side"))
    strips = sources.read_stage(spark, pos)
    assert not strips.where("sr_pos_x is not null").isEmpty()

    wires = spark.createDataFrame(
        [(r, f, 0.5, 1.0, 1.5, 2.0) for r in ("run1", "run2") for f in range(30)],
        "runname string, frame_id long, dc31_x double, dc31_y double, dc32_x double, dc32_y double",
    )
    out = str(tmp_path / "joined")
    jobs.join(strips, wires, replace(WireConfig(), frame=MANY), out)
    joined = sources.read_stage(spark, out)
    assert joined.count() == strips.where(F.col("frame_id") < 30).count()
    assert joined.columns[:3] == ["frame_id", "sr_pos_x", "sr_pos_y"]
    # another run leaves the first two in place
    jobs.join(strips.where("runname = 'run1'").drop("runname"), wires.where("runname = 'run1'").drop("runname"), WireConfig(), out, "0039")
    assert {r.runname for r in sources.read_stage(spark, out).select("runname").distinct().collect()} == {"run1", "run2", "0039"}


def test_efficiency_counts_the_runs_of_the_call(spark, block_table, strip_map, tmp_path):
    """Several calls write into one folder; a label that looks like a number stays text."""
    cfg = replace(RPA_STRIPS, frame=("frame_id",))
    one = sources.read_blocks(spark, block_table).where("runname = 'run1'").drop("runname")
    events = str(tmp_path / "events")
    first = [tuple(r) for r in jobs.strip_events(one, strip_map, cfg, events, "0039").collect()]
    second = [tuple(r) for r in jobs.strip_events(one, strip_map, cfg, events, "0040").collect()]
    again = [tuple(r) for r in jobs.strip_events(one, strip_map, cfg, events, "0039").collect()]
    assert [r[0] for r in first + second] == ["0039", "0040"]
    assert first[0][1:] == second[0][1:] == again[0][1:]
    stage = sources.read_stage(spark, events, "0039")
    assert not stage.isEmpty() and dict(stage.dtypes)["runname"] == "string"


def test_query_and_job_calibrate_on_the_same_leads(spark, tmp_path):
    from hitframe.plans import calibration, wire
    from hitframe.workloads import views as V

    sf = "/root/testdata/sf0.01"
    leads = wire.complete_leads(V.chain_mapped(spark, sf), V.CHAIN)
    assert leads.groupBy("frame_id").count().where(f"count != {len(V.CHAIN.planes)}").isEmpty()
    out = str(tmp_path / "leads")
    sources.write_stage(leads, out, "1")
    curves = lambda df: calibration.drift_curves(
        df, V.CHAIN, ["plane"], V.CHAIN_BOX, V.CHAIN_TIME_BINS, V.CHAIN_CHARGE_BINS
    )
    a, b = curves(V.chain_leads(spark, sf)), curves(sources.read_stage(spark, out))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_counts_of_runs_add_up(spark, block_table, wire_map, strip_map, tmp_path):
    """Two runs counted one after the other give the curves of both read at once."""
    from hitframe.config import ASYMMETRY_BINS, DRIFT_BINS
    from hitframe.plans import calibration

    many = replace(WireConfig(), frame=MANY)
    blocks = sources.read_blocks(spark, block_table)
    leads, counts, out = (str(tmp_path / n) for n in ("leads", "counts", "curves"))
    jobs.wire_leads(blocks, wire_map, many, leads)
    found = sources.read_stage(spark, leads)
    for run in ("run1", "run2", "run1"):  # a repeated run replaces its counts
        jobs.count_drift(found.where(F.col("runname") == run), many, counts)
    jobs.curves_from_counts(sources.read_stage(spark, counts), "both", out, DRIFT_BINS)
    one_step = calibration.drift_curves(found, many, ["plane"])
    assert same(one_step.select("plane", "x", "tx"), sources.read_curves(spark, out).where("run = 'both'"))
    jobs.curves_from_counts(sources.read_stage(spark, counts), "first", out, DRIFT_BINS, ["run1"])
    alone = calibration.drift_curves(found.where("runname = 'run1'"), many, ["plane"])
    assert same(alone.select("plane", "x", "tx"), sources.read_curves(spark, out).where("run = 'first'"))

    cfg = replace(RPA_STRIPS, frame=MANY)
    events, sides = str(tmp_path / "events"), str(tmp_path / "sides")
    jobs.strip_events(blocks, strip_map, cfg, events)
    table = sources.read_stage(spark, events)
    jobs.count_asymmetry(table, cfg, sides)
    jobs.curves_from_counts(sources.read_stage(spark, sides), "both", out, ASYMMETRY_BINS)
    wanted = calibration.asymmetry_curves(table, cfg, []).select("plane", "x", "tx")
    assert same(wanted, sources.read_curves(spark, out).where("run = 'both' and plane in ('x', 'y')"))


def test_runs_left_by_a_lost_job_are_done_later(spark, block_table, wire_map, tmp_path):
    many = replace(WireConfig(), frame=MANY)
    blocks = sources.read_blocks(spark, block_table)
    leads, commits = str(tmp_path / "leads"), str(tmp_path / "commits")
    seen = []

    def job(part, fail=()):
        runs = [r.runname for r in part.select("runname").distinct().collect()]
        jobs.wire_leads(part, wire_map, many, leads)
        seen.append(runs)
        if set(runs) & set(fail):
            raise RuntimeError("lost after its write")

    with pytest.raises(RuntimeError):
        jobs.run_pending(blocks, "leads", commits, lambda part: job(part, ["run2"]), at_once=1)
    assert seen == [["run1"], ["run2"]]
    assert [r.runname for r in sources.committed_runs(spark, commits, "leads").collect()] == ["run1"]
    # the run that was written but not committed is repeated, and only that one
    assert jobs.run_pending(blocks, "leads", commits, job) == ["run2"]
    assert jobs.run_pending(blocks, "leads", commits, job) == []
    assert seen[2:] == [["run2"]]
    whole = str(tmp_path / "whole")
    jobs.wire_leads(blocks, wire_map, many, whole)
    assert same(sources.read_stage(spark, whole), sources.read_stage(spark, leads))
    # another stage has commits of its own
    assert sources.pending_runs(blocks, spark, commits, "positions").count() == 2


def test_bucketed_stages_join_without_an_exchange(spark, tmp_path):
    left = spark.range(500).select(F.col("id").alias("frame_id"), (F.col("id") * 0.5).alias("sr_pos_x"), F.lit(1.0).alias("sr_pos_y"))
    right = spark.range(100, 900).select(F.col("id").alias("frame_id"), *[F.lit(float(i)).alias(c) for i, c in enumerate(("dc31_x", "dc31_y", "dc32_x", "dc32_y"))])
    from hitframe.plans import combine

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paths = [str(tmp_path / n) for n in ("left", "right")]
        stages = [sources.write_bucketed(df, p, ["frame_id"], 4) for df, p in zip((left, right), paths)]
        again = [sources.open_bucketed(spark, p, df.schema, ["frame_id"], 4) for df, p in zip(stages, paths)]
        for a, b in (stages, again):
            joined = combine.join_detectors(a, b)
            assert joined.count() == 400
            assert same(joined, combine.join_detectors(left, right))
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
            sums = a.groupBy("frame_id").agg(F.sum("sr_pos_x"))
            assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("stage_")]
