"""The detector chains on random blocks against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hitframe import schemas
from hitframe.config import (
    ASAGI_STRIPS,
    RESIDUAL_PAIRS,
    RPA_STRIPS,
    TICK_NS,
    Bins,
    WireConfig,
)
from hitframe.operators import quality
from hitframe.plans import calibration, combine, strip, wire

CFG = WireConfig()


@pytest.fixture(scope="module")
def wire_map(spark):
    rows = [((c * 7) % 128, 616 + c // 64, c % 64, "dc31") for c in range(128)]
    rows += [((c * 5) % 64, 618, c, "dc32") for c in range(64)]
    return spark.createDataFrame(rows, "id int, femId int, ch int, detector string")


@pytest.fixture(scope="module")
def readout(spark):
    """60 frames: 40 with a trigger, and about three hits on each plane."""
    rnd = random.Random(11)
    rows, tf = [], 1
    for frame in range(60):
        t0 = 1_000_000 + rnd.randrange(1000)
        if frame % 3:
            rows.append((tf, 5, 614, ((frame,), [(4, t0, 9), (4, t0 + 500, 9), (2, t0 - 9000, 9)])))
        for fem in (616, 617, 618):
            data = [
                (rnd.randrange(66), t0 - rnd.randrange(-5000, 65000), rnd.randrange(5000, 170000))
                for _ in range(40)
            ]
            rows.append((tf, 5, fem, ((frame,), data)))
        tf += 1
    rows.append((0, 5, 616, ((999,), [(1, 1, 1)])))
    return rows, spark.createDataFrame(rows, schemas.BLOCKS).where("tfId > 0")


@pytest.fixture(scope="module")
def curves(spark):
    rows = [(p, -60.0 + i * 0.25, i / 240) for p in CFG.planes for i in range(20, 220)]
    return spark.createDataFrame(rows, "plane string, x double, tx double")


def python_leads(rows, chmap):
    channel = {(r.femId, r.ch): (r.detector, r.id) for r in chmap.collect()}
    t0, lists = {}, defaultdict(list)
    for tf, _, fem, ((frame,), data) in rows:
        if tf > 0 and fem == 614:
            t0[frame] = min((t + 0.5) * TICK_NS for ch, t, _ in data if ch == 4)
    for tf, _, fem, ((frame,), data) in rows:
        if tf == 0 or fem == 614 or frame not in t0:
            continue
        for ch, t, tot in data:
            if (fem, ch) not in channel:
                continue
            detector, ident = channel[fem, ch]
            q, dt = (tot + 0.5) * TICK_NS, (t + 0.5) * TICK_NS - t0[frame]
            if 10 < q < 150 and -60 < dt < 0:
                plane = f"{detector}_{CFG.detectors[detector][ident // 16]}"
                lists[frame, plane].append((-q, ident % 16, dt))
    return {k: sorted(v) for k, v in lists.items()}


def chain_leads(df, wire_map):
    from hitframe.operators import hits

    triggers = wire.trigger_times(df, CFG, "mid")
    return wire.leading_hits(
        wire.mapped_hits(hits.wire_hits(df, CFG, "mid"), triggers, wire_map, CFG), CFG
    )


def test_wire_leads(spark, readout, wire_map):
    rows, df = readout
    want = python_leads(rows, wire_map)
    got = {(r.frame_id, r.plane): r for r in chain_leads(df, wire_map).collect()}
    assert got.keys() == want.keys()
    for k, hits in want.items():
        r = got[k]
        assert (r["size"], -r.charge0, r.id0, r.timing0) == (len(hits), *hits[0])


def test_wire_positions(spark, readout, wire_map, curves):
    rows, df = readout
    lists = python_leads(rows, wire_map)
    complete = {f for f in range(60) if all((f, p) in lists for p in CFG.planes)}
    assert complete
    out = wire.positions(df, wire_map, curves, CFG, "mid")
    full = {r.frame_id: r for r in out.collect()}
    assert full.keys() == complete
    for f, r in full.items():
        for p in CFG.planes:
            assert r[f"{p}_id0"] == lists[f, p][0][1]
            dt = lists[f, p][0][2]
            inside = -55.0 <= dt < -60 + 219 * 0.25
            assert (r[f"{p}_dl"] is not None) == inside
            if inside:
                i = int((dt + 60) / 0.25)
                assert i / 240 * 1.5 - 1e-12 <= r[f"{p}_dl"] <= (i + 1) / 240 * 1.5 + 1e-12
        for view, planes in CFG.views.items():
            parts = [r[f"{p}_posi"] for p in planes]
            if None in parts:
                assert r[view] is None
            else:
                assert r[view] == pytest.approx(sum(parts) / len(parts))
    points = wire.target_table(out, CFG)
    assert points.columns == [
        "frame_id", "dc31_x", "dc31_y", "dc32_x", "dc32_y",
        "x_z229", "y_z229", "x_z400", "y_z400", "sra_tdc_raw",
    ]
    # a repeated run gives the same numbers: the dither belongs to the hit
    again = wire.positions(df.repartition(5), wire_map, curves, CFG, "mid")
    assert out.exceptAll(again).isEmpty()


def test_hits_are_shuffled_once(spark, readout, wire_map, curves):
    _, df = readout
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = wire.positions(df, wire_map, curves, CFG, "mid", 4000)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # hits, time zeros and the curve window: nothing after the frame join
    assert text.count("Exchange hashpartitioning(frame_id") == 2
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_event_lists(spark, readout, wire_map):
    from hitframe.operators import hits

    rows, df = readout
    lists = python_leads(rows, wire_map)
    complete = {f for f in range(60) if all((f, p) in lists for p in CFG.planes)}
    triggers = wire.trigger_times(df, CFG, "mid")
    out = wire.event_hits(hits.wire_hits(df, CFG, "mid"), triggers, wire_map, CFG)
    got = {(r.frame_id, r.plane, r["rank"]): (-r.charge, r.id, r.timing) for r in out.collect()}
    want = {
        (*k, i + 1): h for k, v in lists.items() if k[0] in complete for i, h in enumerate(v)
    }
    assert got == want


def test_quality_plans_run_on_positions(spark, readout, wire_map, curves):
    _, df = readout
    out = wire.positions(df, wire_map, curves, CFG).cache()
    assert quality.residual_columns(out, RESIDUAL_PAIRS).count() == out.count() * len(RESIDUAL_PAIRS)
    assert quality.resolution(out, CFG.views).count() == 4
    check = wire.shift_check(out, CFG)
    assert check.count() == out.count() * len(CFG.pairs)
    same = out.where("dc31_x1_id0 = dc31_x2_id0").count()
    assert check.where("pair = 'dc31_x1-dc31_x2' and same_wire").count() == same


def test_drift_calibration_job(spark, readout, wire_map):
    _, df = readout
    leads = chain_leads(df, wire_map).withColumn("run", F.lit("run1"))
    out = calibration.drift_curves(leads, CFG, ["run", "plane"])
    kept = leads.where(
        "id0 > 0 and id0 < 15 and charge0 > 30 and charge0 < 120 and timing0 >= -50 and timing0 < 0"
    )
    assert out.select("plane").distinct().count() == kept.select("plane").distinct().count()
    last = out.groupBy("plane").agg(F.max("tx").alias("m"))
    assert last.where("m < 0.999").isEmpty()


# --- strips -----------------------------------------------------------------


def strip_rows(cfg, seed=2):
    rnd = random.Random(seed)
    rows, truth = [], {}
    for frame in range(80):
        if frame % 5 == 0:
            continue
        t0 = 50_000 + rnd.randrange(100)
        rows.append((frame + 1, 5, 614, ((frame,), [(4, t0, 9)])))
        data = []
        for _ in range(rnd.randrange(1, 12)):
            ch = rnd.randrange(64)
            lead = t0 + rnd.randrange(-48_000, -33_000)
            data.append((ch, lead, 0))
            data.append((ch, lead + rnd.randrange(50, 900), 1))
        if cfg.flip_even_channels:
            data = [(c, t, 1 - e if c % 2 == 0 else e) for c, t, e in data]
        rows.append((frame + 1, 7, 615, ((frame,), data)))
        truth[frame] = (t0, data)
    return rows, truth


@pytest.mark.parametrize("cfg", [RPA_STRIPS, ASAGI_STRIPS], ids=["rpa", "asagi"])
def test_strip_chain(spark, cfg):
    rows, truth = strip_rows(cfg)
    df = spark.createDataFrame(rows, schemas.BLOCKS)
    chmap = spark.createDataFrame(
        [(31 - c, c, "y") for c in range(32)] + [(c, c + 32, "x") for c in range(32)],
        "id int, ch int, side string",
    )
    wide, triggers = strip.events(df, chmap, cfg, "mid")
    got = {r.frame_id: r for r in wide.collect()}
    seen = set()
    for frame, (t0, data) in truth.items():
        edge = defaultdict(lambda: ([], []))
        for c, t, e in data:
            dt = (t + 0.5) * TICK_NS - (t0 + 0.5) * TICK_NS
            if cfg.window[0] < dt < cfg.window[1]:
                e = 1 - e if cfg.flip_even_channels and c % 2 == 0 else e
                edge[c][e].append(dt)
        for side in "xy":
            hits = sorted(
                (-(b - a), (c - 32 if c >= 32 else 31 - c), a)
                for c, (lead, trail) in edge.items()
                if (c >= 32) == (side == "x")
                for a in lead
                for b in trail
            )
            if not hits:
                assert frame not in got or got[frame][f"size_{side}"] is None
                continue
            seen.add(frame)
            r = got[frame]
            assert int(r[f"size_{side}"]) == len(hits)
            assert r[f"timing0_{side}"] == pytest.approx(hits[0][2])
            for i in range(3):
                want = (-hits[i][0], hits[i][1]) if i < len(hits) else (None, None)
                assert (r[f"charge{i}_{side}"], r[f"id{i}_{side}"]) == want
    assert got.keys() == seen
    assert triggers.count() == len(truth)

    adjacent = strip.adjacent_events(wide, cfg)
    curves = calibration.asymmetry_curves(wide, cfg, [], Bins(0.0, 1.0, 20))
    pos = strip.positions(wide, curves, cfg, 40)
    assert pos.count() == adjacent.count()
    for s in "xy":
        half = abs(cfg.half_strip[s])
        assert pos.where(F.abs(F.col(f"sr_ins_{s}")) > half).isEmpty()


def test_strip_slots_with_gains_of_any_sign(spark):
    """Charges are calibrated before they are ordered; strips without constants go."""
    cfg = ASAGI_STRIPS
    rnd = random.Random(4)
    rows, times = [], {}
    for frame in range(60):
        for ch in rnd.sample(range(12), 5):
            lead = [rnd.randrange(-2000, 9000) / 64 for _ in range(rnd.randrange(1, 6))]
            trail = [rnd.randrange(-2000, 9000) / 64 for _ in range(rnd.randrange(1, 6))]
            times[frame, ch] = (lead, trail)
            rows += [(frame, ch, 0, t) for t in lead] + [(frame, ch, 1, t) for t in trail]
    timed = spark.createDataFrame(rows, "frame_id long, ch int, edge int, timing double")
    chmap = spark.createDataFrame([(c // 2, c, "xy"[c % 2]) for c in range(12)], "id int, ch int, side string")
    gains = {c: ((1.25, -0.75, 0.0, -2.0, 0.5)[c % 5], c * 0.5 - 2) for c in range(12) if c not in (3, 8)}
    calib = spark.createDataFrame(
        [("xy"[c % 2], c // 2, *g) for c, g in gains.items()] + [("x", 99, 1.0, 0.0), ("y", 1, None, 0.0)],
        "side string, id int, p1 double, p0 double",
    )
    got = {(r.frame_id, r.side): r for r in strip.side_slots(timed, chmap, cfg, 12, calib).collect()}
    want = defaultdict(list)
    for (frame, c), (lead, trail) in times.items():
        if c in gains:
            p1, p0 = gains[c]
            want[frame, "xy"[c % 2]] += [(-((b - a) * p1 + p0), c // 2, a) for a in lead for b in trail]
    assert got.keys() == want.keys()
    for key, hits in want.items():
        hits.sort()
        r = got[key]
        assert (int(r["size"]), r.timing0) == (len(hits), hits[0][2])
        for i in range(3):
            assert (r[f"charge{i}"], r[f"id{i}"]) == ((-hits[i][0], hits[i][1]) if i < len(hits) else (None, None))


def test_detector_join(spark):
    s = spark.createDataFrame([(1, 0.5, 9.0, 1.5), (2, 0.0, 0.0, 0.0)], "frame_id long, sr_pos_x double, sr_ins_x double, sr_pos_y double")
    w = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 4.0, 5)], "frame_id long, dc31_x double, dc31_y double, dc32_x double, dc32_y double, sra_tdc_raw long")
    joined = combine.join_detectors(s, w)
    assert joined.columns == ["frame_id", "sr_pos_x", "sr_pos_y", "dc31_x", "dc31_y", "dc32_x", "dc32_y"]
    got = {r.axis: r for r in combine.detector_residuals(joined, CFG).collect()}
    l1, l2 = -274.3, 784.97
    assert got["x"].track == pytest.approx(-(1.0 * l2 - 3.0 * l1) / (-l1 + l2))
    assert got["y"].diff == pytest.approx(1.5 - (2.0 * 790.97 + 4.0 * 268.3) / (268.3 + 790.97))


def test_pulser_modes(spark):
    rows = [("s", 3, 10.2), ("s", 3, 10.9), ("s", 3, 4.0), ("s", 32, 4.0), ("s", 1, 600.0)]
    df = spark.createDataFrame(rows, "setting string, id int, charge double")
    got = {r.id: r.mode_bin for r in calibration.pulser_modes(df, ["setting"]).collect()}
    assert len(got) == 32 and got[3] == 10 and got[0] == 0 and got[1] == 0
