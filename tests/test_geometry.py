import itertools
import math

import pytest

from hitframe import functions as H
from hitframe.config import WireConfig


def reference_pair(id1, dl1, id2, dl2, d):
    """The branch table, written out."""
    b1, b2 = (id1 - 7.25) * 3.0, (id2 - 7.75) * 3.0 + d
    lim = 1.5 - abs(d)
    eq = id1 == id2
    if d > 0:
        p1 = b1 + dl1 if (not eq or dl2 is not None and dl2 > lim) else b1 - dl1
        p2 = b2 - dl2 if (not eq or dl1 is not None and dl1 > lim) else b2 + dl2
    else:
        p1 = b1 - dl1 if (eq or dl2 is not None and dl2 > lim) else b1 + dl1
        p2 = b2 + dl2 if (eq or dl1 is not None and dl1 > lim) else b2 - dl2
    return p1, p2


@pytest.mark.parametrize("shift", [0.07, -0.08, 0.0])
def test_left_right_table(spark, shift):
    lim = 1.5 - abs(shift)
    drifts = [0.0, 0.7, lim, math.nextafter(lim, 2), 1.5]
    rows = [
        (i1, a, i2, b) for i1, i2 in ((5, 5), (5, 6)) for a, b in itertools.product(drifts, drifts)
    ]
    df = spark.createDataFrame(rows, "i1 int, d1 double, i2 int, d2 double")
    p1, p2 = H.left_right("i1", "d1", "i2", "d2", shift, 3.0, (7.25, 7.75))
    for r in df.select("*", p1.alias("p1"), p2.alias("p2")).collect():
        assert (r.p1, r.p2) == pytest.approx(reference_pair(r.i1, r.d1, r.i2, r.d2, shift))


@pytest.mark.parametrize("shift", [0.07, -0.08])
def test_missing_drift(spark, shift):
    df = spark.createDataFrame(
        [(5, 0.4, 5, None), (5, 0.4, 6, None)], "i1 int, d1 double, i2 int, d2 double"
    )
    p1, p2 = H.left_right("i1", "d1", "i2", "d2", shift, 3.0, (7.25, 7.75))
    b1 = (5 - 7.25) * 3
    got = [tuple(r) for r in df.select(p1, p2).collect()]
    # undecided tests fall to the other branch
    sign = -1 if shift > 0 else -1
    assert got[0][0] == pytest.approx(b1 + sign * 0.4)
    assert got[1][0] == pytest.approx(b1 + 0.4)
    assert got[0][1] is None and got[1][1] is None


@pytest.mark.parametrize("shift", [0.15, -0.08, 0.0])
def test_shifted_drift(spark, shift):
    s = abs(shift)
    rows = [(4, dl1, i2, 1.0) for i2 in (4, 5) for dl1 in (0.2, 1.5 - s, 1.49)]
    df = spark.createDataFrame(rows, "i1 int, d1 double, i2 int, d2 double")
    for r in df.select("*", H.shifted_drift("i1", "d1", "i2", "d2", shift, 3.0).alias("n")).collect():
        near = (r.i1 != r.i2) if shift > 0 else (r.i1 == r.i2)
        want = r.d2 - s if near or r.d1 > 1.5 - s else r.d2 + s
        assert r.n == pytest.approx(want)


def test_extrapolation_of_a_known_line(spark):
    cfg = WireConfig()
    z = cfg.targets["z229"]
    for axis, mirror in (("x", True), ("y", False)):
        up, down = getattr(cfg.upstream, axis), getattr(cfg.downstream, axis)
        df = spark.createDataFrame([(1 + 0.01 * up, 1 + 0.01 * down)], "a double, b double")
        got = df.select(H.extrapolate("a", "b", up, down, z, mirror)).first()[0]
        line = 1 + 0.01 * z
        assert got == pytest.approx(-line if mirror else line)


def test_strip_position(spark):
    df = spark.createDataFrame([(10, 11, 0.5), (10, 9, 0.5), (10, 11, None)], "a int, b int, d double")
    ins = H.strip_inset("a", "b", "d")
    out = df.select(ins.alias("i"), "a").select("i", H.strip_position("a", "i", 16, 1.275))
    got = [tuple(r) for r in out.collect()]
    assert got[0] == pytest.approx((0.5, 6 * 2.55 + 0.5 - 1.275))
    assert got[1] == pytest.approx((-0.5, 6 * 2.55 - 0.5 - 1.275))
    assert got[2] == (None, None)


def test_mirror_fix_turns_the_inset_round(spark):
    from hitframe.functions import strip_position

    df = spark.createDataFrame([(10, 0.5)], "id0 int, ins double")
    plain, fixed = df.select(
        strip_position("id0", "ins", 16, 1.0), strip_position("id0", "ins", 16, 1.0, mirror_fix=True)
    ).first()
    assert (plain, fixed) == (11.5, 10.5)
