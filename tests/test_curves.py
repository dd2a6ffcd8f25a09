import bisect
import random

import pytest
from pyspark.sql import functions as F

from hitframe.config import Bins
from hitframe.operators import curves, histograms
from hitframe.sources import materialise

BINS = Bins(0.0, 10.0, 50)


def curve_rows(spark, seed=2, n=4000):
    rnd = random.Random(seed)
    rows = [(p, rnd.gauss(5, 1.5)) for p in ("a", "b") for _ in range(n)]
    df = spark.createDataFrame(rows, "plane string, v double")
    counts = histograms.hist1d(df, "v", BINS, ["plane"])
    return rows, curves.cdf_curve(counts, BINS, ["plane"])


def expected(values, tol=1e-3):
    n = [0] * BINS.n
    for v in values:
        if BINS.lo <= v < BINS.hi:
            n[min(int((v - BINS.lo) / BINS.width), BINS.n - 1)] += 1
    total, run, tx = sum(n), 0, []
    for c in n:
        run += c
        tx.append(run / total)
    first = next(i for i, t in enumerate(tx) if t >= tol)
    last = next(i for i, t in enumerate(tx) if t >= 1 - tol)
    return [(BINS.lo + (i + 0.5) * BINS.width, tx[i]) for i in range(first, last + 1)]


def test_cdf_curve(spark):
    rows, curve = curve_rows(spark)
    for p in ("a", "b"):
        got = [(r.x, r.tx) for r in curve.where(F.col("plane") == p).orderBy("bin").collect()]
        want = expected([v for q, v in rows if q == p])
        assert [x for x, _ in got] == pytest.approx([x for x, _ in want])
        assert [t for _, t in got] == pytest.approx([t for _, t in want])
        assert all(a[0] < b[0] and a[1] <= b[1] for a, b in zip(got, got[1:]))
        assert got[0][1] >= 1e-3 and got[-1][1] >= 1 - 1e-3


def test_upper_edge_option(spark):
    _, curve = curve_rows(spark)
    counts = spark.createDataFrame([(i, 1) for i in range(50)], "bin long, n long")
    centre = curves.cdf_curve(counts, BINS, []).orderBy("bin").first().x
    edge = curves.cdf_curve(counts, BINS, [], x="upper_edge").orderBy("bin").first().x
    assert edge - centre == pytest.approx(BINS.width / 2)


def test_no_entries_no_curve(spark):
    counts = spark.createDataFrame([(i, 0) for i in range(50)], "bin long, n long")
    assert curves.cdf_curve(counts, BINS, []).isEmpty()


def points_of(spark, shape):
    rnd = random.Random(3)
    if shape == "even":
        return [(p, 1.0 + i * 0.2, i / 40) for p in ("a", "b") for i in range(41)]
    if shape == "gaps":
        return [(p, x, i / 20) for p in ("a", "b") for i, x in enumerate([0.0, 0.1, 0.2, 5.0, 5.1, 1e6, 1e6 + 0.1])]
    if shape == "two points":
        return [("a", -2.0, 0.0), ("a", 2.0, 1.0), ("b", 3.0, 0.5)]
    return [(p, x, i / 300) for p in ("a", "b") for i, x in enumerate(sorted(rnd.lognormvariate(0, 2) for _ in range(300)))]


@pytest.mark.parametrize("shape", ["even", "gaps", "two points", "uneven"])
@pytest.mark.parametrize("points", [None, 700, 10**9])
def test_lookup_equals_nested_loop(spark, shape, points):
    """Whatever the spacing, and with values right on the interval bounds."""
    rows = points_of(spark, shape)
    curve = spark.createDataFrame(rows, "plane string, x double, tx double")
    steps = curves.curve_intervals(curve, ["plane"])
    edges = [x for _, x, _ in rows]
    values = edges + [-3.0, 0.0, 99.0, None, float("nan")] + [random.Random(4).uniform(-1, 11) for _ in range(200)]
    df = spark.createDataFrame([(i, p, v) for i, v in enumerate(values) for p in "abc"], "n int, plane string, v double")
    got = curves.interval_lookup(df, curve, ["plane"], "v", points)
    df.createOrReplaceTempView("vals")
    steps.createOrReplaceTempView("steps")
    want = spark.sql(
        "select v.*, s.lo, s.hi, s.tx_lo, s.tx_hi from vals v left join steps s "
        "on v.plane = s.plane and v.v >= s.lo and v.v < s.hi"
    )
    got = got.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.count() == df.count()


def test_lookup_is_a_hash_join_without_copies_of_intervals(spark):
    curve = materialise(curve_rows(spark)[1], "curve")
    letters = F.when(F.col("id") < 50, "a").otherwise("b").alias("plane")
    df = spark.range(100).select(letters, F.col("id").cast("double").alias("v"))
    for points in (100, 10**9):
        plan = curves.interval_lookup(df, curve, ["plane"], "v", points)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "CartesianProduct" not in text and "Generate explode" not in text


def test_many_runs_are_one_small_broadcast(spark):
    """Curves of 200 runs and 12 planes: 2,400 rows, however many points they have."""
    curve = spark.range(200 * 12 * 100).select(
        F.expr("concat('run', id div 1200)").alias("run"),
        F.expr("concat('p', id div 100 % 12)").alias("plane"),
        (F.col("id") % 100 * 0.5).alias("x"),
        (F.col("id") % 100 / 99.0).alias("tx"),
    )
    assert curves.curve_table(curve, ["run", "plane"]).count() == 2400
    df = spark.range(5000).select(
        F.expr("concat('run', id % 200)").alias("run"), F.expr("concat('p', id % 12)").alias("plane"), (F.col("id") % 49 + 0.25).alias("v")
    )
    out = curves.curve_lookup(df, curve, ["run", "plane"], "v", None, 99.0, "dl")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("dl is null or abs(dl - v / 0.5) > 1e-9").isEmpty() and out.count() == 5000


def test_curves_in_force(spark):
    taken = [("a", 3, 1), ("a", 3, 2), ("a", 7, 1), ("b", 5, 9), ("c", 100, 1)]
    curve = spark.createDataFrame(taken, "plane string, run_no long, version long")
    runs = spark.createDataFrame([(p, r) for p in "abd" for r in (1, 3, 4, 7, 200) for _ in range(2)], "plane string, run_no long")
    got = {(r.plane, r.run_no): (r.curve_no, r.curve_version) for r in curves.curves_in_force(runs, curve, ["plane"]).collect()}
    none = (None, None)
    assert got == {
        ("a", 1): none, ("a", 3): (3, 2), ("a", 4): (3, 2), ("a", 7): (7, 1), ("a", 200): (7, 1),
        ("b", 1): none, ("b", 3): none, ("b", 4): none, ("b", 7): (5, 9), ("b", 200): (5, 9),
        **{("d", r): none for r in (1, 3, 4, 7, 200)},
    }


def test_lookup_of_the_rows_the_curve_came_from(spark):
    """Source and curve share their lineage; the keys must not be mixed up."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("plane"),
        (F.rand(3) * 10).alias("v"),
        "id",
    ).cache()
    counts = histograms.hist1d(df, "v", BINS, ["plane"])
    out = curves.curve_lookup(df, curves.cdf_curve(counts, BINS, ["plane"]), ["plane"], "v", F.lit(0.5), 1.5, "dl")
    assert out.where("plane is null").isEmpty()
    points = {p: sorted((r.x, r.tx) for r in curves.cdf_curve(counts, BINS, ["plane"]).where(F.col("plane") == p).collect()) for p in "ab"}
    for r in out.limit(300).collect():
        pts = points[r.plane]
        i = bisect.bisect_right([x for x, _ in pts], r.v)
        if 0 < i < len(pts):
            assert r.dl == pytest.approx((pts[i - 1][1] + pts[i][1]) / 2 * 1.5)
        else:
            assert r.dl is None
