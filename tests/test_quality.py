import math

import pytest
from pyspark.sql import functions as F

from hitframe.config import Bins
from hitframe.operators import quality

EVENT = "size_x int, id0_x int, id1_x int, id2_x int, charge0_x double, charge2_x double, id0_y int, id1_y int, id2_y int, charge0_y double, charge2_y double"


def events(spark):
    rows = [
        (3, 5, 6, 4, 9.0, 1.0, 7, 8, 6, 9.0, 1.0),
        (3, 5, 6, 7, 9.0, 1.0, 7, 8, 6, 9.0, 1.0),
        (2, 5, 6, None, 9.0, None, 7, 8, 6, 9.0, 1.0),
    ]
    return spark.createDataFrame(rows, EVENT)


def test_efficiency(spark):
    triggers = spark.range(4)
    r = quality.efficiency(events(spark), triggers).first()
    assert (r.n_triggers, r.n_clusters, r.efficiency) == (4, 1, 25.0)
    none = quality.efficiency(events(spark), triggers.where("false")).first()
    assert (none.n_triggers, none.efficiency) == (0, None)


def test_slot_efficiency(spark):
    got = {r.side: (r.n0, r.n2, r.efficiency) for r in quality.slot_efficiency(events(spark)).collect()}
    assert got == {"x": (3, 2, pytest.approx(2 / 3)), "y": (3, 3, 1.0)}


def test_resolution_divides_by_all_rows(spark):
    rows = [(0.0, 0.2), (0.0, 0.6), (0.0, 4.0), (1.0, None)]
    df = spark.createDataFrame(rows, "a_posi double, b_posi double")
    r = quality.resolution(df, {"v": ("a", "b")}).first()
    ss = 0.1**2 + 0.3**2  # the row that is 2 off the mean is not accepted
    def um(n):
        return math.sqrt((ss / n + ss / n) / 2 * 1) / 2 * 1000
    assert r.n_all == 4
    assert r.resolution_um == pytest.approx(um(4))
    assert r.resolution_accepted_um == pytest.approx(um(2))


def test_residual_summary(spark):
    df = spark.createDataFrame([("p", float(v)) for v in (1, 2, 3, 50)], "pair string, diff double")
    r = quality.residual_summary(df, "diff", ["pair"], (0, 10)).first()
    assert (r.n, r.centre, r.width, r.median) == (3, 2.0, 1.0, 2.0)
    assert r.quartile_width == 0.5


def test_exact_quantiles(spark, monkeypatch):
    import random

    from hitframe.operators import statistics

    monkeypatch.setattr(statistics, "FEW", 8)
    monkeypatch.setattr(statistics, "CUTS", 4)
    rnd = random.Random(1)
    groups = {
        "wide": [rnd.lognormvariate(0, 8) for _ in range(900)],
        "ties": [float(rnd.randrange(3)) for _ in range(500)],
        "one": [4.25],
        "two": [1.0, 2.0],
        "negative": [-rnd.random() * 1e-9 for _ in range(100)],
        None: [rnd.gauss(0, 1) for _ in range(77)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("wide", None), ("none", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    fractions = (0.0, 0.1, 0.5, 0.999, 1.0)
    got = {r.g: r for r in statistics.exact_quantiles(df, "v", ["g"], fractions).collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        vs = sorted(vs)
        for i, f in enumerate(fractions):
            p = f * (len(vs) - 1)
            a, b = vs[math.floor(p)], vs[math.ceil(p)]
            assert got[g][f"q{i}"] == pytest.approx(a + (b - a) * (p - math.floor(p)), rel=1e-12)


def test_quantiles_of_the_whole_table_and_of_none(spark):
    from hitframe.operators.statistics import exact_quantiles

    df = spark.range(20_001).select((F.col("id") * 0.5).alias("v"))
    assert [tuple(r) for r in exact_quantiles(df, "v", [], (0.5, 0.25)).collect()] == [(5000.0, 2500.0)]
    assert exact_quantiles(df.where("false"), "v", [], (0.5,)).isEmpty()
    with pytest.raises(Exception, match="infinite"):
        exact_quantiles(df.select(F.lit(float("inf")).alias("v")), "v", []).collect()


def test_peak_fit(spark):
    from hitframe.operators.statistics import peak_fit

    bins = Bins(-5.0, 15.0, 80)
    x = [bins.lo + (i + 0.5) * bins.width for i in range(bins.n)]
    peak = lambda c, w, h: [round(h * math.exp(-((v - c) ** 2) / (2 * w * w))) for v in x]
    rows = [("a", i, n) for i, n in enumerate(peak(3.2, 1.1, 50_000))]
    rows += [("b", i, n) for i, n in enumerate(peak(9.0, 0.5, 900)) if n]
    rows += [("flat", i, 7) for i in range(80)] + [("two", 1, 5), ("two", 2, 9)] + [("valley", i, (i - 40) ** 2 + 1) for i in range(80)]
    df = spark.createDataFrame(rows, "g string, bin long, n long")
    got = {r.g: r for r in peak_fit(df, bins, ["g"]).collect()}
    assert (got["a"].centre, got["a"].width) == (pytest.approx(3.2, abs=1e-3), pytest.approx(1.1, abs=1e-3))
    assert (got["b"].centre, got["b"].width) == (pytest.approx(9.0, abs=5e-3), pytest.approx(0.5, abs=5e-3))
    assert got["a"].height == pytest.approx(50_000, rel=1e-3)
    assert got["two"].centre is None and got["valley"].centre is None
    plan = peak_fit(df, bins, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
