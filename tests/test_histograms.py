import random
from collections import Counter

from pyspark.sql import functions as F

from hitframe.config import Bins
from hitframe.operators import histograms as H


def test_bin_edges(spark):
    bins = Bins(0.0, 0.4, 400)
    values = [-1e-12, 0.0, 0.001, 0.0009999, 0.3999999999, 0.39999999999999997, 0.4, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(H.bin_of("v", bins)).collect()]
    assert got[0] is None and got[6] is None and got[7] is None
    assert got[1] == 0 and got[3] == 0 and got[4] == 399 and got[5] == 399
    assert got[2] in (0, 1)


def test_dense_and_sparse(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 2.5), ("a", 9.0), ("b", 2.1)], "g string, v double")
    bins = Bins(0, 3, 3)
    dense = sorted(map(tuple, H.hist1d(df, "v", bins, ["g"]).collect()))
    assert dense == [("a", 0, 1), ("a", 1, 0), ("a", 2, 1), ("b", 0, 0), ("b", 1, 0), ("b", 2, 1)]
    sparse = sorted(map(tuple, H.hist1d(df, "v", bins, ["g"], dense=False).collect()))
    assert sparse == [("a", 0, 1), ("a", 2, 1), ("b", 2, 1)]
    assert sorted(map(tuple, H.hist1d(df, "v", bins).collect())) == [(0, 1), (1, 0), (2, 2)]
    empty = H.hist1d(df.where("false"), "v", bins)
    assert sorted(map(tuple, empty.collect())) == [(0, 0), (1, 0), (2, 0)]


def test_projections_keep_the_total(spark):
    rnd = random.Random(1)
    rows = [(rnd.uniform(-1, 6), rnd.uniform(-1, 6)) for _ in range(500)]
    df = spark.createDataFrame(rows, "x double, y double")
    b = Bins(0, 5, 10)
    grid = H.hist2d(df, "x", b, "y", b).cache()
    total = sum(1 for x, y in rows if 0 <= x < 5 and 0 <= y < 5)
    assert grid.agg(F.sum("n")).first()[0] == total
    assert H.project_x(grid).agg(F.sum("n")).first()[0] == total
    assert H.project_y(grid, 0, 9).agg(F.sum("n")).first()[0] == total
    part = sum(1 for x, y in rows if 1 <= x < 2 and 0 <= y < 5)
    assert H.project_y(grid, 2, 3).agg(F.sum("n")).first()[0] == part


def test_parallel_arrays(spark):
    rows = [([1, 2], [10.0, 20.0]), ([1], [11.0]), ([], [])]
    df = spark.createDataFrame(rows, "ids array<int>, q array<double>")
    got = H.hist2d_arrays(df, "ids", Bins(-0.5, 3.5, 4), "q", Bins(0, 30, 3)).collect()
    assert Counter(map(tuple, got)) == Counter([(1, 1, 2), (2, 2, 1)])


def test_mode_takes_the_lowest_bin_on_ties(spark):
    df = spark.createDataFrame(
        [("a", 5, 3), ("a", 2, 3), ("a", 9, 1), ("b", 0, 1)], "g string, bin long, n long"
    )
    assert sorted(map(tuple, H.mode_bin(df, ["g"]).collect())) == [("a", 2, 3), ("b", 0, 1)]
