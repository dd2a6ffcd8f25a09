import pytest
from pyspark.sql import functions as F

from hitframe import functions as H
from hitframe.config import Box


def values(df):
    return [tuple(r) for r in df.collect()]


def test_keyed_uniform_is_in_unit_interval_for_any_long(spark):
    keys = [(0,), (1,), (-1,), (2**62,), (-(2**63),), (2**63 - 1,)]
    df = spark.createDataFrame(keys, "k long")
    for draw in (0, 1, 2):
        us = [r[0] for r in df.select(H.keyed_uniform("k", draw)).collect()]
        assert all(0.0 <= u < 1.0 for u in us)
        assert us == [r[0] for r in df.select(H.keyed_uniform("k", draw)).collect()]


def test_draws_differ(spark):
    row = spark.range(7, 8).select(H.keyed_uniform("id", 0), H.keyed_uniform("id", 1)).first()
    assert row[0] != row[1]


def test_dither_modes(spark):
    df = spark.range(3)
    assert {r[0] for r in df.select(H.dither("mid")).collect()} == {0.5}
    assert all(0 <= r[0] < 1 for r in df.select(H.dither("rand", seed=3)).collect())
    with pytest.raises(ValueError):
        H.dither("none")


def test_large_ticks_keep_their_dither(spark):
    # a 32-bit float would lose the fraction at this size
    df = spark.createDataFrame([(160299837,)], "t long")
    got = df.select(H.ticks_to_ns("t", F.lit(0.25), 0.0009765625)).first()[0]
    assert got == 160299837.25 / 1024


def test_asymmetry(spark):
    df = spark.createDataFrame([(3.0, 1.0), (1.0, -1.0), (None, 1.0)], "a double, b double")
    assert values(df.select(H.asymmetry("a", "b"))) == [(0.5,), (None,), (None,)]


def test_mean_needs_every_value(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "a double, b double")
    assert values(df.select(H.mean_of(["a", "b"]))) == [(1.5,), (None,)]


def test_box_is_open(spark):
    df = spark.createDataFrame(
        [(10.0, -1.0), (10.5, -1.0), (150.0, -1.0), (20.0, -60.0), (20.0, 0.0)], "q double, t double"
    )
    box = Box((10, 150), (-60, 0))
    assert values(df.select(H.in_box("q", "t", box))) == [(False,), (True,), (False,), (False,), (False,)]


def test_even_channels_flip(spark):
    df = spark.createDataFrame([(2, 0), (2, 1), (3, 0), (3, 1)], "ch int, edge int")
    assert values(df.select(H.flip_even_channels("edge", "ch"))) == [(1,), (0,), (0,), (1,)]
