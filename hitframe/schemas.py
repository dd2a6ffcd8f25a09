"""Explicit schemas: no read in this package runs an inference job."""

from pyspark.sql import types as T

HIT = T.StructType(
    [
        T.StructField("ch", T.IntegerType()),
        T.StructField("time", T.LongType()),
        T.StructField("tot", T.LongType()),
    ]
)

# One decoded readout block. For strip boards ``tot`` carries the edge (0/1).
BLOCKS = T.StructType(
    [
        T.StructField("tfId", T.LongType()),
        T.StructField("femType", T.IntegerType()),
        T.StructField("femId", T.IntegerType()),
        T.StructField(
            "decoded",
            T.StructType(
                [
                    T.StructField(
                        "hbf", T.StructType([T.StructField("hbfNumber", T.LongType())])
                    ),
                    T.StructField("data", T.ArrayType(HIT)),
                ]
            ),
        ),
    ]
)

WIRE_MAP = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("femId", T.IntegerType()),
        T.StructField("ch", T.IntegerType()),
    ]
)

STRIP_MAP = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("ch", T.IntegerType())]
)

LINEAR_CALIBRATION = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("p1", T.DoubleType()),
        T.StructField("p0", T.DoubleType()),
    ]
)

CURVE_FILE = T.StructType(
    [T.StructField("histy_x", T.DoubleType()), T.StructField("tx", T.DoubleType())]
)

CURVES = T.StructType(
    [
        T.StructField("x", T.DoubleType()),
        T.StructField("tx", T.DoubleType()),
        T.StructField("run", T.StringType()),
        T.StructField("plane", T.StringType()),
    ]
)

MODE_TABLE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("mode_bin", T.IntegerType()),
        T.StructField("setting", T.StringType()),
        T.StructField("pulse_pc", T.DoubleType()),
    ]
)
