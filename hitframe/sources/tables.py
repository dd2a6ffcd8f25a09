"""Readers for raw blocks, channel maps, calibrations and curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitframe import schemas


def read_blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Decoded readout blocks; only valid ones (``tfId > 0``)."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(schemas.BLOCKS).parquet(*paths).where("tfId > 0")


def _read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    # Map files pad their values with blanks.
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )


def read_wire_map(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Channel maps of all wire detectors as one table with a ``detector`` column."""
    parts = [
        _read_csv(spark, path, schemas.WIRE_MAP).withColumn("detector", F.lit(detector))
        for detector, path in paths.items()
    ]
    return _union(parts)


def read_strip_map(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Channel maps of both strip sides as one table with a ``side`` column."""
    parts = [
        _read_csv(spark, path, schemas.STRIP_MAP).withColumn("side", F.lit(side))
        for side, path in paths.items()
    ]
    return _union(parts)


def read_linear_calibration(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    parts = [
        _read_csv(spark, path, schemas.LINEAR_CALIBRATION).withColumn("side", F.lit(side))
        for side, path in paths.items()
    ]
    return _union(parts)


def read_curve_files(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    """Curves from one CSV per plane and run.

    ``pattern`` is a regular expression on the file name with the plane as first
    group and the run as second one. A file that does not match it is an error.
    """
    file = F.col("_metadata.file_name")
    unknown = F.raise_error(F.concat(F.lit("no plane and run in the name of "), file))
    name = F.when(file.rlike(pattern), file).otherwise(unknown)
    return _read_csv(spark, path, schemas.CURVE_FILE).select(
        F.col("histy_x").alias("x"),
        "tx",
        F.regexp_extract(name, pattern, 2).alias("run"),
        F.regexp_extract(name, pattern, 1).alias("plane"),
    )


def read_curves(spark: SparkSession, path: str) -> DataFrame:
    """Curves from a folder written by ``write_curves``."""
    return _read_csv(spark, path, schemas.CURVES)


def read_mode_table(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.MODE_TABLE)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
