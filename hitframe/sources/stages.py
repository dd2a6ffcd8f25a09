"""Stage tables: every stage is a Parquet table partitioned by run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hitframe.session import scratch_path


def write_stage(df: DataFrame, path: str, runname: str | None = None) -> None:
    """Write one stage. Only the runs present in ``df`` are replaced.

    Rows are gathered by run first, so that a task does not leave a file per run;
    large runs are split and small ones put together as the rows turn out.
    """
    if runname is not None:
        df = df.withColumn("runname", F.lit(runname))
    (
        df.hint("rebalance", "runname")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("runname")
        .parquet(path)
    )


def read_stage(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """Read one stage; naming a run prunes the scan to its partition.

    Run labels are text, also those that look like numbers. Spark infers the types of
    partition columns while it lists the folder, so that is switched off for the read.
    """
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = spark.read.parquet(path)
    finally:
        spark.conf.set(key, old)
    return df if run is None else df.where(F.col("runname") == run)


def write_bucketed(
    df: DataFrame, path: str, keys: list[str], buckets: int, placed: bool = False, compression: str = "snappy"
) -> DataFrame:
    """Write a stage cut into ``buckets`` by ``keys`` and return it as it reads back.

    Stages with equal buckets join and group on the keys without moving a row: the one
    shuffle is paid when the stage is written. The cut is known by the table that is
    returned, as files alone do not tell it; ``open_bucketed`` opens them again. ``placed``
    says that the rows are repartitioned by the keys already, into as many partitions.
    """
    spark = df.sparkSession
    name = f"stage_{uuid.uuid4().hex}"
    rows = df if placed else df.repartition(buckets, *keys)
    writer = rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).option("compression", compression).saveAsTable(name)
    return _unlisted(spark, name)


def open_bucketed(spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int) -> DataFrame:
    """A stage of ``write_bucketed`` from its files."""
    name = f"stage_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return _unlisted(spark, name)


def _unlisted(spark: SparkSession, name: str) -> DataFrame:
    """The table without its entry in the catalogue; the files stay where they are."""
    df = spark.table(name)
    df.schema  # resolves the table, which the plan then holds
    spark.sql(f"DROP TABLE {name}")
    return df


def commit_runs(spark: SparkSession, path: str, stage: str, runs: list[str]) -> None:
    """Record that a stage has written these runs: one append, all of them or none."""
    rows = [(stage, run) for run in runs]
    if rows:
        spark.createDataFrame(rows, "stage string, runname string").coalesce(1).write.mode("append").parquet(path)


def committed_runs(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """``runname`` of each run that a stage has committed; none if nothing was ever."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], "runname string")
    table = spark.read.schema("stage string, runname string").parquet(path)
    return table.where(F.col("stage") == stage).select("runname").distinct()


def pending_runs(inputs: DataFrame, spark: SparkSession, path: str, stage: str) -> DataFrame:
    """``runname`` of each run of the inputs that the stage has not committed."""
    return inputs.select("runname").distinct().join(committed_runs(spark, path, stage), "runname", "left_anti")


def write_curves(curves: DataFrame, path: str) -> None:
    """CSV curves, one folder per run and plane. A curve is a few hundred rows,
    so the shuffle that brings each one into a single file is small."""
    (
        curves.select("run", "plane", "x", "tx")
        .repartition("run", "plane")
        .sortWithinPartitions("run", "plane", "x")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("run", "plane")
        .csv(path)
    )


def write_mode_table(modes: DataFrame, path: str) -> None:
    (
        modes.select("id", "mode_bin", "setting", "pulse_pc")
        .repartition("setting", "pulse_pc")
        .sortWithinPartitions("id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("setting", "pulse_pc")
        .csv(path)
    )


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def union_runs(runs: dict[str, DataFrame]) -> DataFrame:
    """Several runs as one table, each row labelled with its run."""
    out = None
    for run, df in runs.items():
        part = df.withColumn("runname", F.lit(run))
        out = part if out is None else out.unionByName(part)
    return out


def select_by_suffix(
    df: DataFrame, keys: tuple[str, ...], suffixes: tuple[str, ...]
) -> DataFrame:
    return df.select(*keys, *[c for c in df.columns if c not in keys and c.endswith(suffixes)])


def preview(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)
