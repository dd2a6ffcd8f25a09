"""Stage-to-stage jobs: each reads tables, runs one plan and writes one table.

A job takes the blocks of one run or of many: with several, the frame key in the
config holds ``runname`` and the block table carries it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitframe.config import Bins, StripConfig, WireConfig
from hitframe.operators import hits, quality
from hitframe.session import drop_scratch, scratch_mark
from hitframe.sources import commit_runs, pending_runs, read_stage, write_curves, write_stage

from . import calibration, combine, strip, wire


def _leaves_no_scratch(job: Callable[..., None]) -> Callable[..., None]:
    """Delete the scratch tables a job has made once its output is written."""

    @wraps(job)
    def run(table: DataFrame, *args, **kwargs) -> None:
        mark = scratch_mark(table.sparkSession)
        job(table, *args, **kwargs)
        drop_scratch(table.sparkSession, mark)

    return run


@_leaves_no_scratch
def wire_leads(
    blocks: DataFrame, chmap: DataFrame, cfg: WireConfig, out: str, runname: str | None = None
) -> None:
    """Blocks -> leading hits of complete events, the input of the drift calibration."""
    mapped = wire.mapped_hits(
        hits.wire_hits(blocks, cfg), wire.trigger_times(blocks, cfg), chmap, cfg
    )
    write_stage(wire.complete_leads(mapped, cfg), out, runname)


@_leaves_no_scratch
def wire_hit_lists(
    blocks: DataFrame, chmap: DataFrame, cfg: WireConfig, out: str, runname: str | None = None
) -> None:
    """Blocks -> all hits of complete events with their rank."""
    lists = wire.event_hits(
        hits.wire_hits(blocks, cfg), wire.trigger_times(blocks, cfg), chmap, cfg
    )
    write_stage(lists, out, runname)


@_leaves_no_scratch
def wire_positions(
    blocks: DataFrame,
    chmap: DataFrame,
    curves: DataFrame,
    cfg: WireConfig,
    out: str,
    runname: str | None = None,
    targets_only: bool = False,
    curve_keys: tuple[str, ...] = ("plane",),
) -> None:
    """Blocks -> positions, or only the extrapolated points."""
    table = wire.positions(blocks, chmap, curves, cfg, curve_keys=curve_keys)
    write_stage(wire.target_table(table, cfg) if targets_only else table, out, runname)


def strip_events(
    blocks: DataFrame,
    chmap: DataFrame,
    cfg: StripConfig,
    out: str,
    runname: str | None = None,
    calib: DataFrame | None = None,
) -> DataFrame:
    """Blocks -> strip events. Returns the efficiency of each run of this call.

    It is counted on what was written, and the triggers say which runs those are: the
    folder may hold others. The report is a row per run, held by the driver.
    """
    spark = blocks.sparkSession
    mark = scratch_mark(spark)
    wide, triggers = strip.events(blocks, chmap, cfg, calib=calib)
    if runname is not None:
        triggers = triggers.withColumn("runname", F.lit(runname))
    write_stage(wide, out, runname)
    report = quality.efficiency(read_stage(spark, out), triggers, ("runname",))
    rows = report.collect()
    drop_scratch(spark, mark)
    return spark.createDataFrame(rows, report.schema)


@_leaves_no_scratch
def strip_hit_lists(
    blocks: DataFrame,
    chmap: DataFrame,
    cfg: StripConfig,
    out: str,
    runname: str | None = None,
    calib: DataFrame | None = None,
) -> None:
    """Blocks -> all strip hits of triggered frames with their rank, the pulser input."""
    triggers = strip.trigger_times(blocks, cfg)
    timed = strip.timed_edges(hits.strip_edges(blocks, cfg), triggers, cfg)
    write_stage(strip.hit_lists(timed, chmap, cfg, calib=calib), out, runname)


@_leaves_no_scratch
def strip_positions(
    events: DataFrame,
    curves: DataFrame,
    cfg: StripConfig,
    out: str,
    runname: str | None = None,
    curve_keys: tuple[str, ...] = ("side",),
) -> None:
    """Strip events -> positions."""
    write_stage(strip.positions(events, curves, cfg, curve_keys=curve_keys), out, runname)


@_leaves_no_scratch
def join(
    strips: DataFrame, wires: DataFrame, cfg: WireConfig, out: str, runname: str | None = None
) -> None:
    """Positions of both detectors on the same frame."""
    write_stage(combine.join_detectors(strips, wires, cfg.frame), out, runname)


@_leaves_no_scratch
def calibrate_drift(leads: DataFrame, cfg: WireConfig, out: str) -> None:
    """Leading hits of any number of runs -> one drift curve per run and plane."""
    found = calibration.drift_curves(leads, cfg, ["runname", "plane"])
    write_curves(found.withColumnRenamed("runname", "run"), out)


@_leaves_no_scratch
def calibrate_asymmetry(events: DataFrame, cfg: StripConfig, out: str) -> None:
    """Strip events of any number of runs -> one asymmetry curve per run and side."""
    found = calibration.asymmetry_curves(events, cfg, ["runname"])
    write_curves(found.withColumnRenamed("runname", "run"), out)


@_leaves_no_scratch
def count_drift(leads: DataFrame, cfg: WireConfig, out: str) -> None:
    """Leading hits of some runs -> their timing counts, next to those of other runs.

    Repeating a run replaces its counts and leaves the rest as it is.
    """
    write_stage(calibration.drift_counts(leads, cfg, ["runname", "plane"]), out)


@_leaves_no_scratch
def count_asymmetry(events: DataFrame, cfg: StripConfig, out: str) -> None:
    """Strip events of some runs -> their asymmetry counts."""
    write_stage(calibration.asymmetry_counts(events, cfg, ["runname"]), out)


@_leaves_no_scratch
def curves_from_counts(
    counts: DataFrame, label: str, out: str, bins: Bins, runs: list[str] | None = None
) -> None:
    """Counts of all or of the named runs -> one curve per plane, labelled ``label``.

    ``bins`` are those that were counted, ``DRIFT_BINS`` or ``ASYMMETRY_BINS`` as a rule.
    A few hundred rows a run and plane are read, whatever the runs hold.
    """
    if runs is not None:
        counts = counts.where(F.col("runname").isin(*runs))
    found = calibration.curves_of_counts(counts, bins, ["plane"])
    write_curves(found.withColumn("run", F.lit(label)), out)


def run_pending(
    blocks: DataFrame,
    stage: str,
    commits: str,
    job: Callable[[DataFrame], None],
    at_once: int = 16,
) -> list[str]:
    """Put the runs of ``blocks`` that ``stage`` has not committed yet through ``job``.

    ``job`` gets the blocks of up to ``at_once`` runs with their ``runname`` and writes its
    table by run, as the jobs here do. Its runs are committed after that, in one append.
    A job that is lost before leaves runs uncommitted; the next call repeats them, and the
    repetition replaces what was left. Returns the runs it has done; only run labels come
    to the driver.
    """
    spark = blocks.sparkSession
    todo = [r["runname"] for r in pending_runs(blocks, spark, commits, stage).orderBy("runname").collect()]
    for start in range(0, len(todo), at_once):
        runs = todo[start : start + at_once]
        job(blocks.where(F.col("runname").isin(*runs)))
        commit_runs(spark, commits, stage, runs)
    return todo
