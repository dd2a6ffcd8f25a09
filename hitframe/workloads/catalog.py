"""Registered queries: every operator on the whole of its tables.

Counts and ids are cast to BIGINT and aggregated doubles are rounded, so that the
results compare value by value with the SQL in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitframe import session
from hitframe.config import ANODE_MODULE, RESIDUAL_PAIRS, TICK_NS, WIRE_MODULE, Bins, Box
from hitframe.functions import (
    asymmetry,
    flip_even_channels,
    in_box,
    inside,
    keyed_uniform,
    linear,
    ticks_to_ns,
)
from hitframe.operators import curves, edges, frames, histograms, hits, quality, statistics
from hitframe.plans import calibration, combine, strip, wire
from hitframe.sources import (
    preview,
    read_curves,
    read_linear_calibration,
    read_mode_table,
    read_stage,
    read_strip_map,
    union_runs,
    write_bucketed,
    write_curves,
    write_mode_table,
    write_stage,
)

from . import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PLANES = (0, 1, 2, 3)
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
CHARGE = (10.0, 150.0)
WINDOW_NS = (-1_000_000.0, 1_500_000.0)
CHARGE_BINS = Bins(0.0, 150.0, 75)
TIME_BINS = Bins(0.0, 3_600_000.0, 60)
CURVE_BINS = Bins(10.0, 150.0, 100)
STRIP_CHARGE_BINS = Bins(0.0, 120.0, 60)
CURVE_ROWS = len(PLANES) * CURVE_BINS.n
SLOTS = {"id": 3, "charge": 3}
QUANTILES = (0.25, 0.5, 0.75, 0.99)
PEAK_BINS = Bins(-100.0, 100.0, 50)
# hours of a run, and the charge that calls for a calibration
RUN_FRAMES, STRONG = 24, 220.0
CORRELATION_PAIRS = tuple((p.first, p.second) for p in V.CHAIN.pairs)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(session.tune(spark), sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def big(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def r6(c: Column | str) -> Column:
    """Six digits, without a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.abs(c) < 5e-7, F.lit(0.0)).otherwise(F.round(c, 6))


# --- scans, hits ------------------------------------------------------------


@query
def hit_routing_explode(spark, sf):
    """Nested blocks -> module filter -> one row per hit; anode keeps channel 4."""
    anode, wires = hits.of_module(ANODE_MODULE), hits.of_module(WIRE_MODULE)
    flat = hits.explode_hits(V.wire_blocks(spark, sf).where(anode | wires), "femType", "femId")
    return flat.where(wires | (F.col("ch") == 4)).select(
        "frame_id", *big("femId", "ch"), F.col("time").alias("ticks"), "tot"
    )


@query
def tick_calibration(spark, sf):
    h = V.hits(spark, sf)
    tot = F.floor(F.col("charge") * F.lit(100.0) + F.lit(0.5))
    return h.select(
        "event_id",
        ticks_to_ns("ticks", "u", TICK_NS).alias("tcal"),
        ticks_to_ns(tot, keyed_uniform("event_id", 1), TICK_NS).alias("charge_ns"),
        linear("charge", F.lit(0.5), F.lit(2.0)).alias("charge_lin"),
    )


def _trigger_hits(h: DataFrame) -> DataFrame:
    return h.where(F.col("event_type") == "signup").select(
        "frame_id", ticks_to_ns("ticks", "u", TICK_NS).alias("tcal"), F.col("ticks").alias("tdc_raw")
    )


def _wire_like_hits(h: DataFrame) -> DataFrame:
    return h.where(F.col("event_type") != "signup").withColumn(
        "tcal", ticks_to_ns("ticks", "u", TICK_NS)
    )


@query
def first_trigger_min(spark, sf):
    return hits.earliest_time(_trigger_hits(V.hits(spark, sf)))


@query
def first_trigger_row(spark, sf):
    return hits.earliest_row(_trigger_hits(V.hits(spark, sf)), "tcal", ["tdc_raw"]).select(
        "frame_id", F.col("tcal").alias("sra_timing"), F.col("tdc_raw").alias("sra_tdc_raw")
    )


def _timed(spark, sf) -> DataFrame:
    h = V.hits(spark, sf)
    t0 = hits.staged_time_zero(hits.earliest_time(_trigger_hits(h)))
    return hits.subtract_time_zero(_wire_like_hits(h), t0)


@query
def time_zero_window(spark, sf):
    cut = inside("timing", WINDOW_NS) & inside("charge", CHARGE)
    return _timed(spark, sf).where(cut).select("event_id", "frame_id", "timing", "charge")


@query
def channel_map_join(spark, sf):
    """Composite-key map of all three boards; plane and local id come from the map side.

    Four of 100 channels of a board are not in it.
    """
    chmap = spark.range(288).select(
        F.expr("cast(id as int)").alias("id"),
        F.expr("cast(616 + id div 96 as int)").alias("femId"),
        F.expr("cast(id % 96 as int)").alias("ch"),
    )
    planes = chmap.withColumn("plane_no", F.expr("id div 16")).withColumn("id", F.col("id") % 16)
    mapped = hits.map_channels(V.hits(spark, sf).drop("plane_no"), planes, ["femId", "ch"], 288)
    return mapped.select("event_id", *big("plane_no", "id"), "charge")


@query
def side_map_join(spark, sf):
    """Single-key map with one table for both sides; ten of 100 channels are not in it."""
    sides = spark.range(90).select(
        F.col("id").cast("int").alias("ch"),
        F.expr("if(id < 45, 'x', 'y')").alias("side"),
        F.expr("cast(if(id < 45, 44 - id, id - 45) as int)").alias("id"),
    )
    mapped = hits.map_channels(V.hits(spark, sf), sides, ["ch"], 90)
    return mapped.select("event_id", "side", *big("id"), "charge")


@query
def polarity_flip(spark, sf):
    e = V.edges(spark, sf).withColumn("flipped", flip_even_channels("edge", "ch"))
    return e.groupBy("ch", "edge", "flipped").agg(F.count(F.lit(1)).alias("n")).select(
        *big("ch", "edge", "flipped", "n")
    )


@query
def linear_calibration(spark, sf):
    """Left join of per-channel constants; channels without any give null."""
    calib = V.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"),
        (F.lit(1.0) + F.col("n_nationkey") * F.lit(0.01)).alias("p1"),
        (F.col("n_nationkey") * F.lit(0.5)).alias("p0"),
    )
    h = V.hits(spark, sf).select("event_id", F.col("ch").alias("id"), "charge")
    return hits.linear_calibration(h, calib, ["id"]).select("event_id", "charge")


# --- edges ------------------------------------------------------------------


@query
def edge_pairing(spark, sf):
    """All leading x trailing pairs of a channel, as number and widths."""
    out = edges.pair_summary(V.edges(spark, sf), ["frame_id", "ch"])
    widths = [r6(c).alias(c) for c in ("width_min", "width_max", "width_sum")]
    return out.select("frame_id", *big("ch", "n_pairs"), *widths)


@query
def edge_pair_slots(spark, sf):
    """The three widest pairs of each frame."""
    pairs = edges.widest_pairs(V.edges(spark, sf), ["frame_id", "ch"], 3)
    order = frames.by_charge("charge", "ch", "timing")
    top = frames.top_hits(pairs, ["frame_id"], order, 3)
    return top.select("frame_id", *big("rank", "ch"), "timing", "charge")


# --- frames -----------------------------------------------------------------

_STRIP_ORDER = ("charge", "id", "tie")


def _strip_slots(spark, sf) -> DataFrame:
    s = V.strips(spark, sf)
    return frames.hit_slots(s, ["frame_id", "side"], frames.by_charge(*_STRIP_ORDER), SLOTS)


def _strip_events(spark, sf) -> DataFrame:
    return strip.side_by_side(_strip_slots(spark, sf), V.STRIP_CHAIN)


@query
def ordered_hit_slots(spark, sf):
    return _strip_slots(spark, sf).select(
        "frame_id", "side", *big("size", "id0", "id1", "id2"), "charge0", "charge1", "charge2"
    )


@query
def nearest_pairs(spark, sf):
    """Each leading edge with the first trailing edge after it."""
    out = edges.nearest_pairs(V.edges(spark, sf), ["frame_id", "ch"])
    return out.select("frame_id", *big("ch"), "timing", "timing_trail", "charge")


@query
def strip_hit_lists(spark, sf):
    """All strip hits of triggered frames per side, in charge order."""
    out = V.strip_chain_hits(spark, sf)
    return out.select("frame_id", "side", *big("rank", "id"), "timing", r6("charge").alias("charge"))


@query
def strip_occupancy(spark, sf):
    """Strip id against charge of every hit, per side."""
    out = calibration.occupancy(V.strip_chain_hits(spark, sf), ["side"], Bins(-0.5, 7.5, 8), STRIP_CHARGE_BINS)
    return out.select("side", *big("bin_x", "bin_y", "n"))


@query
def map_and_calibration_files(spark, sf):
    """A side map and constants as padded CSV files, read back and applied to the hits."""
    folder = session.scratch_path(spark, "maps")
    padded = lambda c: F.format_string(" %s  ", F.col(c))
    n = V.table(spark, sf, "nation").select(F.col("n_nationkey").alias("ch"), (24 - F.col("n_nationkey")).alias("id"))
    constants = n.select("id", (1 + F.col("id") * F.lit(0.01)).alias("p1"), (F.col("id") * F.lit(0.5)).alias("p0"))
    for name, df in (("map", n.select("id", "ch")), ("calib", constants)):
        df.select(*[padded(c).alias(c) for c in df.columns]).write.option("header", True).csv(f"{folder}/{name}")
    chmap = read_strip_map(spark, {"x": f"{folder}/map"})
    calib = read_linear_calibration(spark, {"x": f"{folder}/calib"})
    mapped = hits.map_channels(V.hits(spark, sf).select("event_id", "ch", "charge"), chmap, ["ch"])
    out = hits.linear_calibration(mapped, calib, ["side", "id"])
    return out.select("event_id", *big("id"), "side", r6("charge").alias("charge"))


@query
def ordered_hits(spark, sf):
    """The whole charge-ordered list of every frame and side, with ranks."""
    out = frames.ranked_hits(
        V.strips(spark, sf), ["frame_id", "side"], frames.by_charge(*_STRIP_ORDER)
    )
    return out.select("frame_id", "side", *big("rank", "id"), "charge", "tie")


def _plane_leads(spark, sf) -> DataFrame:
    h = V.hits(spark, sf)
    first = hits.earliest_row(_trigger_hits(h), "tcal", ["tdc_raw"])
    t0 = hits.staged_time_zero(first.withColumnRenamed("tcal", "t0"))
    timed = hits.subtract_time_zero(_wire_like_hits(h), t0)
    cut = timed.where(inside("charge", CHARGE)).select(
        "frame_id",
        F.concat(F.lit("p"), F.col("plane_no")).alias("plane"),
        (F.col("ch") % 25).alias("id"),
        "charge",
        "timing",
        "tdc_raw",
    )
    return frames.leading_hit(
        cut, ["frame_id", "plane"], ["id", "charge", "timing", "tdc_raw"], ["id", "timing"]
    )


@query
def plane_coincidence(spark, sf):
    """Frames in which all four planes have a hit, with the leading hit of each."""
    values = ["size", "id0", "charge0", "timing0"]
    wide = frames.one_row_per_frame(
        _plane_leads(spark, sf), "plane", [f"p{i}" for i in PLANES], values, "{member}_{value}",
        carry=("tdc_raw0",), require_all=True,
    )
    ints = [f"p{i}_{v}" for i in PLANES for v in ("size", "id0")]
    rest = [f"p{i}_{v}" for i in PLANES for v in ("charge0", "timing0")]
    return wide.select("frame_id", *big(*ints), *rest, F.col("tdc_raw0").alias("tdc_raw"))


@query
def coincident_hit_lists(spark, sf):
    """All hits of the events of the wire chain with their rank."""
    blocks = V.wire_blocks(spark, sf)
    raw = hits.wire_hits(blocks, V.CHAIN, "mid")
    triggers = wire.trigger_times(blocks, V.CHAIN, "mid")
    out = wire.event_hits(raw, triggers, V.wire_map(spark), V.CHAIN, V.WIRE_MAP_ROWS)
    return out.select("frame_id", "plane", *big("rank", "id"), "charge", "timing")


@query
def two_side_outer(spark, sf):
    """Full outer join of the sides; each side may be missing."""
    s = V.strips(spark, sf)
    floor = F.when(F.col("side") == "x", 50.0).otherwise(30.0)
    slots = frames.hit_slots(
        s.where(F.col("charge") > floor),
        ["frame_id", "side"],
        frames.by_charge(*_STRIP_ORDER),
        {"id": 2, "charge": 2},
    )
    wide = strip.side_by_side(slots, V.STRIP_CHAIN)
    ints = [f"{c}_{s}" for s in ("x", "y") for c in ("size", "id0", "id1")]
    return wide.select("frame_id", *big(*ints), "charge0_x", "charge0_y", "q0q1_x", "q0q1_y")


@query
def cluster_cuts(spark, sf):
    """Each cut as a flag; an undecided cut does not pass."""
    cuts = {
        "multiplicity": frames.multiplicity_cut(7),
        "neighbour": frames.neighbour_cut(),
        "cluster": frames.cluster_cut(),
    }
    flags = [F.coalesce(c.cast("bigint"), F.lit(0)).alias(n) for n, c in cuts.items()]
    return _strip_events(spark, sf).select("frame_id", *flags)


@query
def charge_asymmetry(spark, sf):
    """Strip hits -> slots -> cuts -> charge asymmetry of both sides."""
    wide = strip.adjacent_events(_strip_events(spark, sf), V.STRIP_CHAIN)
    return wide.select("frame_id", *big("id0_x", "id1_x", "id0_y", "id1_y"), "q0q1_x", "q0q1_y")


@query
def strip_chain_slots(spark, sf):
    """Strip readout blocks -> edges -> pairs -> slots of both sides."""
    wide = V.strip_chain_events(spark, sf)
    ints = [f"{c}_{s}" for s in ("x", "y") for c in ("size", "id0", "id1", "id2")]
    rest = [f"{c}_{s}" for s in ("x", "y") for c in ("timing0", "charge0", "charge1", "charge2")]
    return wide.select("frame_id", *big(*ints), *rest)


@query
def strip_chain_slots_gain(spark, sf):
    """The same with charges put through gains of either sign before they are ordered."""
    timed, _ = V.strip_chain_edges(spark, sf)
    slots = strip.side_slots(
        timed, V.strip_map(spark), V.STRIP_CHAIN, V.STRIP_MAP_ROWS, V.strip_gains(spark, sf)
    )
    wide = strip.side_by_side(slots, V.STRIP_CHAIN)
    ints = [f"{c}_{s}" for s in ("x", "y") for c in ("size", "id0", "id1", "id2")]
    rest = [f"{c}_{s}" for s in ("x", "y") for c in ("timing0", "charge0", "charge1", "charge2")]
    return wide.select("frame_id", *big(*ints), *rest)


@query
def pair_widths(spark, sf):
    """Widths of all leading x trailing pairs per channel, from counts of time cells."""
    out = edges.width_counts(V.edges(spark, sf), ["frame_id", "ch"], ["ch"], 1.0)
    return out.select(*big("ch"), "width", *big("n"))


@query
def strip_pair_occupancy(spark, sf):
    """Strip id against the charge of every pair, on the grid of the clock."""
    timed, _ = V.strip_chain_edges(spark, sf)
    out = strip.pair_occupancy(
        timed, V.strip_map(spark), V.STRIP_CHAIN, STRIP_CHARGE_BINS, TICK_NS, V.STRIP_MAP_ROWS
    )
    return out.select("side", *big("id", "bin", "n"))


@query
def default_dither(spark, sf):
    """Hits with the dither that jobs use: the tick and width it was drawn into come back."""
    raw = hits.wire_hits(V.wire_blocks(spark, sf), V.CHAIN)
    whole = [F.floor(F.col(c) / F.lit(TICK_NS)).alias(n) for c, n in (("tcal", "ticks"), ("charge", "tot"))]
    return raw.select("frame_id", *big("femId", "ch"), *whole)


# --- histograms -------------------------------------------------------------


@query
def hist1d(spark, sf):
    out = histograms.hist1d(V.hits(spark, sf), "charge", CHARGE_BINS, ["plane_no"])
    return out.select(*big("plane_no", "bin", "n"))


def _grid(spark, sf) -> DataFrame:
    h = V.hits(spark, sf).withColumn("tcal", ticks_to_ns("ticks", "u", TICK_NS))
    return histograms.hist2d(h, "tcal", TIME_BINS, "charge", CHARGE_BINS, ["plane_no"])


@query
def hist2d(spark, sf):
    return _grid(spark, sf).select(*big("plane_no", "bin_x", "bin_y", "n"))


@query
def hist2d_arrays(spark, sf):
    """Two parallel array columns, zipped element by element."""
    lists = V.table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.array(F.col("l_linenumber").cast("double"), (F.col("l_suppkey") % 8).cast("double")).alias(
            "ids"
        ),
        F.array(F.col("l_extendedprice") / F.lit(1000.0), F.col("l_quantity")).alias("charges"),
    )
    out = histograms.hist2d_arrays(
        lists, "ids", Bins(-0.5, 8.5, 9), "charges", Bins(0.0, 100.0, 50), ["l_returnflag"]
    )
    return out.select("l_returnflag", *big("bin_x", "bin_y", "n"))


@query
def projection_x(spark, sf):
    return histograms.project_x(_grid(spark, sf), ["plane_no"]).select(*big("plane_no", "bin", "n"))


@query
def projection_y_slice(spark, sf):
    out = histograms.project_y(_grid(spark, sf), 10, 29, ["plane_no"])
    return out.select(*big("plane_no", "bin", "n"))


@query
def mode_bin(spark, sf):
    counts = histograms.hist1d(V.hits(spark, sf), "charge", CHARGE_BINS, ["ch"], dense=False)
    return histograms.mode_bin(counts, ["ch"]).select(*big("ch", "mode_bin", "n"))


def _pulser_hits(spark, sf) -> DataFrame:
    """One run per event type, its channels folded to the 32 strips."""
    h = V.hits(spark, sf)
    return union_runs(
        {
            t: h.where(F.col("event_type") == t).select((F.col("ch") % 32).alias("id"), "charge")
            for t in EVENT_TYPES
        }
    )


@query
def pulser_calibration(spark, sf):
    """Union of runs -> id x charge -> most frequent charge bin per id and run."""
    return calibration.pulser_modes(_pulser_hits(spark, sf), ["runname"]).select(
        "runname", *big("id", "mode_bin")
    )


@query
def strip_pulser_calibration(spark, sf):
    """Strip hit lists of three runs -> most frequent charge bin per run, side and strip."""
    lists = V.strip_chain_hits(spark, sf)
    runs = {f"run{i}": lists.where(F.col("frame_id") % 3 == i).select("side", "id", "charge") for i in range(3)}
    out = calibration.pulser_modes(union_runs(runs), ["runname", "side"], n_ids=8)
    return out.select("runname", "side", *big("id", "mode_bin"))


@query
def pulser_occupancy(spark, sf):
    """Mapped hits of the wire chain before time zero and cuts."""
    raw = hits.wire_hits(V.wire_blocks(spark, sf), V.CHAIN, "mid")
    mapped = hits.map_channels(raw, V.wire_map(spark), ["femId", "ch"], V.WIRE_MAP_ROWS)
    out = calibration.occupancy(mapped, ["detector"], Bins(-0.5, 127.5, 128), Bins(0.0, 200.0, 100))
    return out.select("detector", *big("bin_x", "bin_y", "n"))


@query
def plane_correlation(spark, sf):
    """Frames with a single hit on both planes: wire against wire."""
    cells = Bins(-0.5, 15.5, 16)
    wide = wire.events(V.chain_leads(spark, sf), V.CHAIN, ["size", "id0"])
    rows = [
        F.struct(
            F.lit(f"{a}-{b}").alias("pair"),
            F.col(f"{a}_id0").alias("a"),
            F.col(f"{b}_id0").alias("b"),
            ((F.col(f"{a}_size") == 1) & (F.col(f"{b}_size") == 1)).alias("single"),
        )
        for a, b in CORRELATION_PAIRS
    ]
    long = wide.select(F.inline(F.array(*rows))).where("single")
    return histograms.hist2d(long, "a", cells, "b", cells, ["pair"]).select("pair", *big("bin_x", "bin_y", "n"))


@query
def edge_veto_box(spark, sf):
    """Leading hits away from the edge wires and inside a tighter box."""
    leads = V.chain_leads(spark, sf)
    cut = frames.edge_wire_veto(V.CHAIN.wires_per_plane - 1) & in_box("charge0", "timing0", Box((30, 120), (-40, 40)))
    return leads.where(cut).select("frame_id", "plane", *big("id0"), "charge0", "timing0")


# --- curves -----------------------------------------------------------------


def _charge_curves(spark, sf) -> DataFrame:
    h = V.hits(spark, sf)
    counts = histograms.hist1d(h, "charge", CURVE_BINS, ["plane_no"])
    return curves.cdf_curve(counts, CURVE_BINS, ["plane_no"])


@query
def cdf_curve(spark, sf):
    return _charge_curves(spark, sf).select(*big("plane_no", "bin"), "x", "tx")


@query
def interval_table(spark, sf):
    out = curves.curve_intervals(_charge_curves(spark, sf), ["plane_no"])
    return out.select(*big("plane_no"), "lo", "hi", "tx_lo", "tx_hi")


@query
def interval_lookup(spark, sf):
    h = V.hits(spark, sf).select("event_id", "plane_no", "charge", "u")
    out = curves.curve_lookup(
        h, _charge_curves(spark, sf), ["plane_no"], "charge", F.col("u"), 1.5, "dl", CURVE_ROWS, True
    )
    return out.select("event_id", *big("plane_no"), "charge", "dl")


@query
def interval_lookup_exact(spark, sf):
    """The exact fraction of the curve interval instead of a dithered one."""
    h = V.hits(spark, sf).select("event_id", "plane_no", "charge")
    out = curves.curve_lookup(
        h, _charge_curves(spark, sf), ["plane_no"], "charge", None, 1.5, "dl", CURVE_ROWS, True
    )
    return out.select("event_id", *big("plane_no"), "charge", r6("dl").alias("dl"))


def _run_hits(spark, sf) -> DataFrame:
    """A run is a day."""
    return V.hits(spark, sf).withColumn("run_no", F.expr(f"frame_id div {RUN_FRAMES}"))


def _calibrations(spark, sf) -> DataFrame:
    """A plane is calibrated in a run with a strong purchase; several of a run are versions."""
    strong = (F.col("event_type") == "purchase") & (F.col("charge") > STRONG)
    return _run_hits(spark, sf).where(strong).select("plane_no", "run_no", F.col("ch").alias("version"))


@query
def calibration_in_force(spark, sf):
    """Which calibration serves each run and plane: the latest one up to it."""
    out = curves.curves_in_force(_run_hits(spark, sf), _calibrations(spark, sf), ["plane_no"])
    return out.select(*big("plane_no", "run_no", "curve_no", "curve_version"))


@query
def lookup_in_force(spark, sf):
    """Hits of every run looked up in the curves of the calibration run that serves it."""
    h, taken = _run_hits(spark, sf), _calibrations(spark, sf)
    counts = histograms.hist1d(h.join(taken, ["plane_no", "run_no"], "left_semi"), "charge", CURVE_BINS, ["plane_no", "run_no"])
    found = curves.cdf_curve(counts, CURVE_BINS, ["plane_no", "run_no"]).withColumnRenamed("run_no", "curve_no")
    served = curves.curves_in_force(h, taken, ["plane_no"])
    known = h.join(served, ["plane_no", "run_no"])
    out = curves.curve_lookup(known, found, ["plane_no", "curve_no"], "charge", F.col("u"), 1.5, "dl")
    return out.select("event_id", *big("plane_no", "curve_no"), "charge", "dl")


@query
def drift_calibration_by_parts(spark, sf):
    """Counts of two runs written one after the other, then the curves of their sums."""
    leads, path = V.chain_leads(spark, sf), session.scratch_path(spark, "drift-counts")
    for part, run in ((F.col("frame_id") % 2 == 0, "even"), (F.col("frame_id") % 2 == 1, "odd")):
        counted = calibration.drift_counts(
            leads.where(part), V.CHAIN, ["plane"], V.CHAIN_BOX, V.CHAIN_TIME_BINS, V.CHAIN_CHARGE_BINS
        )
        write_stage(counted, path, run)
    out = calibration.curves_of_counts(read_stage(spark, path), V.CHAIN_TIME_BINS, ["plane"])
    return out.select("plane", *big("bin"), "x", "tx")


@query
def drift_calibration(spark, sf):
    return V.chain_curves(V.chain_leads(spark, sf)).select("plane", *big("bin"), "x", "tx")


@query
def asymmetry_calibration(spark, sf):
    wide = V.strip_chain_events(spark, sf)
    out = calibration.asymmetry_curves(wide, V.STRIP_CHAIN, [], V.STRIP_CURVE_BINS)
    return out.select("plane", *big("bin"), "x", "tx")


# --- positions --------------------------------------------------------------


@query
def drift_length(spark, sf):
    leads = V.chain_leads(spark, sf)
    u = keyed_uniform("frame_id")
    out = wire.drift_lengths(leads, V.chain_curves(leads), V.CHAIN, V.CHAIN_CURVE_ROWS, u)
    return out.select("frame_id", "plane", *big("id0"), "timing0", "dl")


@query
def left_right_resolution(spark, sf):
    cols = [f"{p}_posi" for p in V.CHAIN.planes]
    return V.chain_positions(spark, sf).select("frame_id", *cols)


@query
def plane_average(spark, sf):
    return V.chain_positions(spark, sf).select("frame_id", *V.CHAIN.views)


@query
def track_extrapolation(spark, sf):
    return wire.target_table(V.chain_positions(spark, sf), V.CHAIN)


@query
def shift_check(spark, sf):
    out = wire.shift_check(V.chain_drift(spark, sf), V.CHAIN)
    return out.select("frame_id", "pair", F.col("same_wire").cast("bigint").alias("same_wire"), "dl1", "dl2")


@query
def strip_position(spark, sf):
    return V.strip_chain_positions(spark, sf).select(
        "frame_id", "sr_pos_x", "sr_ins_x", "sr_pos_y", "sr_ins_y"
    )


@query
def strip_position_mirrored(spark, sf):
    """The inset turned round, so that it points the way positions do."""
    return V.strip_chain_positions(spark, sf, replace(V.STRIP_CHAIN, mirror_fix=True)).select(
        "frame_id", "sr_pos_x", "sr_ins_x", "sr_pos_y", "sr_ins_y"
    )


# --- both detectors, quality ------------------------------------------------


def _joined(spark, sf) -> DataFrame:
    return combine.join_detectors(V.strip_chain_positions(spark, sf), V.chain_positions(spark, sf))


@query
def detector_join(spark, sf):
    return _joined(spark, sf)


@query
def bucketed_join(spark, sf):
    """Both stages written in buckets of the frame, joined without moving a row."""
    buckets = 8
    stages = []
    for name, df in (("strips", V.strip_chain_positions(spark, sf)), ("wires", V.chain_positions(spark, sf))):
        stages.append(write_bucketed(df, session.scratch_path(spark, f"bucketed-{name}"), ["frame_id"], buckets))
    return combine.join_detectors(*stages)


@query
def detector_residuals(spark, sf):
    return combine.detector_residuals(_joined(spark, sf), V.CHAIN)


@query
def plane_residuals(spark, sf):
    """Histogram of plane-to-plane differences per pair."""
    long = quality.residual_columns(V.chain_positions(spark, sf), RESIDUAL_PAIRS)
    return histograms.hist1d(long, "diff", Bins(-5.0, 5.0, 50), ["pair"]).select("pair", *big("bin", "n"))


@query
def efficiency(spark, sf):
    out = quality.efficiency(*V.strip_chain_with_triggers(spark, sf))
    return out.select(*big("n_triggers", "n_clusters"), r6("efficiency").alias("efficiency"))


@query
def efficiency_by_run(spark, sf):
    """One efficiency per run; a run is a third of the frames."""
    run = (F.col("frame_id") % 3).alias("run")
    events, triggers = V.strip_chain_with_triggers(spark, sf)
    out = quality.efficiency(events.select("*", run), triggers.select("*", run), ("run",))
    return out.select(*big("run", "n_triggers", "n_clusters"), r6("efficiency").alias("efficiency"))


@query
def slot_efficiency_by_run(spark, sf):
    events = _strip_events(spark, sf).withColumn("run", F.col("frame_id") % 3)
    out = quality.slot_efficiency(events, groups=("run",))
    return out.select("side", *big("run", "n0", "n2"), r6("efficiency").alias("efficiency"))


@query
def slot_efficiency(spark, sf):
    out = quality.slot_efficiency(_strip_events(spark, sf))
    return out.select("side", *big("n0", "n2"), r6("efficiency").alias("efficiency"))


@query
def resolution(spark, sf):
    out = quality.resolution(V.chain_positions(spark, sf), V.CHAIN.views)
    return out.select(
        "view",
        *big("n_all"),
        F.round("resolution_um", 4).alias("resolution_um"),
        F.round("resolution_accepted_um", 4).alias("resolution_accepted_um"),
    )


@query
def resolution_by_run(spark, sf):
    positions = V.chain_positions(spark, sf).withColumn("run", F.col("frame_id") % 3)
    out = quality.resolution(positions, V.CHAIN.views, groups=("run",))
    return out.select(
        "view",
        *big("run", "n_all"),
        F.round("resolution_um", 4).alias("resolution_um"),
        F.round("resolution_accepted_um", 4).alias("resolution_accepted_um"),
    )


@query
def residual_summary(spark, sf):
    long = quality.residual_columns(V.chain_positions(spark, sf), RESIDUAL_PAIRS)
    out = quality.residual_summary(long, "diff", ["pair"], (-10.0, 10.0))
    rounded = [r6(c).alias(c) for c in ("centre", "width", "median", "quartile_width")]
    return out.select("pair", *big("n"), *rounded)


@query
def exact_quantiles(spark, sf):
    """Quartiles and the 99th percentile of prices per flag, tens of thousands of values each."""
    lines = V.table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    out = statistics.exact_quantiles(lines, "l_extendedprice", ["l_returnflag"], QUANTILES)
    return out.select("l_returnflag", *[r6(f"q{i}").alias(f"q{i}") for i in range(len(QUANTILES))])


def _spreads(spark, sf) -> DataFrame:
    """Sums of even spreads, whose distribution has a peak."""
    spread = "l_quantity + l_partkey % 50 + l_suppkey % 50 + l_orderkey % 50 - 100"
    return V.table(spark, sf, "lineitem").select("l_returnflag", F.expr(f"cast({spread} as double)").alias("diff"))


@query
def peak_fit(spark, sf):
    """Gaussian core of a distribution per group: centre, width and height of the fit."""
    out = quality.residual_peaks(_spreads(spark, sf), "diff", ["l_returnflag"], PEAK_BINS)
    return out.select("l_returnflag", *big("n"), *[r6(c).alias(c) for c in ("height", "centre", "width")])


# --- sinks ------------------------------------------------------------------


@query
def stage_roundtrip(spark, sf):
    """Write strip events by run, read them back."""
    path = session.scratch_path(spark, "stage")
    runs = F.concat(F.lit("run"), F.col("frame_id") % 3)
    write_stage(_strip_events(spark, sf).withColumn("runname", runs), path)
    back = read_stage(spark, path)
    return back.select("frame_id", "runname", *big("size_x", "size_y", "id0_x", "id0_y"), "q0q1_x")


@query
def curve_roundtrip(spark, sf):
    """Write all curves as CSV by run and plane, read them back."""
    path = session.scratch_path(spark, "curves")
    out = _charge_curves(spark, sf).select(
        F.lit("run1").alias("run"), F.concat(F.lit("p"), F.col("plane_no")).alias("plane"), "x", "tx"
    )
    write_curves(out, path)
    return read_curves(spark, path).select("run", "plane", "x", "tx")


@query
def mode_table_roundtrip(spark, sf):
    """Write the pulser modes as CSV by setting and pulse, read them back."""
    path = session.scratch_path(spark, "modes")
    modes = calibration.pulser_modes(_pulser_hits(spark, sf), ["runname"]).select(
        "id", "mode_bin", F.col("runname").alias("setting"), F.lit(0.27).alias("pulse_pc")
    )
    write_mode_table(modes, path)
    return read_mode_table(spark, path).select(*big("id", "mode_bin"), "setting", "pulse_pc")


@query
def hit_preview(spark, sf):
    """First rows for inspection, made repeatable by an order."""
    h = V.hits(spark, sf).select("event_id", "frame_id", *big("ch"), "charge")
    return preview(h.orderBy("event_id"), 20)
