"""Detector-shaped views over the star-schema tables.

The tables stand in for the readout: ``events`` for hits and wire boards,
``lineitem`` and ``orders`` for the strip detector. Every view is derived row by
row, so it grows with its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitframe.config import Bins, Box, StripConfig, WireConfig
from hitframe.functions import keyed_uniform
from hitframe.operators import hits as hit_ops
from hitframe.plans import calibration, strip, wire
from hitframe.sources import materialise

HOUR_US = 3_600_000_000
FRAME_EVENTS = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "user_id",
        "value",
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)").alias("us"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def hits(spark: SparkSession, sf_dir: str, frame_us: int = HOUR_US) -> DataFrame:
    """Flat hits: one frame per hour, channel ``k``, trigger = signup."""
    return _timed_events(spark, sf_dir).select(
        "event_id",
        F.expr(f"us div {frame_us}").alias("frame_id"),
        (F.col("us") % frame_us).alias("ticks"),
        F.col("k").alias("ch"),
        F.col("value").alias("charge"),
        "event_type",
        (616 + F.col("user_id") % 3).cast("int").alias("femId"),
        F.expr("k div 25").alias("plane_no"),
        keyed_uniform("event_id").alias("u"),
    )


def strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strip hits of both sides: two per line item, from one scan."""
    side = F.struct
    rows = F.array(
        side(
            F.lit("x").alias("side"),
            F.col("l_linenumber").cast("int").alias("id"),
            (F.col("l_extendedprice") / F.lit(1000.0)).alias("charge"),
        ),
        side(
            F.lit("y").alias("side"),
            (F.col("l_suppkey") % 8).cast("int").alias("id"),
            F.col("l_quantity").alias("charge"),
        ),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame_id"), F.inline(rows), F.col("l_partkey").alias("tie")
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of a channel: lines with flag A lead, all others trail."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame_id"),
        F.col("l_linenumber").alias("ch"),
        F.when(F.col("l_returnflag") == "A", 0).otherwise(1).alias("edge"),
        F.col("l_quantity").alias("timing"),
    )


# --- wire chain -------------------------------------------------------------

# The detector as it is, all twelve planes of it; only the cuts suit the tables.
CHAIN = WireConfig(cuts={"dc31": Box((10, 150), (-60, 60)), "dc32": Box((10, 150), (-60, 55))})
CHAIN_TIME_BINS = Bins(-60.0, 60.0, 120)
CHAIN_CHARGE_BINS = Bins(10.0, 150.0, 140)
CHAIN_BOX = Box((10, 150), (-60, 60))
CHAIN_CURVE_ROWS = len(CHAIN.planes) * CHAIN_TIME_BINS.n


def wire_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested readout blocks, four per event: one of the anode board and one of each wire
    board, with a hit on each of its four planes. An error has blocks of a board nobody
    reads. A weak event has no hits, a strong one a second hit next to each."""
    e = _timed_events(spark, sf_dir)
    frame = F.expr(f"event_id div {FRAME_EVENTS}").alias("hbfNumber")
    tot = F.floor(F.col("value") * F.lit(1024.0) + F.lit(0.5))
    half = F.expr("floor(value * 1024.0D + 0.5D) div 2")
    time = F.col("us") % 65536

    def hit(ch, time, tot):
        return F.struct(ch.cast("int").alias("ch"), time.alias("time"), tot.alias("tot"))

    def block(fem: int, first: list, second: list):
        none = F.filter(F.array(*first), lambda h: F.lit(False))
        data = (
            F.when(F.col("value") < 1, none)
            .when(F.col("value") > 100, F.array(*first, *second))
            .otherwise(F.array(*first))
        )
        read = F.when(F.col("event_type") == "error", 620).otherwise(fem)
        return F.struct(read.alias("femId"), F.struct(F.struct(frame).alias("hbf"), data.alias("data")).alias("decoded"))

    anode = F.when(F.col("k") < 90, 4).otherwise(5)
    blocks = [block(614, [hit(anode, time, tot)], [hit(anode, time + 40, half)])]
    for board in range(3):
        first, second = [], []
        for j in range(4):
            # the wire wanders a little from plane to plane
            wire = (F.col("k") + (F.col("event_id") * (4 * board + j)) % 3) % 16
            at = (F.col("us") + 4099 * j + 9973 * board) % 65536
            first.append(hit(4 * wire + j, at, tot + 512 * j))
            second.append(hit(4 * ((wire + 3) % 16) + j, at + 40, half))
        blocks.append(block(616 + board, first, second))
    return e.select(
        F.col("event_id").alias("tfId"), F.lit(5).alias("femType"), F.inline(F.array(*blocks))
    ).where("tfId > 0")


def wire_map(spark: SparkSession) -> DataFrame:
    """Channel map of the wire chain: 192 rows, the wires of a plane in scrambled order."""
    return spark.range(WIRE_MAP_ROWS).select(
        F.expr("cast(if(id < 128, id div 64 * 64, 0) + id % 4 * 16 + (id % 64 div 4) * 5 % 16 as int)").alias("id"),
        F.expr("cast(616 + id div 64 as int)").alias("femId"),
        F.expr("cast(id % 64 as int)").alias("ch"),
        F.when(F.col("id") < 128, "dc31").otherwise("dc32").alias("detector"),
    )


WIRE_MAP_ROWS = 192


def chain_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = wire_blocks(spark, sf_dir)
    return wire.mapped_hits(
        hit_ops.wire_hits(blocks, CHAIN, "mid"),
        wire.trigger_times(blocks, CHAIN, "mid"),
        wire_map(spark),
        CHAIN,
        WIRE_MAP_ROWS,
    )


def chain_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading hits of complete frames, as a table that the calibration loop reads twice."""
    return materialise(wire.complete_leads(chain_mapped(spark, sf_dir), CHAIN), "complete-leads")


def chain_curves(leads: DataFrame) -> DataFrame:
    return calibration.drift_curves(
        leads, CHAIN, ["plane"], CHAIN_BOX, CHAIN_TIME_BINS, CHAIN_CHARGE_BINS
    )


def chain_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the wire chain with drift lengths from curves of the same data."""
    leads = chain_leads(spark, sf_dir)
    u = keyed_uniform("frame_id")
    return wire.drift_events(leads, chain_curves(leads), CHAIN, CHAIN_CURVE_ROWS, u)


def chain_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire.with_positions(chain_drift(spark, sf_dir), CHAIN)


# --- strip chain ------------------------------------------------------------

STRIP_CHAIN = StripConfig(window=(-50, 300), flip_even_channels=True)
STRIP_CURVE_BINS = Bins(0.0, 1.0, 200)
STRIP_CURVE_ROWS = 2 * STRIP_CURVE_BINS.n
STRIP_MAP_ROWS = 16


def strip_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One strip block per line item with a leading and a trailing edge on an x and
    a y channel, and one trigger block per order that is not pending."""
    lead_x = F.expr("l_partkey % 1000")
    lead_y = F.expr("l_partkey % 900")
    wide_x = F.expr("cast(floor(l_extendedprice) as bigint)")
    wide_y = F.expr("cast(floor(l_quantity * 1000) as bigint)")
    ch_x = F.col("l_linenumber").cast("int")
    ch_y = F.expr("cast(32 + l_suppkey % 4 as int)")

    def edge(ch, time, trailing: int):
        # even channels are wired with the opposite polarity
        seen = F.when(ch % 2 == 0, 1 - trailing).otherwise(trailing)
        return F.struct(ch.alias("ch"), time.alias("time"), seen.cast("long").alias("tot"))

    data = F.array(
        edge(ch_x, lead_x, 0),
        edge(ch_x, lead_x + wide_x, 1),
        edge(ch_y, lead_y, 0),
        edge(ch_y, lead_y + wide_y, 1),
    )

    def block(frame: str, fem_type: int, fem_id: int, hits):
        hbf = F.struct(F.col(frame).alias("hbfNumber")).alias("hbf")
        return [
            (F.col(frame) + 1).alias("tfId"),
            F.lit(fem_type).alias("femType"),
            F.lit(fem_id).alias("femId"),
            F.struct(hbf, hits.alias("data")).alias("decoded"),
        ]

    lines = table(spark, sf_dir, "lineitem").select(*block("l_orderkey", 7, 615, data))
    trigger = F.array(
        F.struct(
            F.lit(4).alias("ch"),
            F.expr("o_custkey % 500").alias("time"),
            F.lit(100).cast("long").alias("tot"),
        )
    )
    triggers = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") != "P")
        .select(*block("o_orderkey", 5, 614, trigger))
    )
    return lines.unionByName(triggers).where("tfId > 0")


def strip_map(spark: SparkSession) -> DataFrame:
    """x channels 0-7 in reversed order, y channels 32-39 in order."""
    return spark.range(STRIP_MAP_ROWS).select(
        F.expr("cast(if(id < 8, 7 - id, id - 8) as int)").alias("id"),
        F.expr("cast(if(id < 8, id, id + 24) as int)").alias("ch"),
        F.expr("if(id < 8, 'x', 'y')").alias("side"),
    )


def strip_chain_edges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Timed edges, and the triggers that they were timed with."""
    blocks = strip_blocks(spark, sf_dir)
    triggers = strip.trigger_times(blocks, STRIP_CHAIN, "mid")
    edges = hit_ops.strip_edges(blocks, STRIP_CHAIN, "mid")
    return strip.timed_edges(edges, triggers, STRIP_CHAIN), triggers


def strip_chain_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every strip hit with its rank."""
    timed, _ = strip_chain_edges(spark, sf_dir)
    return strip.hit_lists(timed, strip_map(spark), STRIP_CHAIN, STRIP_MAP_ROWS)


def strip_chain_with_triggers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Strip events as a stage table, and the triggers that they were built with."""
    timed, triggers = strip_chain_edges(spark, sf_dir)
    slots = strip.side_slots(timed, strip_map(spark), STRIP_CHAIN, STRIP_MAP_ROWS)
    return materialise(strip.side_by_side(slots, STRIP_CHAIN), "strip-events"), triggers


def strip_chain_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strip events as a stage table, as the calibration loop reads them twice."""
    return strip_chain_with_triggers(spark, sf_dir)[0]


def strip_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gain and offset per strip: positive, negative, zero, and none for two of them."""
    key = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation")
        .where((key < STRIP_MAP_ROWS) & ~key.isin(5, 14))
        .select(
            F.when(key < 8, "x").otherwise("y").alias("side"),
            (key % 8).cast("int").alias("id"),
            F.element_at(F.array(*[F.lit(g) for g in (1.25, -0.75, 0.5, 0.0)]), (key % 4 + 1).cast("int")).alias("p1"),
            (key * F.lit(0.5) + F.lit(3.0)).alias("p0"),
        )
    )


def strip_chain_positions(spark: SparkSession, sf_dir: str, cfg: StripConfig = STRIP_CHAIN) -> DataFrame:
    wide = strip_chain_events(spark, sf_dir)
    curves = calibration.asymmetry_curves(wide, cfg, [], STRIP_CURVE_BINS)
    return strip.positions(wide, curves, cfg, STRIP_CURVE_ROWS, keyed_uniform("frame_id"))
