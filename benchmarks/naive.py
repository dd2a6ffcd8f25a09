"""Plain SQL for some operators, as a baseline for the plans in use.

The same results from the shape one writes first: every list is ranked in a window
over its frame, every plane or side is a subquery of its own, and all of them meet in
joins. Inputs that are not what is compared (curves, views) are built by the package.
"""

from functools import cache

from hitframe.operators import curves, hits
from hitframe.plans import strip
from hitframe.sources import materialise
from hitframe.workloads import catalog as K
from hitframe.workloads import views as V


def _sql(spark, text, **views):
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def _first(table, member, columns, by):
    """The leading row of one plane or side, with columns named after it."""
    cells = ", ".join(f"{c} AS {member}_{c}" for c in columns)
    return f"(SELECT frame_id, {cells} FROM {table} WHERE {by} = '{member}' AND rn = 1) {member}"


def plane_coincidence(spark, sf):
    h = V.hits(spark, sf)
    planes = [f"p{i}" for i in K.PLANES]
    sides = " JOIN ".join(
        _first("ranked", p, ("id", "charge", "timing", "size"), "plane") + (" USING (frame_id)" if p != "p0" else "")
        for p in planes
    )
    return _sql(
        spark,
        f"""WITH zero AS (
            SELECT frame_id, tcal AS t0, tdc_raw FROM (
              SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY tcal, tdc_raw) AS rn FROM naive_triggers)
            WHERE rn = 1),
        cut AS (
            SELECT frame_id, concat('p', plane_no) AS plane, ch % 25 AS id, charge, tcal - t0 AS timing, tdc_raw
            FROM naive_hits JOIN zero USING (frame_id) WHERE charge > 10 AND charge < 150),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY frame_id, plane ORDER BY charge DESC, id, timing) AS rn,
              count(*) OVER (PARTITION BY frame_id, plane) AS size FROM cut)
        SELECT * FROM {sides} JOIN (SELECT frame_id, tdc_raw FROM zero) USING (frame_id)""",
        naive_triggers=K._trigger_hits(h),
        naive_hits=K._wire_like_hits(h).drop("tdc_raw"),
    )


def interval_lookup(spark, sf):
    return _sql(
        spark,
        """SELECT event_id, h.plane_no, charge, (tx_lo + (tx_hi - tx_lo) * u) * 1.5D AS dl
        FROM naive_hits h LEFT JOIN naive_steps s
        ON h.plane_no = s.plane_no AND charge >= lo AND charge < hi""",
        naive_hits=V.hits(spark, sf),
        naive_steps=curves.curve_intervals(K._charge_curves(spark, sf), ["plane_no"]),
    )


def _slots(table, keys, slots):
    cells = ", ".join(
        f"max(CASE WHEN rn = {i + 1} THEN {c} END) AS {c}{i}" for c, k in slots.items() for i in range(k)
    )
    return f"SELECT {keys}, max(n) AS size, {cells} FROM {table} GROUP BY {keys}"


def ordered_hit_slots(spark, sf):
    return _sql(
        spark,
        f"""WITH ranked AS (
            SELECT *, row_number() OVER (PARTITION BY frame_id, side ORDER BY charge DESC, id, tie) AS rn,
              count(*) OVER (PARTITION BY frame_id, side) AS n FROM naive_strips)
        {_slots('ranked', 'frame_id, side', {'id': 3, 'charge': 3})}""",
        naive_strips=V.strips(spark, sf),
    )


def strip_chain_slots(spark, sf):
    """Every leading edge with every trailing one of its channel, then ranked."""
    blocks, cfg = V.strip_blocks(spark, sf), V.STRIP_CHAIN
    zero = hits.earliest_time(hits.anode_hits(blocks, cfg, "mid"))
    wanted = {"id": 3, "charge": 3, "timing": 1}
    return _sql(
        spark,
        f"""WITH pairs AS (
            SELECT l.frame_id, m.side, m.id, l.timing, t.timing - l.timing AS charge
            FROM naive_edges l JOIN naive_edges t ON l.frame_id = t.frame_id AND l.ch = t.ch
            JOIN naive_map m ON m.ch = l.ch WHERE l.edge = 0 AND t.edge = 1),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY frame_id, side ORDER BY charge DESC, id, timing) AS rn,
              count(*) OVER (PARTITION BY frame_id, side) AS n FROM pairs),
        slots AS ({_slots('ranked', 'frame_id, side', wanted)})
        SELECT * FROM (SELECT * FROM slots WHERE side = 'x') x
        FULL JOIN (SELECT * FROM slots WHERE side = 'y') y USING (frame_id)""",
        naive_edges=strip.timed_edges(hits.strip_edges(blocks, cfg, "mid"), zero, cfg),
        naive_map=V.strip_map(spark),
    )


@cache
def _curve_steps(spark, sf):
    """Written once and outside of the time measured, as curves come from files."""
    found = V.chain_curves(V.chain_leads(spark, sf))
    return materialise(curves.curve_intervals(found, ["plane"]), "naive-steps")


def drift_length(spark, sf):
    cfg, blocks = V.CHAIN, V.wire_blocks(spark, sf)
    anode = hits.anode_hits(blocks, cfg, "mid")
    known = hits.map_channels(
        hits.wire_hits(blocks, cfg, "mid"), hits.wire_channel_map(V.wire_map(spark), cfg), ["femId", "ch"]
    )
    cut = hits.subtract_time_zero(known, hits.earliest_time(anode)).where(hits.wire_cut(cfg))
    return _sql(
        spark,
        f"""WITH ranked AS (
            SELECT *, row_number() OVER (PARTITION BY frame_id, plane ORDER BY charge DESC, id, timing) AS rn
            FROM naive_cut),
        leads AS (SELECT frame_id, plane, id AS id0, timing AS timing0 FROM ranked WHERE rn = 1),
        complete AS (SELECT frame_id FROM leads GROUP BY frame_id HAVING count(*) = {len(cfg.planes)})
        SELECT l.*, (tx_lo + (tx_hi - tx_lo) * 0.5D) * {cfg.half_cell}D AS dl
        FROM leads l JOIN complete USING (frame_id) LEFT JOIN naive_steps s
        ON l.plane = s.plane AND timing0 >= lo AND timing0 < hi""",
        naive_cut=cut,
        naive_steps=_curve_steps(spark, sf),
    )


NAIVE = {
    "strip_chain_slots": strip_chain_slots,
    "drift_length": drift_length,
    "plane_coincidence": plane_coincidence,
    "interval_lookup": interval_lookup,
    "ordered_hit_slots": ordered_hit_slots,
}
