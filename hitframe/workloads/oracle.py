"""The registered queries as plain SQL over the same tables.

Written in the straightforward shape (self-joins, range joins, window ranks) and
independent of the DataFrame operators, so agreement means something.
"""

from __future__ import annotations

import re

from . import catalog as K
from . import views as V


def _d(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _r6(x: str) -> str:
    return f"CASE WHEN abs({x}) < 5e-7 THEN 0e0 ELSE round({x}, 6) END"


def _uniform(key: str, factor: int = 2654435761) -> str:
    return f"CAST(({key} * {factor}) % 4294967296 AS DOUBLE) / CAST(4294967296 AS DOUBLE)"


TICK = _d(0.0009765625)

CTE = {
    "ev": """SELECT event_id, event_type, user_id, value,
        date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) AS us,
        CAST(json_extract(props, '$.k') AS INT) AS k FROM events""",
    "hits": f"""SELECT event_id, us // {V.HOUR_US} AS frame_id, us % {V.HOUR_US} AS ticks, k AS ch,
        value AS charge, event_type, 616 + user_id % 3 AS fem, k // 25 AS plane_no,
        {_uniform('event_id')} AS u FROM ev""",
    "trig": f"SELECT frame_id, (ticks + u) * {TICK} AS tcal, ticks AS raw FROM hits WHERE event_type = 'signup'",
    "t0": "SELECT frame_id, min(tcal) AS t0, min(raw) AS raw FROM trig GROUP BY frame_id",
    "timed": f"""SELECT h.*, (h.ticks + h.u) * {TICK} - t.t0 AS timing, t.raw
        FROM hits h JOIN t0 t USING (frame_id) WHERE event_type <> 'signup'""",
    "strips": """SELECT l_orderkey AS frame_id, 'x' AS side, l_linenumber AS id,
        l_extendedprice / CAST(1000 AS DOUBLE) AS charge, l_partkey AS tie FROM lineitem
        UNION ALL
        SELECT l_orderkey, 'y', CAST(l_suppkey % 8 AS INT), l_quantity, l_partkey FROM lineitem""",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY frame_id, side ORDER BY charge DESC, id, tie) AS rn,
        count(*) OVER (PARTITION BY frame_id, side) AS n FROM strips""",
    "slots": """SELECT frame_id, side, max(n) AS size,
        max(CASE WHEN rn = 1 THEN id END) AS id0, max(CASE WHEN rn = 2 THEN id END) AS id1,
        max(CASE WHEN rn = 3 THEN id END) AS id2,
        max(CASE WHEN rn = 1 THEN charge END) AS charge0, max(CASE WHEN rn = 2 THEN charge END) AS charge1,
        max(CASE WHEN rn = 3 THEN charge END) AS charge2
        FROM ranked GROUP BY frame_id, side""",
    "sx": "SELECT * FROM slots WHERE side = 'x'",
    "sy": "SELECT * FROM slots WHERE side = 'y'",
    "wide": """SELECT coalesce(x.frame_id, y.frame_id) AS frame_id,
        x.size AS size_x, x.id0 AS id0_x, x.id1 AS id1_x, x.id2 AS id2_x,
        x.charge0 AS charge0_x, x.charge1 AS charge1_x, x.charge2 AS charge2_x,
        y.size AS size_y, y.id0 AS id0_y, y.id1 AS id1_y, y.id2 AS id2_y,
        y.charge0 AS charge0_y, y.charge1 AS charge1_y, y.charge2 AS charge2_y
        FROM sx x FULL JOIN sy y ON x.frame_id = y.frame_id""",
    "edges": """SELECT l_orderkey AS frame_id, l_linenumber AS ch,
        CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS edge, l_quantity AS t
        FROM lineitem""",
    "pairs": """SELECT l.frame_id, l.ch, l.t AS timing, r.t - l.t AS width
        FROM (SELECT * FROM edges WHERE edge = 0) l JOIN (SELECT * FROM edges WHERE edge = 1) r
        ON l.frame_id = r.frame_id AND l.ch = r.ch""",
}


def _bin(v: str, bins) -> str:
    return (
        f"CASE WHEN {v} >= {_d(bins.lo)} AND {v} < {_d(bins.hi)} THEN "
        f"least(CAST(floor(({v} - {_d(bins.lo)}) / {_d(bins.width)}) AS BIGINT), {bins.n - 1}) END"
    )


def _curve(counts: str, key: str, bins) -> str:
    """CDF curve of dense counts, as nested selects."""
    return f"""SELECT {key}, bin, {_d(bins.lo)} + (bin + {_d(0.5)}) * {_d(bins.width)} AS x, tx FROM (
        SELECT *, min(CASE WHEN tx >= {_d(1e-3)} THEN bin END) OVER (PARTITION BY {key}) AS b0,
                  min(CASE WHEN tx >= {_d(1 - 1e-3)} THEN bin END) OVER (PARTITION BY {key}) AS b1
        FROM (SELECT {key}, bin,
                CAST(sum(n) OVER (PARTITION BY {key} ORDER BY bin) AS DOUBLE)
                / CAST(sum(n) OVER (PARTITION BY {key}) AS DOUBLE) AS tx
              FROM {counts})) WHERE bin BETWEEN b0 AND b1"""


def _dense(source: str, key: str, bins) -> str:
    return f"""SELECT g.{key}, b.bin, count(s.bin) AS n
        FROM (SELECT DISTINCT {key} FROM {source}) g
        CROSS JOIN (SELECT range AS bin FROM range({bins.n})) b
        LEFT JOIN {source} s ON s.{key} = g.{key} AND s.bin = b.bin GROUP BY g.{key}, b.bin"""


def _intervals(curve: str, key: str) -> str:
    return f"""SELECT * FROM (SELECT {key}, lag(x) OVER (PARTITION BY {key} ORDER BY x) AS lo, x AS hi,
        lag(tx) OVER (PARTITION BY {key} ORDER BY x) AS tx_lo, tx AS tx_hi FROM {curve}) WHERE lo IS NOT NULL"""


CTE |= {
    "charge_bin": f"SELECT * FROM (SELECT plane_no, {_bin('charge', K.CHARGE_BINS)} AS bin FROM hits) WHERE bin IS NOT NULL",
    "grid": f"""SELECT plane_no, bin_x, bin_y, count(*) AS n FROM (SELECT plane_no,
        {_bin(f'((ticks + u) * {TICK})', K.TIME_BINS)} AS bin_x, {_bin('charge', K.CHARGE_BINS)} AS bin_y FROM hits)
        WHERE bin_x IS NOT NULL AND bin_y IS NOT NULL GROUP BY plane_no, bin_x, bin_y""",
    "curve_bin": f"SELECT * FROM (SELECT plane_no, {_bin('charge', K.CURVE_BINS)} AS bin FROM hits) WHERE bin IS NOT NULL",
    "curve_counts": _dense("curve_bin", "plane_no", K.CURVE_BINS),
    "curve": _curve("curve_counts", "plane_no", K.CURVE_BINS),
    "steps": _intervals("curve", "plane_no"),
    "pulser": """SELECT event_type AS runname, ch % 32 AS id, CAST(floor(charge) AS BIGINT) AS cb FROM hits
        WHERE charge >= 0 AND charge < 500""",
    "pulser_mode": """SELECT runname, id, cb FROM (SELECT *, row_number() OVER (PARTITION BY runname, id ORDER BY n DESC, cb) AS r
        FROM (SELECT runname, id, cb, count(*) AS n FROM pulser GROUP BY runname, id, cb)) WHERE r = 1""",
    "modes": """SELECT g.runname, i.range AS id, coalesce(m.cb, 0) AS mode_bin
        FROM (SELECT DISTINCT runname FROM pulser) g CROSS JOIN (SELECT range FROM range(32)) i
        LEFT JOIN pulser_mode m ON m.runname = g.runname AND m.id = i.range""",
}

# --- wire chain -------------------------------------------------------------

_TOT = f"CAST(floor(value * {_d(1024)} + {_d(0.5)}) AS BIGINT)"
_NAMES = "[" + ", ".join(f"'{p}'" for p in V.CHAIN.planes) + "]"
_PL = V.CHAIN.planes


def _pick(plane: str, col: str) -> str:
    return f"max(CASE WHEN plane = '{plane}' THEN {col} END)"


def _posi(pair, second: bool) -> str:
    a, b = pair.first, pair.second
    own, other = (b, a) if second else (a, b)
    centre = V.CHAIN.centre_ids[1 if second else 0]
    shift = pair.shift if second else 0.0
    base = f"(({own}_id0 - {_d(centre)}) * {_d(V.CHAIN.cell)} + {_d(shift)})"
    near = f"{other}_dl > {_d(V.CHAIN.half_cell - abs(pair.shift))}"
    if pair.shift > 0:
        test = f"{a}_id0 <> {b}_id0 OR ({a}_id0 = {b}_id0 AND {near})"
        usual, unusual = ("-", "+") if second else ("+", "-")
    else:
        test = f"{a}_id0 = {b}_id0 OR ({a}_id0 <> {b}_id0 AND {near})"
        usual, unusual = ("+", "-") if second else ("-", "+")
    value = f"CASE WHEN {test} THEN {base} {usual} {own}_dl ELSE {base} {unusual} {own}_dl END"
    move = V.CHAIN.layer_shift.get(own)
    value = f"({value})" if move is None else f"(({value}) + {_d(move)})"
    return f"{value} AS {own}_posi"


def _line(axis: str, z: float) -> str:
    l1 = getattr(V.CHAIN.upstream, axis) - z
    l2 = getattr(V.CHAIN.downstream, axis) - z
    body = f"(dc31_{axis} * {_d(l2)} - dc32_{axis} * {_d(l1)}) / {_d(abs(l1) + abs(l2))}"
    return f"-({body})" if axis == "x" else f"({body})"


def _mean(cols: list[str]) -> str:
    return f"({' + '.join(cols)}) / {_d(len(cols))}"


CTE |= {
    "wb": f"""SELECT event_id, event_id // {V.FRAME_EVENTS} AS frame_id, us, k, {_TOT} AS tot, value FROM ev
        WHERE event_id > 0 AND event_type <> 'error' AND value >= 1""",
    "wires": """SELECT w.*, b.range AS b, j.range AS j, (k + (event_id * (4 * b.range + j.range)) % 3) % 16 AS wire,
        (us + 4099 * j.range + 9973 * b.range) % 65536 AS time FROM wb w CROSS JOIN range(3) b CROSS JOIN range(4) j""",
    "raw": """SELECT frame_id, 614 AS fem, CASE WHEN k < 90 THEN 4 ELSE 5 END AS ch, us % 65536 AS time, tot FROM wb
        UNION ALL SELECT frame_id, 614, CASE WHEN k < 90 THEN 4 ELSE 5 END, us % 65536 + 40, tot // 2 FROM wb WHERE value > 100
        UNION ALL SELECT frame_id, 616 + b, 4 * wire + j, time, tot + 512 * j FROM wires
        UNION ALL SELECT frame_id, 616 + b, 4 * ((wire + 3) % 16) + j, time + 40, tot // 2 FROM wires WHERE value > 100""",
    "wt0": f"""SELECT frame_id, min((time + {_d(0.5)}) * {TICK}) AS sra_timing, min(time) AS sra_tdc_raw
        FROM raw WHERE fem = 614 AND ch = 4 GROUP BY frame_id""",
    "cmap": """SELECT 616 + f.range AS fem, 4 * w.range + p.range AS ch,
        (CASE WHEN f.range = 1 THEN 64 ELSE 0 END) + 16 * p.range + (5 * w.range) % 16 AS id,
        CASE WHEN f.range < 2 THEN 'dc31' ELSE 'dc32' END AS detector FROM range(3) f, range(16) w, range(4) p""",
    "mapped_raw": f"""SELECT r.frame_id, m.detector, m.id AS chan, (r.time + {_d(0.5)}) * {TICK} AS tcal,
        (r.tot + {_d(0.5)}) * {TICK} AS charge
        FROM raw r JOIN cmap m ON r.fem = m.fem AND r.ch = m.ch WHERE r.fem <> 614""",
    "mapped": f"""SELECT m.frame_id, m.detector, ({_NAMES})[CAST((CASE WHEN detector = 'dc31' THEN 0 ELSE 8 END) + chan // 16 + 1 AS INT)] AS plane,
        m.chan % 16 AS id, m.charge, m.tcal - t.sra_timing AS timing, t.sra_timing, t.sra_tdc_raw
        FROM mapped_raw m JOIN wt0 t USING (frame_id)""",
    "kept": """SELECT * FROM mapped WHERE charge > 10 AND charge < 150 AND timing > -60
        AND timing < CASE WHEN detector = 'dc31' THEN 60 ELSE 55 END""",
    "wranked": """SELECT *, row_number() OVER (PARTITION BY frame_id, plane ORDER BY charge DESC, id, timing) AS rn,
        count(*) OVER (PARTITION BY frame_id, plane) AS size FROM kept""",
    "leads": "SELECT frame_id, plane, size, id AS id0, charge AS charge0, timing AS timing0, sra_timing, sra_tdc_raw FROM wranked WHERE rn = 1",
    "full_frames": "SELECT frame_id FROM leads GROUP BY frame_id HAVING count(*) = 12",
    "cleads": "SELECT l.* FROM leads l JOIN full_frames USING (frame_id)",
    "drift_bin": f"""SELECT plane, bin FROM (SELECT plane, {_bin('timing0', V.CHAIN_TIME_BINS)} AS bin,
        {_bin('charge0', V.CHAIN_CHARGE_BINS)} AS cb FROM cleads WHERE id0 > 0 AND id0 < 15
        AND charge0 > 10 AND charge0 < 150 AND timing0 > -60 AND timing0 < 60) WHERE bin IS NOT NULL AND cb IS NOT NULL""",
    "drift_counts": _dense("drift_bin", "plane", V.CHAIN_TIME_BINS),
    "drift_curve": _curve("drift_counts", "plane", V.CHAIN_TIME_BINS),
    "drift_steps": _intervals("drift_curve", "plane"),
    "dl": f"""SELECT l.*, (s.tx_lo + (s.tx_hi - s.tx_lo) * ({_uniform('l.frame_id')})) * {_d(V.CHAIN.half_cell)} AS dl
        FROM cleads l LEFT JOIN drift_steps s ON l.plane = s.plane AND l.timing0 >= s.lo AND l.timing0 < s.hi""",
    "dwide": "SELECT frame_id, max(sra_tdc_raw) AS sra_tdc_raw, "
    + ", ".join(f"{_pick(p, 'dl')} AS {p}_dl, {_pick(p, 'id0')} AS {p}_id0, {_pick(p, 'size')} AS {p}_size" for p in _PL)
    + " FROM dl JOIN full_frames USING (frame_id) GROUP BY frame_id",
    "posi": "SELECT *, " + ", ".join(_posi(p, s) for p in V.CHAIN.pairs for s in (False, True)) + " FROM dwide",
    "views": "SELECT *, "
    + ", ".join(f"{_mean([f'{p}_posi' for p in ps])} AS {v}" for v, ps in V.CHAIN.views.items())
    + " FROM posi",
}

# --- strip chain ------------------------------------------------------------

_LO, _HI = V.STRIP_CHAIN.window
_LX, _LY = "l_partkey % 1000", "l_partkey % 900"
_WX, _WY = "CAST(floor(l_extendedprice) AS BIGINT)", "CAST(floor(l_quantity * 1000) AS BIGINT)"
_CX, _CY = "l_linenumber", "32 + l_suppkey % 4"


def _side(s: str, col: str) -> str:
    return f"max(CASE WHEN side = '{s}' THEN {col} END)"


def _place(side: str, turned: str = "") -> tuple[str, str]:
    half, centre = V.STRIP_CHAIN.half_strip[side], V.STRIP_CHAIN.centre_strip[side]
    depth = f"cdf * {_d(abs(half))}"
    ins = f"CASE WHEN id1 = id0 + 1 THEN {depth} ELSE -({depth}) END"
    pos = f"({_d(centre)} - id0) * {_d(abs(half) * 2.0)} + {turned}({ins}) - {_d(half)}"
    return ins, pos


CTE |= {
    "st0": f"""SELECT o_orderkey AS frame_id, min((o_custkey % 500 + {_d(0.5)}) * {TICK}) AS t0
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderkey""",
    "sedges": " UNION ALL ".join(
        f"SELECT l_orderkey AS frame_id, {c} AS ch, {e} AS edge, {t} AS time FROM lineitem"
        for c, e, t in (
            (_CX, 0, _LX),
            (_CX, 1, f"{_LX} + {_WX}"),
            (_CY, 0, _LY),
            (_CY, 1, f"{_LY} + {_WY}"),
        )
    ),
    "stimed": f"""SELECT * FROM (SELECT e.frame_id, e.ch, e.edge, (e.time + {_d(0.5)}) * {TICK} - t.t0 AS timing
        FROM sedges e JOIN st0 t USING (frame_id)) WHERE timing > {_d(_LO)} AND timing < {_d(_HI)}""",
    "spairs": """SELECT l.frame_id, CASE WHEN l.ch < 32 THEN 'x' ELSE 'y' END AS side,
        CASE WHEN l.ch < 32 THEN 7 - l.ch ELSE l.ch - 32 END AS id, l.timing, r.timing - l.timing AS charge
        FROM (SELECT * FROM stimed WHERE edge = 0) l JOIN (SELECT * FROM stimed WHERE edge = 1) r
        ON l.frame_id = r.frame_id AND l.ch = r.ch""",
    "snear": """SELECT frame_id, CASE WHEN ch < 32 THEN 'x' ELSE 'y' END AS side,
        CASE WHEN ch < 32 THEN 7 - ch ELSE ch - 32 END AS id, timing, trail - timing AS charge FROM (
        SELECT l.frame_id, l.ch, l.timing, (SELECT min(r.timing) FROM stimed r WHERE r.edge = 1
        AND r.frame_id = l.frame_id AND r.ch = l.ch AND r.timing > l.timing) AS trail FROM stimed l WHERE l.edge = 0)
        WHERE trail IS NOT NULL""",
    "sranked": """SELECT *, row_number() OVER (PARTITION BY frame_id, side ORDER BY charge DESC, id, timing) AS rn,
        count(*) OVER (PARTITION BY frame_id, side) AS n FROM spairs""",
    "sslots": "SELECT frame_id, side, max(n) AS size, "
    + ", ".join(
        f"max(CASE WHEN rn = {i + 1} THEN {c} END) AS {c}{i}"
        for c, k in (("id", 3), ("charge", 3), ("timing", 1))
        for i in range(k)
    )
    + " FROM sranked GROUP BY frame_id, side",
    "swide": "SELECT frame_id, "
    + ", ".join(
        f"{_side(s, c)} AS {c}_{s}"
        for s in ("x", "y")
        for c in ("size", "id0", "id1", "id2", "timing0", "charge0", "charge1", "charge2")
    )
    + " FROM sslots GROUP BY frame_id",
    "adjacent": """SELECT * FROM swide WHERE size_x BETWEEN 2 AND 6 AND size_y BETWEEN 2 AND 6
        AND abs(id0_x - id1_x) = 1 AND abs(id0_y - id1_y) = 1""",
    "slong": " UNION ALL ".join(
        f"""SELECT frame_id, '{s}' AS plane, id0_{s} AS id0, id1_{s} AS id1,
        CASE WHEN charge0_{s} + charge1_{s} <> 0 THEN (charge0_{s} - charge1_{s}) / (charge0_{s} + charge1_{s}) END AS q0q1
        FROM adjacent"""
        for s in ("x", "y")
    ),
    "sbin": f"SELECT * FROM (SELECT plane, {_bin('q0q1', V.STRIP_CURVE_BINS)} AS bin FROM slong) WHERE bin IS NOT NULL",
    "scounts": _dense("sbin", "plane", V.STRIP_CURVE_BINS),
    "scurve": _curve("scounts", "plane", V.STRIP_CURVE_BINS),
    "ssteps": _intervals("scurve", "plane"),
    "scdf": f"""SELECT l.*, (s.tx_lo + (s.tx_hi - s.tx_lo) * ({_uniform('l.frame_id')})) * {_d(1)} AS cdf
        FROM slong l LEFT JOIN ssteps s ON l.plane = s.plane AND l.q0q1 >= s.lo AND l.q0q1 < s.hi""",
    "splaced": " UNION ALL ".join(
        f"SELECT frame_id, plane, {_place(s)[1]} AS pos, {_place(s)[0]} AS ins FROM scdf WHERE plane = '{s}'"
        for s in ("x", "y")
    ),
    "splaced_turned": " UNION ALL ".join(
        f"SELECT frame_id, plane, {_place(s, '-')[1]} AS pos, {_place(s)[0]} AS ins FROM scdf WHERE plane = '{s}'"
        for s in ("x", "y")
    ),
    "spos": """SELECT frame_id,
        max(CASE WHEN plane = 'x' THEN pos END) AS sr_pos_x, max(CASE WHEN plane = 'x' THEN ins END) AS sr_ins_x,
        max(CASE WHEN plane = 'y' THEN pos END) AS sr_pos_y, max(CASE WHEN plane = 'y' THEN ins END) AS sr_ins_y
        FROM splaced GROUP BY frame_id""",
    "joined": """SELECT s.frame_id, s.sr_pos_x, s.sr_pos_y, w.dc31_x, w.dc31_y, w.dc32_x, w.dc32_y
        FROM spos s JOIN views w USING (frame_id)""",
    "residuals": " UNION ALL ".join(
        f"SELECT frame_id, '{a}-{b}' AS pair, {a}_posi - {b}_posi AS diff FROM posi"
        for a, b in K.RESIDUAL_PAIRS
    ),
}


CTE |= {
    "gains": """SELECT CASE WHEN n_nationkey < 8 THEN 'x' ELSE 'y' END AS side, n_nationkey % 8 AS id,
        CASE n_nationkey % 4 WHEN 0 THEN 1.25e0 WHEN 1 THEN -0.75e0 WHEN 2 THEN 0.5e0 ELSE 0e0 END AS p1,
        n_nationkey * 0.5e0 + 3e0 AS p0 FROM nation WHERE n_nationkey < 16 AND n_nationkey NOT IN (5, 14)""",
    "granked": """SELECT *, row_number() OVER (PARTITION BY frame_id, side ORDER BY charge DESC, id, timing) AS rn,
        count(*) OVER (PARTITION BY frame_id, side) AS n FROM (
        SELECT p.frame_id, p.side, p.id, p.timing, p.charge * g.p1 + g.p0 AS charge
        FROM spairs p JOIN gains g ON p.side = g.side AND p.id = g.id)""",
    "run_hits": f"SELECT *, frame_id // {K.RUN_FRAMES} AS run_no FROM hits",
    "taken": f"""SELECT DISTINCT plane_no, run_no, ch AS version FROM run_hits
        WHERE event_type = 'purchase' AND charge > {_d(K.STRONG)}""",
    "served": """SELECT r.plane_no, r.run_no, t.run_no AS curve_no, t.version AS curve_version FROM (
        SELECT DISTINCT plane_no, run_no FROM run_hits) r LEFT JOIN taken t ON t.plane_no = r.plane_no AND t.run_no <= r.run_no
        QUALIFY row_number() OVER (PARTITION BY r.plane_no, r.run_no ORDER BY t.run_no DESC NULLS LAST, t.version DESC) = 1""",
    "cal_bin": f"""SELECT * FROM (SELECT plane_no * 1000 + run_no AS cal, {_bin('charge', K.CURVE_BINS)} AS bin FROM run_hits
        WHERE (plane_no, run_no) IN (SELECT (plane_no, run_no) FROM taken)) WHERE bin IS NOT NULL""",
    "cal_counts": _dense("cal_bin", "cal", K.CURVE_BINS),
    "cal_curve": _curve("cal_counts", "cal", K.CURVE_BINS),
    "cal_steps": _intervals("cal_curve", "cal"),
    "strip_modes": """SELECT 'run' || (frame_id % 3) AS runname, side, id, CAST(floor(charge) AS BIGINT) AS cb FROM snear
        WHERE charge >= 0 AND charge < 500""",
    "spread_bin": f"""SELECT l_returnflag, bin, count(*) AS n FROM (SELECT l_returnflag,
        {_bin('diff', K.PEAK_BINS)} AS bin FROM (SELECT l_returnflag, CAST(l_quantity + l_partkey % 50 + l_suppkey % 50
        + l_orderkey % 50 - 100 AS DOUBLE) AS diff FROM lineitem)) WHERE bin IS NOT NULL GROUP BY l_returnflag, bin""",
}


def _peak(counts: str, key: str, bins, rounds: int = 5, floor: float = 0.1) -> str:
    """The iterated fit, one nested select per round."""

    def det(x, y, z):
        return (
            f"({x[0]} * ({y[1]} * {z[2]} - {y[2]} * {z[1]}) - {x[1]} * ({y[0]} * {z[2]} - {y[2]} * {z[0]})"
            f" + {x[2]} * ({y[0]} * {z[1]} - {y[1]} * {z[0]}))"
        )

    s = [["s0", "s1", "s2"], ["s1", "s2", "s3"], ["s2", "s3", "s4"]]
    roots = []
    for i, name in enumerate("abc"):
        put = [[f"t{r}" if c == i else s[r][c] for c in range(3)] for r in range(3)]
        roots.append(f"{det(*put)} / nullif({det(*s)}, 0) AS {name}")
    sums = [f"sum(w * u ** {i}) OVER p AS s{i}" for i in range(5)] + [f"sum(w * u ** {i} * y) OVER p AS t{i}" for i in range(3)]
    rows = f"""SELECT {key}, CAST(n AS DOUBLE) AS n, (bin + 0.5e0) / {_d(bins.n)} - 0.5e0 AS u, ln(n) AS y, CAST(n AS DOUBLE) AS w
        FROM (SELECT *, max(n) OVER (PARTITION BY {key}) AS top FROM {counts}) WHERE n > 0 AND n >= {_d(floor)} * top"""
    for _ in range(rounds):
        rows = f"""SELECT {key}, n, u, y, a, b, c, CASE WHEN c < 0 THEN exp(a + (b + c * u) * u) ELSE n END AS w FROM (
            SELECT *, {', '.join(roots)} FROM (SELECT {key}, n, u, y, w, {', '.join(sums)} FROM ({rows}) WINDOW p AS (PARTITION BY {key})))"""
    span = _d(bins.hi - bins.lo)
    fits = {
        "height": "exp(a - b * b / (4 * c))",
        "centre": f"{_d(bins.lo)} + (-b / (2 * c) + 0.5e0) * {span}",
        "width": f"sqrt(-0.5e0 / c) * {span}",
    }
    cells = ", ".join(f"CASE WHEN c < 0 AND bins >= 3 THEN {_r6(x)} END AS {name}" for name, x in fits.items())
    return f"""SELECT {key}, CAST(n AS BIGINT) AS n, {cells} FROM (SELECT {key}, sum(n) AS n, count(*) AS bins,
        max(a) AS a, max(b) AS b, max(c) AS c FROM ({rows}) GROUP BY {key})"""


def _resolution(run: bool = False) -> str:
    parts = []
    for view, planes in V.CHAIN.views.items():
        diffs = [f"({p}_posi - {view})" for p in planes]
        k = len(planes)

        def spread(accepted: bool) -> str:
            terms = []
            for d in diffs:
                n = f"count(CASE WHEN abs({d}) < {_d(0.8)} THEN 1 END)" if accepted else "count(*)"
                terms.append(f"sum(CASE WHEN abs({d}) < {_d(0.8)} THEN {d} * {d} END) / {n}")
            return f"round(sqrt(({' + '.join(terms)}) / {k} * ({k} - 1)) / {k} * 1000, 4)"

        parts.append(
            f"SELECT '{view}' AS view, {'frame_id % 3 AS run, ' if run else ''}count(*) AS n_all, "
            f"{spread(False)} AS resolution_um, {spread(True)} AS resolution_accepted_um FROM views"
            f"{' GROUP BY frame_id % 3' if run else ''}"
        )
    return " UNION ALL ".join(parts)


def _big(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


_SIDES = ("x", "y")
_ASYM = {
    s: f"CASE WHEN charge0_{s} + charge1_{s} <> 0 THEN (charge0_{s} - charge1_{s}) / (charge0_{s} + charge1_{s}) END AS q0q1_{s}"
    for s in _SIDES
}
_ADJ = """size_x BETWEEN 2 AND 6 AND size_y BETWEEN 2 AND 6
    AND abs(id0_x - id1_x) = 1 AND abs(id0_y - id1_y) = 1"""
_CLUSTER = """charge2_x > 0 AND charge2_y > 0 AND abs(id0_x - id1_x) = 1 AND abs(id0_y - id1_y) = 1
    AND abs(id0_x - id2_x) = 1 AND abs(id0_y - id2_y) = 1"""


def _flag(test: str, name: str) -> str:
    return f"CAST(CASE WHEN {test} THEN 1 ELSE 0 END AS BIGINT) AS {name}"


def _coincidence() -> str:
    cells = []
    for i in K.PLANES:
        for col, kind in (("size", "BIGINT"), ("id0", "BIGINT"), ("charge0", "DOUBLE"), ("timing0", "DOUBLE")):
            cells.append(f"CAST(max(CASE WHEN plane_no = {i} THEN {col} END) AS {kind}) AS p{i}_{col}")
    return f"""SELECT frame_id, {', '.join(cells)}, max(raw) AS tdc_raw FROM (
        SELECT frame_id, plane_no, raw, ch % 25 AS id0, charge AS charge0, timing AS timing0,
            count(*) OVER (PARTITION BY frame_id, plane_no) AS size,
            row_number() OVER (PARTITION BY frame_id, plane_no ORDER BY charge DESC, ch % 25, timing) AS rn
        FROM timed WHERE charge > 10 AND charge < 150) WHERE rn = 1
        GROUP BY frame_id HAVING count(DISTINCT plane_no) = 4"""


def _two_side() -> str:
    side = """SELECT frame_id, max(n) AS size, max(CASE WHEN rn = 1 THEN id END) AS id0,
        max(CASE WHEN rn = 2 THEN id END) AS id1, max(CASE WHEN rn = 1 THEN charge END) AS charge0,
        max(CASE WHEN rn = 2 THEN charge END) AS charge1
        FROM (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY charge DESC, id, tie) AS rn,
                count(*) OVER (PARTITION BY frame_id) AS n
              FROM strips WHERE side = '{s}' AND charge > {f}) GROUP BY frame_id"""
    cols = [f"CAST({s}.{c} AS BIGINT) AS {c}_{s}" for s in _SIDES for c in ("size", "id0", "id1")]
    asym = [
        f"({s}.charge0 - {s}.charge1) / ({s}.charge0 + {s}.charge1) AS q0q1_{s}, {s}.charge0 AS charge0_{s}"
        for s in _SIDES
    ]
    return f"""SELECT coalesce(x.frame_id, y.frame_id) AS frame_id, {', '.join(cols + asym)}
        FROM ({side.format(s='x', f=50)}) x FULL JOIN ({side.format(s='y', f=30)}) y ON x.frame_id = y.frame_id"""


def _correlation() -> str:
    parts = [
        f"""SELECT '{a}-{b}' AS pair, CAST({a}_id0 AS BIGINT) AS bin_x, CAST({b}_id0 AS BIGINT) AS bin_y, count(*) AS n
        FROM dwide WHERE {a}_size = 1 AND {b}_size = 1 GROUP BY ALL"""
        for a, b in K.CORRELATION_PAIRS
    ]
    return " UNION ALL ".join(parts)


def _shift() -> str:
    parts = []
    for p in V.CHAIN.pairs:
        a, b, s = p.first, p.second, abs(p.shift)
        op, inv = ("<>", "=") if p.shift > 0 else ("=", "<>")
        parts.append(
            f"""SELECT frame_id, '{a}-{b}' AS pair, CAST({a}_id0 = {b}_id0 AS BIGINT) AS same_wire, {a}_dl AS dl1,
            CASE WHEN {a}_id0 {op} {b}_id0 THEN {b}_dl - {_d(s)}
                 WHEN {a}_id0 {inv} {b}_id0 AND {a}_dl > {_d(1.5 - s)} THEN {b}_dl - {_d(s)}
                 ELSE {b}_dl + {_d(s)} END AS dl2 FROM dwide"""
        )
    return " UNION ALL ".join(parts)


_OCC = f"""SELECT detector, chan AS bin_x, CAST(floor(charge / {_d(2)}) AS BIGINT) AS bin_y, count(*) AS n
    FROM mapped_raw WHERE charge >= 0 AND charge < 200 GROUP BY ALL"""

BODIES = {
    "hit_routing_explode": f"SELECT frame_id, CAST(fem AS BIGINT) AS femId, CAST(ch AS BIGINT) AS ch, time AS ticks, tot FROM raw WHERE fem <> 614 OR ch = 4",
    "tick_calibration": f"""SELECT event_id, (ticks + u) * {TICK} AS tcal,
        (CAST(floor(charge * {_d(100)} + {_d(0.5)}) AS BIGINT) + {_uniform('event_id', 2246822519)}) * {TICK} AS charge_ns,
        charge * {_d(0.5)} + {_d(2)} AS charge_lin FROM hits""",
    "first_trigger_min": "SELECT frame_id, min(tcal) AS t0 FROM trig GROUP BY frame_id",
    "first_trigger_row": """SELECT frame_id, tcal AS sra_timing, raw AS sra_tdc_raw FROM (SELECT *,
        row_number() OVER (PARTITION BY frame_id ORDER BY tcal, raw) AS rn FROM trig) WHERE rn = 1""",
    "time_zero_window": f"""SELECT event_id, frame_id, timing, charge FROM timed
        WHERE timing > {_d(K.WINDOW_NS[0])} AND timing < {_d(K.WINDOW_NS[1])} AND charge > 10 AND charge < 150""",
    "channel_map_join": """SELECT event_id, m.id // 16 AS plane_no, m.id % 16 AS id, charge FROM hits h
        JOIN (SELECT range AS id, 616 + range // 96 AS fem, range % 96 AS ch FROM range(288)) m
        ON h.fem = m.fem AND h.ch = m.ch""",
    "side_map_join": """SELECT event_id, CASE WHEN ch < 45 THEN 'x' ELSE 'y' END AS side,
        CAST(CASE WHEN ch < 45 THEN 44 - ch ELSE ch - 45 END AS BIGINT) AS id, charge FROM hits WHERE ch < 90""",
    "polarity_flip": f"""SELECT {_big('ch', 'edge', 'flipped')}, count(*) AS n FROM (SELECT *,
        CASE WHEN ch % 2 = 0 THEN 1 - edge ELSE edge END AS flipped FROM edges) GROUP BY ch, edge, flipped""",
    "linear_calibration": f"""SELECT event_id, charge * (1e0 + n_nationkey * {_d(0.01)}) + n_nationkey * {_d(0.5)} AS charge
        FROM hits LEFT JOIN nation ON ch = n_nationkey""",
    "map_and_calibration_files": f"""SELECT event_id, CAST(24 - n_nationkey AS BIGINT) AS id, 'x' AS side,
        {_r6(f"charge * (1e0 + (24 - n_nationkey) * {_d(0.01)}) + (24 - n_nationkey) * {_d(0.5)}")} AS charge
        FROM hits JOIN nation ON ch = n_nationkey""",
    "nearest_pairs": """SELECT frame_id, CAST(ch AS BIGINT) AS ch, timing, timing_trail, timing_trail - timing AS charge FROM (
        SELECT l.frame_id, l.ch, l.t AS timing, (SELECT min(r.t) FROM edges r WHERE r.edge = 1
        AND r.frame_id = l.frame_id AND r.ch = l.ch AND r.t > l.t) AS timing_trail FROM edges l WHERE l.edge = 0)
        WHERE timing_trail IS NOT NULL""",
    "strip_hit_lists": f"""SELECT frame_id, side, row_number() OVER (PARTITION BY frame_id, side
        ORDER BY charge DESC, id, timing) AS rank, CAST(id AS BIGINT) AS id, timing, {_r6('charge')} AS charge FROM snear""",
    "strip_occupancy": f"""SELECT side, CAST(id AS BIGINT) AS bin_x, CAST(floor(charge / {_d(2)}) AS BIGINT) AS bin_y, count(*) AS n
        FROM snear WHERE charge >= 0 AND charge < 120 GROUP BY ALL""",
    "edge_pairing": f"""SELECT frame_id, CAST(ch AS BIGINT) AS ch, count(*) AS n_pairs, {_r6('min(width)')} AS width_min,
        {_r6('max(width)')} AS width_max, {_r6('sum(width)')} AS width_sum FROM pairs GROUP BY frame_id, ch""",
    "edge_pair_slots": f"""SELECT frame_id, {_big('rank', 'ch')}, timing, width AS charge FROM (SELECT *,
        row_number() OVER (PARTITION BY frame_id ORDER BY width DESC, ch, timing) AS rank FROM pairs) WHERE rank <= 3""",
    "ordered_hit_slots": f"SELECT frame_id, side, {_big('size', 'id0', 'id1', 'id2')}, charge0, charge1, charge2 FROM slots",
    "ordered_hits": "SELECT frame_id, side, rn AS rank, CAST(id AS BIGINT) AS id, charge, tie FROM ranked",
    "plane_coincidence": _coincidence(),
    "coincident_hit_lists": "SELECT frame_id, plane, rn AS rank, CAST(id AS BIGINT) AS id, charge, timing FROM wranked JOIN full_frames USING (frame_id)",
    "two_side_outer": _two_side(),
    "cluster_cuts": f"""SELECT frame_id, {_flag('size_x BETWEEN 2 AND 6 AND size_y BETWEEN 2 AND 6', 'multiplicity')},
        {_flag('abs(id0_x - id1_x) = 1 AND abs(id0_y - id1_y) = 1', 'neighbour')}, {_flag(_CLUSTER, 'cluster')} FROM wide""",
    "charge_asymmetry": f"SELECT frame_id, {_big('id0_x', 'id1_x', 'id0_y', 'id1_y')}, {_ASYM['x']}, {_ASYM['y']} FROM wide WHERE {_ADJ}",
    "strip_chain_slots": "SELECT frame_id, "
    + _big(*[f"{c}_{s}" for s in _SIDES for c in ("size", "id0", "id1", "id2")])
    + ", "
    + ", ".join(f"{c}_{s}" for s in _SIDES for c in ("timing0", "charge0", "charge1", "charge2"))
    + " FROM swide",
    "hist1d": f"SELECT plane_no, bin, n FROM ({_dense('charge_bin', 'plane_no', K.CHARGE_BINS)})",
    "hist2d": "SELECT plane_no, bin_x, bin_y, n FROM grid",
    "hist2d_arrays": f"""SELECT l_returnflag, id AS bin_x, CAST(floor(q / {_d(2)}) AS BIGINT) AS bin_y, count(*) AS n FROM (
        SELECT l_returnflag, CAST(l_linenumber AS BIGINT) AS id, l_extendedprice / {_d(1000)} AS q FROM lineitem
        UNION ALL SELECT l_returnflag, l_suppkey % 8, l_quantity FROM lineitem)
        WHERE id <= 8 AND q >= 0 AND q < 100 GROUP BY ALL""",
    "projection_x": "SELECT plane_no, bin_x AS bin, CAST(sum(n) AS BIGINT) AS n FROM grid GROUP BY plane_no, bin_x",
    "projection_y_slice": "SELECT plane_no, bin_y AS bin, CAST(sum(n) AS BIGINT) AS n FROM grid WHERE bin_x BETWEEN 10 AND 29 GROUP BY plane_no, bin_y",
    "mode_bin": f"""SELECT ch, bin AS mode_bin, n FROM (SELECT *, row_number() OVER (PARTITION BY ch ORDER BY n DESC, bin) AS r
        FROM (SELECT ch, {_bin('charge', K.CHARGE_BINS)} AS bin, count(*) AS n FROM hits GROUP BY ALL)
        WHERE bin IS NOT NULL) WHERE r = 1""",
    "pulser_calibration": "SELECT runname, id, mode_bin FROM modes",
    "pulser_occupancy": _OCC,
    "plane_correlation": _correlation(),
    "edge_veto_box": """SELECT frame_id, plane, CAST(id0 AS BIGINT) AS id0, charge0, timing0 FROM cleads WHERE id0 > 0 AND id0 < 15
        AND charge0 > 30 AND charge0 < 120 AND timing0 > -40 AND timing0 < 40""",
    "cdf_curve": "SELECT plane_no, bin, x, tx FROM curve",
    "interval_table": "SELECT plane_no, lo, hi, tx_lo, tx_hi FROM steps",
    "interval_lookup": f"""SELECT event_id, h.plane_no, charge, (tx_lo + (tx_hi - tx_lo) * u) * {_d(1.5)} AS dl FROM hits h
        LEFT JOIN steps s ON h.plane_no = s.plane_no AND charge >= lo AND charge < hi""",
    "drift_calibration": "SELECT plane, bin, x, tx FROM drift_curve",
    "asymmetry_calibration": "SELECT plane, bin, x, tx FROM scurve",
    "drift_length": "SELECT frame_id, plane, CAST(id0 AS BIGINT) AS id0, timing0, dl FROM dl",
    "left_right_resolution": "SELECT frame_id, " + ", ".join(f"{p}_posi" for p in _PL) + " FROM posi",
    "plane_average": "SELECT frame_id, " + ", ".join(V.CHAIN.views) + " FROM views",
    "track_extrapolation": "SELECT frame_id, "
    + ", ".join([*V.CHAIN.views, *[f"{_line(a, z)} AS {a}_{t}" for t, z in V.CHAIN.targets.items() for a in _SIDES]])
    + ", sra_tdc_raw FROM views",
    "shift_check": _shift(),
    "strip_position": "SELECT frame_id, sr_pos_x, sr_ins_x, sr_pos_y, sr_ins_y FROM spos",
    "detector_join": "SELECT * FROM joined",
    "detector_residuals": " UNION ALL ".join(
        f"SELECT frame_id, '{a}' AS axis, sr_pos_{a} AS pos, {_line(a, 0.0)} AS track, sr_pos_{a} - ({_line(a, 0.0)}) AS diff FROM joined"
        for a in _SIDES
    ),
    "plane_residuals": f"""SELECT pair, bin, n FROM ({_dense(f"(SELECT * FROM (SELECT pair, {_bin('diff', K.Bins(-5.0, 5.0, 50))} AS bin FROM residuals) WHERE bin IS NOT NULL)", 'pair', K.Bins(-5.0, 5.0, 50))})""",
    "efficiency": f"""SELECT t AS n_triggers, c AS n_clusters, {_r6('CASE WHEN t > 0 THEN c * 100e0 / t END')} AS efficiency FROM
        (SELECT (SELECT count(*) FROM st0) AS t, (SELECT count(*) FROM swide WHERE {_CLUSTER}) AS c)""",
    "efficiency_by_run": f"""SELECT run, t AS n_triggers, coalesce(c, 0) AS n_clusters, {_r6('coalesce(c, 0) * 100e0 / t')} AS efficiency FROM
        (SELECT frame_id % 3 AS run, count(*) AS t FROM st0 GROUP BY 1)
        LEFT JOIN (SELECT frame_id % 3 AS run, count(*) AS c FROM swide WHERE {_CLUSTER} GROUP BY 1) USING (run)""",
    "slot_efficiency_by_run": f"""SELECT run, side, n0, n2, {_r6('CAST(n2 AS DOUBLE) / n0')} AS efficiency FROM (SELECT frame_id % 3 AS run, side,
        count(CASE WHEN charge0 > 0 THEN 1 END) AS n0, count(CASE WHEN charge2 > 0 THEN 1 END) AS n2 FROM slots GROUP BY 1, side)""",
    "slot_efficiency": f"""SELECT side, n0, n2, {_r6('CAST(n2 AS DOUBLE) / n0')} AS efficiency FROM (SELECT side,
        count(CASE WHEN charge0 > 0 THEN 1 END) AS n0, count(CASE WHEN charge2 > 0 THEN 1 END) AS n2 FROM slots GROUP BY side)""",
    "resolution": _resolution(),
    "resolution_by_run": _resolution(True),
    "exact_quantiles": "SELECT l_returnflag, "
    + ", ".join(f"{_r6(f'quantile_cont(l_extendedprice, {f})')} AS q{i}" for i, f in enumerate(K.QUANTILES))
    + " FROM lineitem GROUP BY l_returnflag",
    "peak_fit": _peak("spread_bin", "l_returnflag", K.PEAK_BINS),
    "strip_chain_slots_gain": "SELECT frame_id, "
    + ", ".join(f"CAST({_side(s, 'n')} AS BIGINT) AS size_{s}" for s in _SIDES)
    + ", "
    + ", ".join(
        f"CAST(max(CASE WHEN side = '{s}' AND rn = {i + 1} THEN id END) AS BIGINT) AS id{i}_{s}, "
        f"max(CASE WHEN side = '{s}' AND rn = {i + 1} THEN charge END) AS charge{i}_{s}"
        for s in _SIDES
        for i in range(3)
    )
    + ", "
    + ", ".join(f"max(CASE WHEN side = '{s}' AND rn = 1 THEN timing END) AS timing0_{s}" for s in _SIDES)
    + " FROM granked GROUP BY frame_id",
    "pair_widths": "SELECT CAST(ch AS BIGINT) AS ch, width, count(*) AS n FROM pairs GROUP BY ch, width",
    "strip_pair_occupancy": f"""SELECT side, CAST(id AS BIGINT) AS id, bin, count(*) AS n FROM (
        SELECT side, id, {_bin('charge', K.STRIP_CHARGE_BINS)} AS bin FROM spairs) WHERE bin IS NOT NULL GROUP BY side, id, bin""",
    "default_dither": "SELECT frame_id, CAST(fem AS BIGINT) AS femId, CAST(ch AS BIGINT) AS ch, time AS ticks, tot FROM raw WHERE fem <> 614",
    "strip_pulser_calibration": """SELECT g.runname, g.side, i.range AS id, coalesce(m.cb, 0) AS mode_bin
        FROM (SELECT DISTINCT runname, side FROM strip_modes) g CROSS JOIN range(8) i LEFT JOIN (
        SELECT runname, side, id, cb FROM (SELECT runname, side, id, cb, count(*) AS n FROM strip_modes GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY runname, side, id ORDER BY n DESC, cb) = 1) m
        ON m.runname = g.runname AND m.side = g.side AND m.id = i.range""",
    "interval_lookup_exact": f"""SELECT event_id, h.plane_no, charge,
        {_r6(f"(tx_lo + (tx_hi - tx_lo) * ((charge - lo) / (hi - lo))) * {_d(1.5)}")} AS dl
        FROM hits h LEFT JOIN steps s ON h.plane_no = s.plane_no AND charge >= lo AND charge < hi""",
    "calibration_in_force": f"SELECT {_big('plane_no', 'run_no', 'curve_no', 'curve_version')} FROM served",
    "lookup_in_force": f"""SELECT event_id, h.plane_no, curve_no, charge, (tx_lo + (tx_hi - tx_lo) * u) * {_d(1.5)} AS dl
        FROM run_hits h JOIN served s ON h.plane_no = s.plane_no AND h.run_no = s.run_no
        LEFT JOIN cal_steps c ON c.cal = s.plane_no * 1000 + s.curve_no AND charge >= lo AND charge < hi""",
    "drift_calibration_by_parts": "SELECT plane, bin, x, tx FROM drift_curve",
    "bucketed_join": "SELECT * FROM joined",
    "strip_position_mirrored": """SELECT frame_id,
        max(CASE WHEN plane = 'x' THEN pos END) AS sr_pos_x, max(CASE WHEN plane = 'x' THEN ins END) AS sr_ins_x,
        max(CASE WHEN plane = 'y' THEN pos END) AS sr_pos_y, max(CASE WHEN plane = 'y' THEN ins END) AS sr_ins_y
        FROM splaced_turned GROUP BY frame_id""",
    "residual_summary": f"""SELECT pair, count(*) AS n, {_r6('avg(diff)')} AS centre, {_r6('stddev_samp(diff)')} AS width,
        {_r6('quantile_cont(diff, 0.5)')} AS median,
        {_r6('(quantile_cont(diff, 0.75) - quantile_cont(diff, 0.25)) / 2')} AS quartile_width
        FROM residuals WHERE diff >= -10 AND diff < 10 GROUP BY pair""",
    "stage_roundtrip": f"""SELECT frame_id, 'run' || (frame_id % 3) AS runname, {_big('size_x', 'size_y', 'id0_x', 'id0_y')}, {_ASYM['x']} FROM wide""",
    "curve_roundtrip": "SELECT 'run1' AS run, 'p' || plane_no AS plane, x, tx FROM curve",
    "mode_table_roundtrip": f"SELECT id, mode_bin, runname AS setting, {_d(0.27)} AS pulse_pc FROM modes",
    "hit_preview": "SELECT event_id, frame_id, CAST(ch AS BIGINT) AS ch, charge FROM hits ORDER BY event_id LIMIT 20",
}


def _with_needed(body: str) -> str:
    """Prefix the common table expressions a statement uses, in definition order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in words & CTE.keys() - needed:
            needed.add(name)
            todo.append(CTE[name])
    if not needed:
        return body
    parts = [f"{name} AS ({text})" for name, text in CTE.items() if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + body


def sql() -> dict[str, str]:
    return {name: _with_needed(body) for name, body in BODIES.items()}
