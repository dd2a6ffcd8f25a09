"""Detector settings. Every number a plan depends on is a field here, so another
detector is another config object rather than another code path."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed value: one TDC tick in nanoseconds (1/1024).
TICK_NS = 0.0009765625

# What identifies a frame. Several runs in one job need ("runname", "frame_id").
FRAME = ("frame_id",)

# Fixed value: leading edges are stored as 0, trailing edges as 1.
LEADING, TRAILING = 0, 1


@dataclass(frozen=True)
class Module:
    """Readout boards that belong to one detector part."""

    fem_type: int
    fem_ids: tuple[int, ...]


@dataclass(frozen=True)
class Box:
    """Open box cut on charge and timing (ns)."""

    charge: tuple[float, float]
    timing: tuple[float, float]


@dataclass(frozen=True)
class PlanePair:
    """Two staggered planes; ``shift`` moves the second one (mm)."""

    first: str
    second: str
    shift: float


@dataclass(frozen=True)
class Station:
    """Average z of one detector view, relative to the common origin (mm)."""

    x: float
    y: float


# Readout boards.
WIRE_MODULE = Module(5, (616, 617, 618))
ANODE_MODULE = Module(5, (614,))
STRIP_MODULE = Module(7, (615,))
TRIGGER_CHANNEL = 4


@dataclass(frozen=True)
class WireConfig:
    frame: tuple[str, ...] = FRAME
    # Fixed values of the wire chambers.
    tick_ns: float = TICK_NS
    wires_per_plane: int = 16
    cell: float = 3.0
    centre_ids: tuple[float, float] = (7.25, 7.75)
    # Per detector, planes in channel-map order (16 ids each).
    detectors: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "dc31": ("x1", "x2", "y1", "y2", "x3", "x4", "y3", "y4"),
            "dc32": ("x1", "x2", "y1", "y2"),
        }
    )
    cuts: dict[str, Box] = field(
        default_factory=lambda: {
            "dc31": Box((10, 150), (-60, 0)),
            "dc32": Box((10, 150), (-60, 0)),
        }
    )
    pairs: tuple[PlanePair, ...] = (
        PlanePair("dc31_x1", "dc31_x2", 0.07),
        PlanePair("dc31_x3", "dc31_x4", 0.04),
        PlanePair("dc31_y1", "dc31_y2", 0.08),
        PlanePair("dc31_y3", "dc31_y4", 0.15),
        PlanePair("dc32_x1", "dc32_x2", -0.08),
        PlanePair("dc32_y1", "dc32_y2", 0.0),
    )
    layer_shift: dict[str, float] = field(
        default_factory=lambda: {
            "dc31_x3": 0.05,
            "dc31_x4": 0.05,
            "dc31_y3": -0.15,
            "dc31_y4": -0.15,
        }
    )
    views: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "dc31_x": ("dc31_x1", "dc31_x2", "dc31_x3", "dc31_x4"),
            "dc31_y": ("dc31_y1", "dc31_y2", "dc31_y3", "dc31_y4"),
            "dc32_x": ("dc32_x1", "dc32_x2"),
            "dc32_y": ("dc32_y1", "dc32_y2"),
        }
    )
    # z of the x and y views of the two stations (mm): station z plus the mean
    # plane offset.
    upstream: Station = Station(-271.5 - 2.8, -271.5 + 3.2)
    downstream: Station = Station(787.97 - 3.0, 787.97 + 3.0)
    # output suffix -> z of the plane to extrapolate to
    targets: dict[str, float] = field(default_factory=lambda: {"z229": 229.2, "z400": 400.7})
    # take the exact fraction of a curve interval instead of a dithered one
    exact_fraction: bool = False

    @property
    def planes(self) -> tuple[str, ...]:
        return tuple(f"{d}_{p}" for d, names in self.detectors.items() for p in names)

    @property
    def half_cell(self) -> float:
        return self.cell / 2.0


@dataclass(frozen=True)
class StripConfig:
    frame: tuple[str, ...] = FRAME
    # Fixed values of the strip detector.
    tick_ns: float = TICK_NS
    window: tuple[float, float] = (-50, 300)
    max_size: int = 7
    half_strip: dict[str, float] = field(
        default_factory=lambda: {"x": 2.55 / 2.0, "y": -2.58 / 2.0}
    )
    centre_strip: dict[str, int] = field(default_factory=lambda: {"x": 16, "y": 16})
    flip_even_channels: bool = False
    exact_fraction: bool = False
    # turn the inset round so that it points the way positions do
    mirror_fix: bool = False

    @property
    def sides(self) -> tuple[str, ...]:
        return tuple(self.half_strip)


# The two preamplifier set-ups: window after time zero, and edge polarity.
RPA_STRIPS = StripConfig(window=(-50, -30))
ASAGI_STRIPS = StripConfig(window=(-50, 300), flip_even_channels=True)


@dataclass(frozen=True)
class Bins:
    """``n`` equal half-open bins over ``[lo, hi)``."""

    lo: float
    hi: float
    n: int

    @property
    def width(self) -> float:
        return (self.hi - self.lo) / self.n


# Fixed values of the calibration jobs.
CDF_TOLERANCE = 1e-3
DRIFT_BINS = Bins(-50.0, 0.0, 250)
DRIFT_CHARGE_BINS = Bins(20.0, 120.0, 250)
DRIFT_BOX = Box((30, 120), (-60, 0))
ASYMMETRY_BINS = Bins(0.0, 0.4, 400)
PULSER_ID_BINS = Bins(-0.5, 32.5, 33)
PULSER_CHARGE_BINS = Bins(0.0, 500.0, 500)
RESIDUAL_BINS = Bins(-0.5, 0.5, 200)
RESIDUAL_PAIRS = (
    ("dc31_x1", "dc31_x3"),
    ("dc31_y1", "dc31_y3"),
    ("dc31_x1", "dc31_x2"),
    ("dc31_x1", "dc31_x4"),
    ("dc31_y1", "dc31_y2"),
    ("dc31_y1", "dc31_y4"),
    ("dc32_x1", "dc32_x2"),
    ("dc32_y1", "dc32_y2"),
)
RESOLUTION_LIMIT = 0.8
