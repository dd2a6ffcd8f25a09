from .columns import (  # noqa: F401
    asymmetry,
    dither,
    flip_even_channels,
    in_box,
    inside,
    keyed_uniform,
    linear,
    mean_of,
    row_key,
    ticks_to_ns,
)
from .geometry import (  # noqa: F401
    extrapolate,
    left_right,
    shifted_drift,
    strip_inset,
    strip_position,
    wire_coordinate,
)
