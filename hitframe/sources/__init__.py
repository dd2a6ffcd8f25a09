from .stages import (  # noqa: F401
    commit_runs,
    committed_runs,
    materialise,
    open_bucketed,
    pending_runs,
    preview,
    read_stage,
    select_by_suffix,
    union_runs,
    write_bucketed,
    write_curves,
    write_mode_table,
    write_stage,
)
from .tables import (  # noqa: F401
    read_blocks,
    read_curve_files,
    read_curves,
    read_linear_calibration,
    read_mode_table,
    read_strip_map,
    read_wire_map,
)
