from foldwise.functions.hashing import keyed_hash
from foldwise.functions.scalar import (
    add_float_casts,
    bin_floor_text,
    bin_trunc_text,
    clip,
    clip_numerical_features,
    count_edges,
    floor_text,
    map_values,
    power_columns,
    ratio_of,
    replace_above,
    round_text,
    soft_clip,
    strip_prefix,
)

__all__ = [
    "add_float_casts", "bin_floor_text", "bin_trunc_text", "clip", "clip_numerical_features",
    "count_edges", "floor_text", "keyed_hash", "map_values", "power_columns", "ratio_of",
    "replace_above", "round_text", "soft_clip", "strip_prefix",
]
