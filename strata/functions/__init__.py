"""Column-expression helpers: all built-in, JVM-side, inside whole-stage codegen."""

from strata.functions.columns import (
    clamp,
    format_card_int,
    format_card_money,
    high_value_flag,
    nanos_to_timestamp,
    pixel_distance,
    row_hash,
    safe_ratio,
    to_date_safe,
    to_timestamp_ntz_safe,
    trunc_int,
)

__all__ = [
    "clamp",
    "format_card_int",
    "format_card_money",
    "high_value_flag",
    "nanos_to_timestamp",
    "pixel_distance",
    "row_hash",
    "safe_ratio",
    "to_date_safe",
    "to_timestamp_ntz_safe",
    "trunc_int",
]
