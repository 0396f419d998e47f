"""Scalar column expressions: zone-fixed time, text normalisation."""
from trafficwatch.functions.text import (
    blank_to_null,
    lookup_key,
    normalize_plate,
    parse_bool,
    parse_number,
    strip,
)
from trafficwatch.functions.timeutil import (
    from_wall,
    iso_text,
    local_date,
    local_text,
    local_time,
    ntz_micros,
    parse_iso_time,
    parse_time,
    seconds_floor,
    utc_wall,
    wall_text,
)

__all__ = [
    "blank_to_null",
    "from_wall",
    "iso_text",
    "local_date",
    "local_text",
    "local_time",
    "lookup_key",
    "normalize_plate",
    "ntz_micros",
    "parse_bool",
    "parse_iso_time",
    "parse_number",
    "parse_time",
    "seconds_floor",
    "strip",
    "utc_wall",
    "wall_text",
]
