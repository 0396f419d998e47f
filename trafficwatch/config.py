"""Settings of the detection job and of the reporting queries.

Everything that the reference reads from environment variables is a field of one
frozen dataclass here; callers pass a modified copy (``with_values``) instead of
mutating globals, and ``Settings.from_env()`` reads the same upper-case variable
names for drop-in configuration.
"""
from __future__ import annotations

from dataclasses import dataclass, fields, replace

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's values for identical results
# (names, enumerations, text formats). Stated plainly, in their natural order.
# ---------------------------------------------------------------------------
TIMEZONE = "Asia/Manila"

TELEMETRY_FIELDS = (
    "event_id",
    "camera_id",
    "plate_number",
    "vehicle_type",
    "latitude",
    "longitude",
    "speed_kph",
    "traffic_light_state",
    "stop_line_crossed",
    "event_time",
)
CAMERA_FIELDS = (
    "camera_id",
    "location_name",
    "road_name",
    "city",
    "latitude",
    "longitude",
    "speed_limit_kph",
    "camera_type",
)
REQUIRED_FIELDS = ("camera_id", "plate_number", "latitude", "longitude", "speed_kph", "event_time")

CAMERA_TYPES = ("SPEED", "INTERSECTION", "NO_PARKING")
TRUE_TOKENS = ("true", "1", "yes", "y", "t")

SPEEDING = "SPEEDING"
BEATING_RED_LIGHT = "BEATING_RED_LIGHT"
ILLEGAL_PARKING = "ILLEGAL_PARKING"
VIOLATION_TYPES = (BEATING_RED_LIGHT, SPEEDING, ILLEGAL_PARKING)
TICKET_STATUS = "PENDING_REVIEW"

SPEEDING_EVIDENCE = (
    "Average %.1f kph (max %.1f kph) over %d readings in a %s sliding window; limit %d kph"
)
RED_LIGHT_EVIDENCE = "Crossed the stop line on RED at %.1f kph"
PARKING_EVIDENCE = "Stationary for %d s in a no-parking zone (%d readings); grace period %d s"


# Registry sanity box (Metro Manila), exclusive bounds.
LAT_BOUNDS = (14.3, 14.8)
LON_BOUNDS = (120.9, 121.2)

# Event-time gap between two replay passes of a data set.
REPLAY_GAP_SECONDS = 10


@dataclass(frozen=True)
class Settings:
    """Thresholds, windows and the zone of the detection and reporting jobs."""

    timezone: str = TIMEZONE
    watermark_delay: str = "30 seconds"
    trigger_interval: str = "10 seconds"

    speed_window_duration: str = "1 minute"
    speed_window_slide: str = "20 seconds"
    speed_tolerance_kph: float = 0.0
    min_speed_readings: int = 2

    red_light_min_speed_kph: float = 5.0

    parking_max_speed_kph: float = 3.0
    parking_session_gap_seconds: int = 120
    parking_grace_seconds: int = 180

    stats_window_duration: str = "1 minute"
    stats_window_slide: str = "30 seconds"

    # Serving side.
    api_lookback_minutes: int = 30
    api_full_reload_seconds: int = 300
    per_minute_span_minutes: int = 5
    violations_limit: int = 300
    plate_limit: int = 100
    cli_limit: int = 50

    def __post_init__(self) -> None:
        for name in ("watermark_delay", "trigger_interval", "speed_window_duration",
                     "speed_window_slide", "stats_window_duration", "stats_window_slide"):
            if duration_seconds(getattr(self, name)) <= 0:
                raise ValueError(f"{name} must be a positive duration")
        for window, slide in (("speed_window_duration", "speed_window_slide"),
                              ("stats_window_duration", "stats_window_slide")):
            if duration_seconds(getattr(self, slide)) > duration_seconds(getattr(self, window)):
                raise ValueError(f"{slide} must not exceed {window}")
        if self.parking_session_gap_seconds <= 0 or self.parking_grace_seconds < 0:
            raise ValueError("parking gap must be positive and grace not negative")
        if self.min_speed_readings < 1 or self.speed_tolerance_kph < 0:
            raise ValueError("min_speed_readings must be >= 1 and speed_tolerance_kph >= 0")

    @classmethod
    def from_env(cls, environ=None) -> Settings:
        """Settings from environment variables named like the fields in upper
        case (``WATERMARK_DELAY``, ``SPEED_TOLERANCE_KPH``, ...); the session gap
        is also read as a duration from ``PARKING_SESSION_GAP`` ("2 minutes")."""
        import os

        env = os.environ if environ is None else environ
        values = {f.name: env[f.name.upper()] for f in fields(cls) if f.name.upper() in env}
        if "PARKING_SESSION_GAP" in env and "parking_session_gap_seconds" not in values:
            values["parking_session_gap_seconds"] = duration_seconds(env["PARKING_SESSION_GAP"])
        return cls().with_values(values)

    def with_values(self, values) -> Settings:
        """A copy with the given fields replaced; text values are converted to
        the field's type."""
        types = {f.name: f.type for f in fields(self)}
        unknown = sorted(set(values) - set(types))
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        cast = {"int": int, "float": float, "str": str}
        converted = {k: cast[types[k]](v) if isinstance(v, str) else v for k, v in values.items()}
        return replace(self, **converted)

    @property
    def parking_session_gap(self) -> str:
        return f"{self.parking_session_gap_seconds} seconds"

    @property
    def watermark_seconds(self) -> int:
        return duration_seconds(self.watermark_delay)


_UNITS = {"microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60, "hour": 3600,
          "day": 86400, "week": 604800}


def duration_seconds(text: str) -> int | float:
    """Seconds of a fixed-length Spark interval: ``"20 seconds"``, ``"1 minute 30 seconds"``,
    ``"500 milliseconds"``, ``"interval 1 day"``. Whole seconds come as an int."""
    words = text.lower().removeprefix("interval ").split() if isinstance(text, str) else []
    try:
        if not words or len(words) % 2:
            raise ValueError
        micros = sum(round(float(n) * _UNITS[unit.rstrip("s")] * 1_000_000)
                     for n, unit in zip(words[::2], words[1::2], strict=True))
    except (ValueError, KeyError):
        raise ValueError(f"not a duration like '30 seconds': {text!r}") from None
    return micros // 1_000_000 if micros % 1_000_000 == 0 else micros / 1_000_000


DEFAULT = Settings()
