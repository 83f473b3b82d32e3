"""Column-expression helpers (JVM-side, codegen friendly; no Python UDFs)."""

from rillet.functions.strings import full_match, java_trim, strict_int, strict_long, render_fields
from rillet.functions.times import (
    display_time, epoch_micros, epoch_millis, event_time_from_ms, floor_ms, local_option_to_ms, window_start_ms,
)

__all__ = [
    "full_match", "java_trim", "strict_int", "strict_long", "render_fields",
    "display_time", "epoch_micros", "epoch_millis", "event_time_from_ms", "floor_ms",
    "local_option_to_ms", "window_start_ms",
]
