"""Time expressions that never depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet.model import DISPLAY_FORMAT, DISPLAY_ZONE

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Epoch microseconds of a timestamp column, whether it is NTZ or LTZ."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{name}`)")
    return F.unix_micros(F.col(name))


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds, truncated toward minus infinity."""
    return F.floor(epoch_micros(df, name) / F.lit(1000)).cast("bigint")


# Years 1 to 9999: what a timestamp can show.
_MIN_MS, _MAX_MS = -62_135_596_800_000, 253_402_300_799_999


def event_time_from_ms(ms: Column) -> Column:
    """An instant (TIMESTAMP) from epoch milliseconds; NULL outside the years 1 to 9999.

    Batch windows count in milliseconds, so such rows still count there.
    """
    return F.when(ms.between(_MIN_MS, _MAX_MS), F.timestamp_millis(ms))


def floor_ms(ms: Column, width_ms: int) -> Column:
    """Start of the fixed window of ``width_ms`` that holds epoch ``ms``, in whole milliseconds."""
    return ms - F.pmod(ms, F.lit(width_ms).cast("bigint"))


def window_start_ms(window_col: str = "window") -> Column:
    return F.unix_millis(F.col(f"{window_col}.start"))


def display_time(ms: Column, zone: str = DISPLAY_ZONE, fmt: str = DISPLAY_FORMAT) -> Column:
    """Format epoch ms as wall-clock text in ``zone`` (default Los Angeles).

    Outside the years 1 to 9999 the text is the number itself.
    """
    utc_wall = F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH_NTZ))
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)
    return F.when(ms.between(_MIN_MS, _MAX_MS), F.date_format(local, fmt)).otherwise(ms.cast("string"))


def local_option_to_ms(text: str, fmt: str, zone: str = DISPLAY_ZONE) -> Column:
    """Epoch ms of a wall-clock option string such as ``2015-11-16-16-10`` in ``zone``."""
    wall = F.to_timestamp_ntz(F.lit(text), F.lit(fmt))
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), utc)
