"""String expressions with the exact semantics the jobs need."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim strips every char <= U+0020; Spark's trim strips spaces only.
_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
_SIGNED_DIGITS = r"^[+-]?[0-9]+$"


# Every char from U+0000 to U+0020, for Spark's (non-regex) trim with a char set.
_JAVA_TRIM_CHARS = "".join(chr(i) for i in range(0x21))


def java_trim(c: Column) -> Column:
    return F.trim(c, F.lit(_JAVA_TRIM_CHARS))


def full_match(c: Column, pattern: str) -> Column:
    """True when the whole string matches ``pattern`` (alternation-safe)."""
    return c.rlike(r"\A(?:" + pattern + r")\z")


def _strict_number(c: Column, sql_type: str) -> Column:
    # Guard first: a plain cast accepts decimals and spaces that the
    # reference's integer parser rejects.  Overflow becomes NULL.
    return F.when(c.rlike(_SIGNED_DIGITS), c.try_cast(sql_type))


def strict_int(c: Column) -> Column:
    return _strict_number(c, "int")


def strict_long(c: Column) -> Column:
    return _strict_number(c, "bigint")


def render_fields(fields: Mapping[str, Column] | Iterable[tuple[str, Column]]) -> Column:
    """Render ``name: value, name: value`` in the declared field order."""
    items = fields.items() if isinstance(fields, Mapping) else fields
    parts = [F.concat(F.lit(f"{name}: "), F.coalesce(col.cast("string"), F.lit("null")))
             for name, col in items]
    return F.concat_ws(", ", *parts)
