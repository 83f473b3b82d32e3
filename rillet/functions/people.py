"""Person-line field extraction with the reference tokeniser's exact behaviour.

The reference restarts a field at every space -> non-space step and treats
the comma as a non-space, so for a piece ``p`` between commas the field is
``p`` after its last space; the final piece keeps trailing spaces.  Only
U+0020 counts as a space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillet.functions.strings import full_match
from rillet.model import INT_FIELD_PATTERN, NAME_PATTERN, PERSON_FIELDS, SEX_PATTERN

_NON_LAST = r"[^ ]*\z"
_LAST = r"[^ ]* *\z"


def pieces(value: Column) -> Column:
    return F.split(value, ",", -1)


def field(parts: Column, i: int) -> Column:
    """Field ``i`` (NULL when the line has fewer pieces)."""
    piece = F.get(parts, i)
    is_last = F.size(parts) == i + 1
    return F.when(is_last, F.regexp_extract(piece, _LAST, 0)).otherwise(F.regexp_extract(piece, _NON_LAST, 0))


def checks(value: Column) -> dict[str, Column]:
    """One boolean per rule (a missing field fails its rule) and the conjunction."""
    parts = pieces(value)
    f = {name: field(parts, i) for i, name in enumerate(PERSON_FIELDS)}
    ok = {
        "name_ok": F.coalesce(full_match(f["name"], NAME_PATTERN), F.lit(False)),
        "sex_ok": F.coalesce(full_match(f["sex"], SEX_PATTERN), F.lit(False)),
        "age_ok": F.coalesce(full_match(f["age"], INT_FIELD_PATTERN), F.lit(False)),
        "weight_ok": F.coalesce(full_match(f["weight"], INT_FIELD_PATTERN), F.lit(False)),
        "height_ok": F.coalesce(full_match(f["height"], INT_FIELD_PATTERN), F.lit(False)),
        "size_ok": F.size(parts) == len(PERSON_FIELDS),
    }
    valid = ok["name_ok"]
    for k in ("sex_ok", "age_ok", "weight_ok", "height_ok", "size_ok"):
        valid = valid & ok[k]
    ok["is_valid"] = valid
    return ok


def _blank(c: Column) -> Column:
    return c.isNull() | (F.regexp_replace(c, r"\s", "") == "")


def _int_or_zero(c: Column) -> Column:
    return F.when(_blank(c), F.lit(0)).otherwise(c.try_cast("int"))


def person_columns(value: Column) -> dict[str, Column]:
    """name, sex, age, weight, height (blank -> 0) and minor (blank age -> NULL)."""
    parts = pieces(value)
    name, sex, age, weight, height = (field(parts, i) for i in range(5))
    minor = F.when(_blank(age), F.lit(None).cast("boolean")).otherwise(age.try_cast("int") < 18)
    return {"name": name, "sex": sex, "age": _int_or_zero(age), "weight": _int_or_zero(weight),
            "height": _int_or_zero(height), "minor": minor}


def render_person(df_cols: dict[str, Column] | None = None) -> Column:
    """``name, sex, age, weight, height[, true|false]``; nothing appended when minor is NULL."""
    c = df_cols or {k: F.col(k) for k in (*PERSON_FIELDS, "minor")}
    minor_txt = F.when(c["minor"], F.lit("true")).when(~c["minor"], F.lit("false"))
    return F.concat_ws(", ", c["name"], c["sex"], c["age"].cast("string"), c["weight"].cast("string"),
                       c["height"].cast("string"), minor_txt)


def render_person_labelled() -> Column:
    """Labelled, tab-separated form; the reference adds a newline only after ``false``."""
    base = F.concat(F.lit("\nName: "), F.col("name"), F.lit("\tSex: "), F.col("sex"),
                    F.lit("\tAge: "), F.col("age").cast("string"), F.lit("\tWeight: "),
                    F.col("weight").cast("string"), F.lit("\tHeight: "), F.col("height").cast("string"))
    tail = (F.when(F.col("minor"), F.lit("\tMinor: true"))
            .when(~F.col("minor"), F.lit("\tMinor: false\n")).otherwise(F.lit("")))
    return F.concat(base, tail)
