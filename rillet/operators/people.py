"""Person records: validate, split valid/invalid (raw lines kept), build, render.

All narrow: one projection stage, no shuffle; each line is tokenised once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.people import checks, person_columns, render_person, render_person_labelled

VALID, INVALID = "valid", "invalid"


def validate(lines: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``*keep, name_ok, sex_ok, age_ok, weight_ok, height_ok, size_ok, is_valid``."""
    ok = checks(F.col(value_col))
    return lines.select(*keep, *[c.alias(n) for n, c in ok.items()])


def tag_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``tag, value``: the tagged union of both outputs (raw line kept)."""
    ok = checks(F.col(value_col))["is_valid"]
    return lines.select(F.when(ok, F.lit(VALID)).otherwise(F.lit(INVALID)).alias("tag"),
                        F.col(value_col).alias("value"))


def split_lines(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(valid, invalid)`` raw-line frames from one tagged projection."""
    tagged = tag_lines(lines, value_col)
    return (tagged.where(F.col("tag") == VALID).select("value"),
            tagged.where(F.col("tag") == INVALID).select("value"))


def people(valid_lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``name, sex, age, weight, height, minor`` from (valid) lines."""
    cols = person_columns(F.col(value_col))
    return valid_lines.select(*[c.alias(n) for n, c in cols.items()])


def valid_people(lines: DataFrame, value_col: str = "value") -> DataFrame:
    ok = checks(F.col(value_col))["is_valid"]
    return people(lines.where(ok), value_col)


def people_text(persons: DataFrame) -> DataFrame:
    return persons.select(render_person().alias("line"))


def people_labelled(persons: DataFrame) -> DataFrame:
    return persons.select(render_person_labelled().alias("line"))


def table_rows(persons: DataFrame) -> DataFrame:
    """The five table columns (name, sex, age, weight, height)."""
    return persons.select("name", "sex", "age", "weight", "height")
