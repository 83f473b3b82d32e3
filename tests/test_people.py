import os

import pytest
from conftest import lines_df, rows

from rillet.operators import people

SAMPLE = """Alex,       M,   41,       74,      170
Bert,       M,   42,       68,      166
Carl,       M,   32,       70,      155
Dave,       M,   39,       72,      167
Elly,       F,   30,       66,      124
Fran,       F,   33,       66,      115
Gwen,       F,   26,       64,      121
Hank,       M,   ,       71,      158
Ivan,       M,   13,       72,      175
Jake,       M,   12,       69,      143
Kate,       F,   47,       69,      139
Luke,       M,   34,       72,      163
Myra,       F,   23,       62,       98
Neil,       M,   16,       75,      160
Omar,       M,   38,       70,      145
Page,       F,   31,       67,      135
Quin,       M,   ,       71,      176
Ruth,       F,   28,       65,      131""".split("\n")


def _valid(spark, line):
    return people.validate(lines_df(spark, [line])).first().is_valid


def test_parse_ignores_sixth_field(spark):
    p = people.people(lines_df(spark, ["Alex, M, 41, 74, 170, false"])).first()
    assert (p.name, p.sex, p.age, p.weight, p.height, p.minor) == ("Alex", "M", 41, 74, 170, False)


def test_split_keeps_raw_lines(spark):
    a = " Alex,       M,   41,       74,      170"
    h = "Hank,       M,   ,       71,      158"
    valid, invalid = people.split_lines(lines_df(spark, [a, h]))
    assert [r.value for r in valid.collect()] == [a]
    assert [r.value for r in invalid.collect()] == [h]


def test_render(spark):
    p = people.people(lines_df(spark, ["Alex, M, 41, 74, 170"]))
    assert people.people_text(p).first().line == "Alex, M, 41, 74, 170, false"
    assert people.people_labelled(p).first().line == \
        "\nName: Alex\tSex: M\tAge: 41\tWeight: 74\tHeight: 170\tMinor: false\n"


def test_sample_file(spark):
    df = lines_df(spark, SAMPLE)
    valid, invalid = people.split_lines(df)
    assert sorted(r.value.split(",")[0] for r in invalid.collect()) == ["Hank", "Quin"]
    ps = people.people(valid)
    assert ps.count() == 16
    assert rows(ps.where("minor"), "name", "age") == [("Ivan", 13), ("Jake", 12), ("Neil", 16)]


@pytest.mark.parametrize("line,ok", [
    ("Hi.,M,45,60,154", False), ("Fred,Male,45,60,154", False), ("Fred,M,Fourty,60,154", False),
    ("Fred,F,40,-60,154", False), ("Fred,M,40,-60,5000", False), ("Fred,M,40,60,150", True),
    ("Fred,M,40,60,5000", False),            # height alone
    ("Fred,|,40,60,150", True),              # the sex rule also admits '|'
    (",M,40,60,150", True),                  # empty name is valid
    ("Mary Ann,F,40,60,150", True),          # two-word name keeps the last word only
    ("Fred ,M,40,60,150", True),             # trailing space before a comma empties the field
    ("Fred,M,40,60,150 ", False),            # trailing space at the end stays in the last field
    ("Fred,M,40,60", False), ("Fred,M,40,60,150,x", False), ("", False), ("Fred,M,1234,60,150", False),
])
def test_rules(spark, line, ok):
    assert _valid(spark, line) is ok


def test_tokeniser_fields(spark):
    p = people.people(lines_df(spark, ["Mary Ann,F,40,60,150", "Fred ,M,  7,60,150"])).collect()
    assert sorted((r.name, r.age, r.minor) for r in p) == [("", 7, True), ("Ann", 40, False)]


def test_reason_columns(spark):
    r = people.validate(lines_df(spark, ["Fred,Male,Fourty,60,5000"])).first()
    assert (r.name_ok, r.sex_ok, r.age_ok, r.weight_ok, r.height_ok, r.size_ok) == (True, False, False, True, False, True)
