from __future__ import annotations

import pytest

from snaploom.llm.canonical import NONE, Entry, Matcher, edits, entries_of, typed_values

LIST = [("NORTH YATISH", "North Yatish", "Clous", False), ("SOUTH YATISH", "South Yatish", "Dreal", False), ("CONVEY", "Convey", "Dirdpoth", False), ("CONVEY COUNTY", "Convey County (Unincorporated)", "Convey", True), ("JUSPANT MEADOWS", "Juspant Meadows", "Luldward", False), ("LULDWARD COUNTY", "Luldward County (Unincorporated)", "Luldward", True), ("SAINT GIMZOTH", "Saint Gimzoth", "Luldward", False), ("NAISKTOPA HARBOR", "Naisktopa Harbor", "Clous", False)]
SCHEMA = "juris_key string, juris_display string, county string, unincorporated boolean"


@pytest.fixture(scope="module")
def matcher():
    return Matcher([Entry(*e) for e in LIST])


@pytest.mark.parametrize(
    ("typed", "key"),
    [
        ("City of Juspant Mdws", "JUSPANT MEADOWS"), ("juspant meadows, city of ", "JUSPANT MEADOWS"), ("Juspant Meadows (Luldward County)", "JUSPANT MEADOWS"), ("Juspánt Meadows, CA*", "JUSPANT MEADOWS"), ("JUSPANTMEADOWS", "JUSPANT MEADOWS"), ("Jupsant Medows", "JUSPANT MEADOWS"), ("JUSPANT MEAD0WS", "JUSPANT MEADOWS"),
        ("N. Yatish", "NORTH YATISH"), ("so. yatish", "SOUTH YATISH"), ("S-Yatsh", "SOUTH YATISH"), ("ST. GIMZOTH", "SAINT GIMZOTH"),
        ("Convey", "CONVEY"), ("CONVEY CITY", "CONVEY"), ("Convey Co.", "CONVEY COUNTY"), ("County of Convey (uninc)", "CONVEY COUNTY"), ("Unincorporated Convey County", "CONVEY COUNTY"), ("COUNTY OF COVNEY", "CONVEY COUNTY"), ("Convey Cnty", "CONVEY COUNTY"),
        ("Juspant Summit", NONE), ("Naisktopa Hollow", NONE), ("Naisktopa Hts", NONE), ("Broosgell County", NONE), ("Luldward", NONE), ("multiple cities", NONE), ("12", NONE), ("?", NONE), ("City of", NONE), ("Yatish", NONE), ("x" * 20_000, NONE),
    ],
)
def test_resolve(matcher, typed, key):
    assert matcher.resolve(typed) == key


MORE = [*LIST, ("ELK GROVE", "Elk Grove", "Sacra", False), ("SANTA ANA", "Santa Ana", "Orange", False), ("SAN JOSE", "San Jose", "Clara", False)]


@pytest.mark.parametrize(
    ("typed", "key"),
    [
        ("Elk Grove Planning Dept", "ELK GROVE"), ("ELK GROVE 95624", "ELK GROVE"), ("Building Division Elk Grove", "ELK GROVE"), ("Elk Grove USA", "ELK GROVE"), ("Convey Planning", "CONVEY"), ("Planning Division of Luldward County", "LULDWARD COUNTY"),
        ("Grove Elk", "ELK GROVE"), ("Ana Santa", "SANTA ANA"), ("Jose, San", "SAN JOSE"), ("Medows Juspant", "JUSPANT MEADOWS"), ("Grvoe, Elk Planning Dept", "ELK GROVE"), ("Juspnat Medows, Luldward County", "JUSPANT MEADOWS"),
        ("Elk Grove Village", NONE), ("West Elk Grove", NONE), ("Elk Creek", NONE), ("Santa Rosa", NONE), ("Convey Heights", NONE), ("Convey Hieghts", NONE), ("Fooville (Luldward County)", NONE), ("Elk Grove / San Jose", NONE), ("Yatish Harbor", NONE), ("xylophone abc def ghi " * 2000, NONE),
    ],
)
def test_mentions_among_other_words_and_words_in_any_order(typed, key):
    assert Matcher([Entry(*e) for e in MORE]).resolve(typed) == key


def test_edits():
    def plain(a, b):
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    words = ["", "a", "ab", "ba", "abc", "acb", "abcd", "badc", "yatish", "yatsih", "ytaihs"]
    assert all(edits(a, b, 3) == min(plain(a, b), 4) for a in words for b in words)


def test_table_with_nulls_blanks_repeats_and_clashing_columns(spark):
    rows = [(1, None, "k", "t"), (2, "  ", "k", "t"), (3, "Convey", "k", "t"), (4, "convey", "k", "t"), (4, "convey", "k", "t"), (5, "CONVEY COUNTY", "k", "t"), (6, "Elsewhere", "k", "t")]
    p = spark.createDataFrame(rows, "source_index bigint, jurisdiction string, name string, typed string")
    j = spark.createDataFrame([*LIST, LIST[0], (None, None, None, None)], SCHEMA)
    assert sorted(tuple(r) for r in typed_values(p, j).collect()) == [(4, "CONVEY"), (4, "CONVEY"), (6, NONE)]
    assert typed_values(p.limit(0), j).count() == 0
    assert {r.juris_key for r in typed_values(p, j.limit(0)).collect()} == {NONE}


def test_the_size_of_the_list_is_checked(spark):
    with pytest.raises(ValueError):
        entries_of(spark.createDataFrame(LIST, SCHEMA), most=3)
