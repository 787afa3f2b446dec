from __future__ import annotations

from itertools import combinations

import pytest

from snaploom.llm.addresses import Address, parcel, parse
from snaploom.llm.canonical import edits
from snaploom.llm.same_address import links, same_location

SCHEMA = "address_id bigint, jurisdiction_display string, street_address string, standard_address string, formatted_apn string, form int, place string, window string"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2203 E. Stinddell Street - Apt 3", Address("2203", "E", "STINDDELL", "ST", "3")), ("Naldben Pl., 7616, #19", Address("7616", None, "NALDBEN", "PL", "19")), ("UNIT #036, 6432 HOOZICK COURT", Address("6432", None, "HOOZICK", "CT", "36")),
        ("3188 So. Clovering Dr. Burdwick CA", Address("3188", "S", "CLOVERING", "DR", None)), ("1358 Nmbell Ct. W", Address("1358", "W", "NMBELL", "CT", None)), ("2232 Maskering WAY - Lot #B Burdwick, CA", Address("2232", None, "MASKERING", "WAY", "LOT B")),
        ("3188 so. clovering", Address("3188", "S", "CLOVERING", None, None)), ("TBD", None), ("  ", None), (None, None), ("12", None),
    ],
)
def test_parse(text, want):
    assert parse(text, "BURDWICK") == want


def test_parcels():
    assert parcel("756|48|624") == parcel("756-048-624") == parcel("756048624") == parcel("APN 756.048.624 ") == "756|48|624"
    assert [parcel(x) for x in (None, "", "TBD", "0", "UNKNOWN", "000-000-000")] == [None] * 6


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, "p", "w") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in same_location(df).collect())


def test_locations(spark):
    b = "Burdwick"
    rows = [
        (1, b, "100 N Heron St Unit 3", "", ""), (2, "BURDWICK", "", "100 heron st #003", "1|2|3"), (3, b, "100 N Hreon Street Apt 3", None, "TBD"),  # one place
        (4, b, "100 N Heron St Unit 4", "", "1|2|3"), (5, b, "102 N Heron St Unit 3", "", ""), (6, b, "101 S Hreon St Unit 3", "", ""), (7, "Elsewhere", "100 N Heron St Unit 3", "", ""),  # others
        (10, b, "5 Elm Ct", "", "7|7|1"), (11, b, "5 Elm Dr", "", "7|7|2"), (12, b, "5 Elm", "", "7|7|2"), (13, b, "5 Elm", "", ""),  # a missing type, with and without a parcel that decides
        (20, b, None, "N/A", "9|9|9"), (21, b, "8 Oak Ave", "", "9|9|9"), (22, b, "", "", "009-009-009"), (23, b, "", "", ""), (24, b, None, None, None), (25, None, None, None, "4|4|4"), (26, None, "", "", "4|4|4"),
        (30, b, "", "", "1|2|3"), (31, b, "", "", "1-2-3"),  # a parcel with two locations
        (40, b, "9 " + "Long" * 20_000 + " St", "", ""), (41, b, "9 " + "Long" * 20_000 + " Street", "", ""), (41, b, "9 " + "Long" * 20_000 + " Street", "", ""),
    ]
    same = [(1, 2, 3), (11, 12), (20, 21, 22), (25, 26), (30, 31), (40, 41)]
    assert found(spark, rows) == sorted(p for g in same for p in combinations(g, 2))


def test_a_missing_direction_with_two_choices_stays_apart(spark):
    b = "Burdwick"
    assert found(spark, [(1, b, "3 N Heron St", "", "1|1|1"), (2, b, "3 S Heron St", "", "2|2|2"), (3, b, "3 Heron St", "", ""), (4, b, "3 Heron St", "", "2|2|2")]) == [(2, 4)]


def test_errors_at_both_ends_of_a_street_meet_by_parcel_or_a_third_spelling(spark):
    b = "Burdwick"
    assert found(spark, [(1, b, "7 Xeron St", "", "5|5|5"), (2, b, "7 Herox St", "", "5|5|5")]) == []  # short: one error only
    assert found(spark, [(1, b, "7 Xaskering St", "", "5|5|5"), (2, b, "7 Maskerinx St", "", "5|5|5")]) == [(1, 2)]
    assert found(spark, [(1, b, "7 Xaskering St", "", ""), (2, b, "7 Maskerinx St", "", ""), (3, b, "7 Maskering St", "", "")]) == [(1, 2), (1, 3), (2, 3)]


def test_errors_at_both_ends_of_a_street_meet_without_a_parcel(spark):
    b = "Burdwick"
    same = [("Xaskering", "Maskerinx"), ("Amskering", "Maskerign"), ("Xmaskering", "Maskeringx"), ("Maaskering", "Maskerin"), ("Oak", "Oek"), ("Ok", "Oak"), ("Pine", "Pnie"), ("Oak", "Oka"), ("Elm", "Lem"), ("Marplewood", "Amrplewodo")]
    rows = [(2 * i + k, b, f"{i + 1} {name} St", "", "") for i, pair in enumerate(same) for k, name in enumerate(pair)]
    others = [(100, b, "90 A St", "", ""), (101, b, "90 B St", "", ""), (102, b, "91 101 St", "", ""), (103, b, "91 111 St", "", ""), (104, b, "92 Xeron St", "", ""), (105, b, "92 Herox St", "", "")]
    assert found(spark, rows + others) == [(2 * i, 2 * i + 1) for i in range(len(same))]


def test_every_pair_of_streets_that_compares_as_alike_meets(spark):
    import random

    pick = random.Random(5)
    streets = set()
    for _ in range(60):
        base = [pick.choice("ABCD") for _ in range(pick.randint(3, 9))]
        streets.add("".join(base))
        for _ in range(4):
            word = base[:]
            for at in pick.sample(range(len(base)), 2):
                word[at : at + 1] = pick.choice([[], [pick.choice("ABCD")], [*word[at : at + 1], "A"]])
            streets.add("".join(word))
    words = sorted(s for s in streets if len(s) > 2)
    forms = spark.createDataFrame([(i, "P", "1", None, None, None, [s], None) for i, s in enumerate(words)], "form bigint, place string, house string, unit string, direction string, kind string, streets array<string>, parcel string")
    most = {(i, j): 2 if min(len(a), len(b)) > 5 else 1 for (i, a), (j, b) in combinations(enumerate(words), 2)}
    want = {p for p, m in most.items() if edits(words[p[0]], words[p[1]], m) <= m}
    met = {tuple(r) for r in links(forms).collect()}
    # all meet that keep two letters; shorter remains are streets of their own
    assert met <= want and {p for p in want - met if min(len(words[p[0]]), len(words[p[1]])) > 3} == set()


def test_empty_table(spark):
    assert found(spark, []) == []
