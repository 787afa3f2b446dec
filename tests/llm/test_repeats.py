from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from snaploom.llm import repeats
from snaploom.llm.repeats import RepeatIndex, found_repeats, number_key

COLUMNS = "source_index bigint, batch_no int, jurisdiction string, permit_date date, tracking_raw string, raw_apn string, formatted_apn string, street_address string, standard_address string, latitude string, longitude string, row bigint, step int, token bigint, place string"
PLACES = [("BURDWICK", "Burdwick", "Distfow", False), ("PESKVALDO", "Peskvaldo", "Distfow", False)]
BASE = dict(jurisdiction="Burdwick", permit_date=date(2024, 3, 4), tracking_raw="B24-00017", raw_apn="123-456-789", formatted_apn="123|456|789", street_address="100 N Heron St Unit 3", standard_address="", latitude="", longitude="", row=1, step=1, token=1, place="x")


@pytest.fixture(scope="module")
def listed(spark):
    return spark.createDataFrame(PLACES, "juris_key string, juris_display string, county string, unincorporated boolean")


def rows_of(spark, rows):
    return spark.createDataFrame([tuple((dict(source_index=i, batch_no=b) | BASE | more).values()) for i, b, more in rows], COLUMNS)


def test_number_forms():
    same = ["BP-2022-00013", "#bp 2022/00013", "BP202200013", "Permit BP-2022-13", "BP–2022–OOO13", "B.P.-2022-00013"]
    assert {number_key(t) for t in same} == {"BP|22|13"}
    assert number_key("PMT2100018") == "PMT|21|18" and number_key("2100016") == number_key("21-00016")
    assert [number_key(t) for t in (None, "", "none", "N/A", "ADU", "0", "TBD")] == [None] * 7


GAP = dict(permit_date=None)
CASES = [
    (1, 1, {}), (2, 2, {"street_address": "100 north heron street #03"}), (3, 2, {"tracking_raw": "N/A", "jurisdiction": "burdwikc"}), (4, 3, GAP), (5, 3, {"jurisdiction": None}), (6, 4, {"street_address": "", "raw_apn": ""}), (7, 4, {"permit_date": date(2024, 3, 5)}), (8, 4, {}), (8, 4, {}),
    (20, 2, {"street_address": "102 N Heron St", "tracking_raw": "B24-00018"}),  # a sibling
    (21, 2, {"permit_date": date(2024, 9, 9), "tracking_raw": "B24-00090"}),  # later at the same site
    (22, 2, {"permit_date": date(2023, 9, 9), "street_address": "7 Elm Ct", "raw_apn": "999-999-111"}),  # the number used again
    (23, 2, {"street_address": "100 N Heron St Unit 4", "tracking_raw": ""}), (24, 2, {"jurisdiction": "Peskvaldo", "tracking_raw": "B24-00077", "street_address": "1 Oak", "raw_apn": ""}),
    (25, 3, {"street_address": "", "tracking_raw": "B24-00019"}),  # a parcel and a day aren't enough
    (26, 3, dict.fromkeys(BASE)), (27, 3, dict.fromkeys(BASE)),
    (30, 3, {"jurisdiction": "Nowhere Hollow", "tracking_raw": "B24-00500"}), (31, 3, {"jurisdiction": "NOWHERE HOLLOW", "tracking_raw": "b24 500"}),
]
WANT = {(1, b) for b in (2, 3, 4, 5, 6, 7, 8)} | {(30, 31)}


def test_what_repeats_what(spark, listed):
    got = {tuple(r) for r in found_repeats(rows_of(spark, CASES), listed).collect()}
    assert got == WANT


def test_batches_at_once_or_one_by_one_give_the_same_groups(spark, listed):
    def groups(steps):
        index = RepeatIndex(spark, listed)
        for s in steps:
            index.accept(rows_of(spark, s))
        out = {r.row: r.first for r in index.groups().collect()}
        index.close()
        return out

    a, b = [c for c in CASES if c[1] < 3], [c for c in CASES if c[1] >= 3]
    assert groups([a + b]) == groups([a, b]) == groups([b, a])


def test_many_copies_and_empty_table(spark, listed):
    copies = [(i, 1 + (i > 300), {"tracking_raw": "B24-00" + "9" * 3}) for i in range(1, 500)]
    got = {tuple(r) for r in found_repeats(rows_of(spark, copies), listed).collect()}
    assert got == {(1, i) for i in range(301, 500)}
    assert found_repeats(rows_of(spark, []), listed).count() == 0


def test_rows_alike_in_too_few_parts_are_no_copies_within_a_batch_either(spark, listed):
    bare = dict(tracking_raw="", street_address="")
    alike = [bare, bare | dict(raw_apn="", formatted_apn=""), bare | dict(jurisdiction="Peskvaldo")]
    copies = [dict(tracking_raw=""), dict(street_address=""), bare | dict(latitude="1.5", longitude="2.5")]
    apart = [dict(permit_date=date(2024, 1 + i, 5), raw_apn=f"77-{i}1-9", formatted_apn="", street_address=f"{7 + i} Elm{'xyzuvw'[i] * 4} St", tracking_raw=f"B24-0{i}55{i}") for i in range(6)]
    rows = [(10 * i + k, 2, apart[i] | more) for i, more in enumerate(alike + copies) for k in (1, 2)]
    got = found_repeats(rows_of(spark, rows), listed).collect()
    assert sorted(tuple(r) for r in got) == [(31, 32), (41, 42), (51, 52)]


def test_a_later_session_goes_on_and_a_batch_given_again_changes_nothing(spark, listed, tmp_path):
    path = f"file://{tmp_path}/index"
    batches = {n: [c for c in CASES if c[1] == n] for n in (1, 2, 3, 4)}

    def accept(index, n):
        return sorted(tuple(r) for r in index.accept(rows_of(spark, batches[n]), f"batch {n}").collect())

    first = RepeatIndex(spark, listed, path)
    links = [accept(first, n) for n in (1, 2)]
    first.close()
    # what a session lost in the middle of a step leaves behind
    first._open()
    first._append("parts", spark.table(first._name("parts")).drop("step"))
    first.close()
    second = RepeatIndex(spark, listed, path)
    assert second.steps == 2
    links += [accept(second, 3), accept(second, 2), accept(second, 1)]
    assert links[3] == links[1] and links[4] == links[0] and second.steps == 3
    second.compact(buckets=2)
    second.close()
    third = RepeatIndex(spark, listed, path)
    assert third.buckets == 2
    accept(third, 4)
    got = {(r.first, r.row) for r in third.groups().collect() if r.first < r.row}
    assert got == WANT
    third.close()


def test_a_coordinate_of_many_records_pairs_up_few(spark, listed):
    rows = [(i, 1 + i % 2, dict(permit_date=date(2010 + i % 10, 1 + i % 12, 1 + i % 28), tracking_raw=f"B{i % 30}-1{i:05d}", raw_apn=f"9{i:06d}", formatted_apn="", street_address=f"{i} Elm St", latitude="38.5", longitude="-121.5")) for i in range(1, 2001)]
    index = RepeatIndex(spark, listed)
    n = []
    for b in (1, 2):
        index.accept(rows_of(spark, [r for r in rows if r[1] == b]), str(b))
        index.steps -= 1
        n.append(index.candidates(index.steps).count())
        index.steps += 1
    assert sum(n) < 20_000 and index.groups().count() == 0
    index.close()


@pytest.mark.parametrize("rare", [1, 3, 64])
def test_all_pairs_that_a_comparison_of_all_with_all_finds(spark, listed, monkeypatch, rare):
    monkeypatch.setattr(repeats, "RARE", rare)
    dice = random.Random(rare)
    fields = dict(
        jurisdiction=["Burdwick", "Peskvaldo", None], permit_date=[date(2024, 3, d) for d in (4, 5, 20)] + [None], tracking_raw=["B24-00017", "B24-00018", "B23-00444", ""], raw_apn=["123-456-789", "55-1", ""],
        street_address=["100 N Heron St Unit 3", "100 Heron St Unit 3", "100 N Herno St #3", "100 N Heron St", "Heron Street", "", "7 Elm Ct"], latitude=["38.5", ""], longitude=["-121.5"],
    )
    rows = [(i, 1 + i % 4, {k: dice.choice(v) for k, v in fields.items()} | {"formatted_apn": ""}) for i in range(160)]
    index = RepeatIndex(spark, listed)
    links = []
    for b in (1, 2, 3, 4):
        links += [tuple(r) for r in index.accept(rows_of(spark, [r for r in rows if r[1] == b]), str(b)).collect()]
    parts = index._table("parts").where(repeats.LONG_ENOUGH)
    a, b = (parts.selectExpr(*[f"{c} as {x}_{c}" for c in repeats.COLUMNS]) for x in "ab")
    want = {tuple(r) for r in a.join(b, F.col("a_row") < F.col("b_row")).where(repeats.REPEATS).select("a_row", "b_row").collect()}
    index.close()
    assert set(links) <= want and want

    def groups(pairs):
        home = {}

        def find(n):
            while home.setdefault(n, n) != n:
                n = home[n]
            return n

        for x, y in pairs:
            home[max(find(x), find(y))] = min(find(x), find(y))
        return {n: find(n) for n in home}

    assert groups(links) == groups(want)
