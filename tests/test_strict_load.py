from __future__ import annotations

import csv
import io
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from snaploom.operators.strict_load import RecordShape, load, rejected

SHAPE = RecordShape(fields=4, date_at=2, count_at=3)
SCHEMA = "source_index bigint, raw_line string, line string, offset int, print string"


def reasons(spark, lines):
    rows = [(i, x, "clash", 1, None) for i, x in enumerate(lines)]
    return sorted((r[0], r[1]) for r in rejected(spark.createDataFrame(rows, SCHEMA), SHAPE).collect())


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("a,1/2/2024,3,z", []),
        ('"a,b",2024-1-2,"1,000",z', []),
        ('"say ""hi""\nthere",2024/01/02,3.0,z', []),
        ('x"y,1/2/24,1e3,"', ["quoting"]),
        ('x"y,1/2/24,1e3,', []),
        ('"a"b,1/2/2024,3,z', ["quoting"]),
        ('"a"",1/2/2024,3,z', ["quoting"]),
        ("a,1/2/2024,3", ["column_count"]),
        ("a,1/2/2024,3,z,", ["column_count"]),
        ("", ["column_count"]),
        (None, ["column_count"]),
        ("a,2/30/2024,3,z", ["permit_date"]),
        ("a,2/29/1900,-1,z", ["permit_date", "reported_total"]),
        ("a,1-2-2024,1.5,z", ["permit_date", "reported_total"]),
        ("a,2024-1/2,nan,z", ["permit_date", "reported_total"]),
        ("a, , ,z", []),
        ("a,,-0,z", []),
        ("a,,15e-1,z", ["reported_total"]),
        ("a,,150e-1,z", []),
        ("a,,1e99999999999999999999,z", []),
        ("a,,1e-99999999999999999999,z", ["reported_total"]),
        ("a,,0e-99999999999999999999,z", []),
        ("a,,.,z", ["reported_total"]),
        ("a,0000-01-01,inf,z", ["permit_date", "reported_total"]),
        (' "a",1/2/2024,3,z', []),
    ],
)
def test_reasons(spark, line, expected):
    assert reasons(spark, [line]) == [(0, r) for r in expected]


def test_long_fields_and_many_quotes(spark):
    long = '"' + "x" * 300_000 + '""' * 60_000 + '"'
    assert reasons(spark, [f"{long},1/2/2024,3,z", f"{long}!,1/2/2024,3,z", "," * 200_000]) == [(1, "quoting"), (2, "column_count")]


def test_load_keeps_values(spark):
    rows = [(7, '"a ""b"", c",1/2/68,"1,000",', "l", 1, None), (8, "bad", "l", 1, None)]
    got = load(spark.createDataFrame(rows, SCHEMA), SHAPE).collect()
    assert [(r.source_index, r.raw_values, r.permit_date, r.reported_total) for r in got] == [(7, ['a "b", c', "1/2/68", "1,000", ""], date(2068, 1, 2), 1000)]


def test_records_under_one_offset_are_judged_one_by_one(spark):
    rows = [(1, "a,,3,z", "", 0, ""), (1, "bad", "", 0, ""), (None, "bad", "", 0, ""), (1, "bad", "", 0, "")]
    got = sorted(((r[0] is None, r[1]) for r in rejected(spark.createDataFrame(rows, SCHEMA), SHAPE).collect()))
    assert got == [(False, "column_count"), (False, "column_count"), (True, "column_count")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rejected(empty, SHAPE).count() == 0
    assert load(empty, SHAPE).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.text('ab",\n 1/', max_size=6), min_size=4, max_size=4), min_size=1, max_size=30))
def test_round_trip_of_a_csv_writer(spark, records):
    def line(values):
        out = io.StringIO()
        csv.writer(out, lineterminator="", quoting=csv.QUOTE_ALL).writerow(values)
        return out.getvalue()

    shape = RecordShape(fields=4, date_at=1, count_at=1)
    rows = [(i, line(["", *r[1:]]), "", 0, "") for i, r in enumerate(records)]
    got = {r.source_index: r.raw_values for r in load(spark.createDataFrame(rows, SCHEMA), shape).collect()}
    assert got == {i: ["", *r[1:]] for i, r in enumerate(records)}
