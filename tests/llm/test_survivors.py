from __future__ import annotations

import random
from datetime import date, datetime

from snaploom.llm.survivors import choices, survivors

SCHEMA = "ledger_id bigint, dup_group bigint, report_year int, retained_report_year int, project_raw string, street_address string, permit_date date, tenure string, reported_total bigint, acutely_low bigint, extremely_low bigint, very_low bigint, low bigint, moderate bigint, above_moderate bigint, loaded_at timestamp, field_name string, rank int, retained string, of_group int"
FIELDS = ("project_raw", "street_address", "permit_date", "tenure", "reported_total")


def row(i, group, **more):
    base = dict(ledger_id=i, dup_group=group, report_year=2020, retained_report_year=None, project_raw=None, street_address=None, permit_date=None, tenure=None, reported_total=None, acutely_low=0, extremely_low=0, very_low=0, low=0, moderate=0, above_moderate=1, loaded_at=datetime(2021, 1, 1), field_name="clash", rank=1, retained="x", of_group=0)
    return base | more


def chosen(spark, rows):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    return {(r.dup_group, r.field_name): r.ledger_id for r in choices(df).collect()}


def test_retained_year_then_year_then_load_then_id(spark):
    rows = [
        row(1, 1, report_year=2022, tenure="Owner"), row(2, 1, report_year=2021, retained_report_year=2021, tenure="Renter"), row(3, 1, report_year=2021, tenure="R", loaded_at=datetime(2022, 1, 1)),
        row(4, 2, tenure="O", retained_report_year=2030), row(5, 2, tenure="O", report_year=2021), row(6, 2, tenure="O", report_year=2021), row(7, 2, tenure="O", report_year=2021, loaded_at=None), row(8, 2, tenure="O", report_year=None),
    ]
    assert chosen(spark, rows) == {(1, "tenure"): 3, (2, "tenure"): 5}


def test_what_counts_as_filled(spark):
    rows = [row(i, i, project_raw=t) for i, t in enumerate(["", "  ", " ", "-", "?", "tbd", "N/A", "n/a.", "Not available", "NULL", "unknown"])]
    rows += [row(20, 20, permit_date=date(1999, 12, 31)), row(21, 21, permit_date=date(2031, 1, 1)), row(22, 22, permit_date=date(2030, 12, 31)), row(23, 23, reported_total=2), row(24, 24, reported_total=1), row(25, 25, reported_total=0, above_moderate=None), row(26, 26, street_address="Ñ"), row(27, 27, project_raw="NA Homes")]
    assert chosen(spark, rows) == {(22, "permit_date"): 22, (24, "reported_total"): 24, (25, "reported_total"): 25, (26, "street_address"): 26, (27, "project_raw"): 27}


def test_null_group_copies_long_texts_and_empty_table(spark):
    rows = [row(1, None, tenure="x" * 200_000), row(1, None, tenure="x" * 200_000), row(2, None, tenure="y")]
    assert chosen(spark, rows) == {(None, "tenure"): 1}
    assert chosen(spark, []) == {}


def test_survivor_takes_each_field_from_its_row(spark):
    rows = [row(1, 1, tenure="Owner", report_year=2021), row(2, 1, project_raw="Heron Row", reported_total=1), row(3, 2)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    got = {r.dup_group: (r.project_raw, r.tenure, r.reported_total) for r in survivors(df).collect()}
    assert got == {1: ("Heron Row", "Owner", 1), 2: (None, None, None)}


def test_hot_group_agrees_with_brute_force(spark):
    rng = random.Random(3)
    pick = lambda *x: rng.choice(x)
    rows = [row(i, pick(1, 1, 1, 2, 3), report_year=pick(None, 2019, 2020, 2021), retained_report_year=pick(None, None, 2019, 2020), project_raw=pick(None, "TBD", "A", "B"), tenure=pick("", "O"), loaded_at=pick(None, datetime(2021, 1, 1), datetime(2022, 1, 1))) for i in range(600)]
    want = {}
    for g in (1, 2, 3):
        own = [r for r in rows if r["dup_group"] == g]
        kept = max((r["retained_report_year"] for r in own if r["retained_report_year"]), default=None)
        for f, bad in (("project_raw", (None, "TBD")), ("tenure", ("",))):
            some = [r for r in own if r[f] not in bad]
            some = [r for r in some if r["report_year"] == kept and kept] or some
            best = min(some, key=lambda r: (-(r["report_year"] or 0), -(r["loaded_at"] or datetime(1970, 1, 2)).timestamp(), r["ledger_id"]))
            want[g, f] = best["ledger_id"]
    assert chosen(spark, rows) == want
