from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from snaploom.plans import audits, changes, periods, series, sync


def test_planning_periods_have_two_days_in_order(spark):
    texts = ["1/31/2023-01/31/2031", " 01/15/23 - 2031/1/5 ", "2023-01-01-2031-01-01", "02/30/2023-01/31/2031", "01/31/2031-01/31/2023", "01/31/2023", "", None]
    got = [r.p for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", periods.planning_period(F.col("t")).alias("p")).orderBy("i").collect()]
    assert [tuple(p) if p else None for p in got] == [(date(2023, 1, 31), date(2031, 1, 31)), (date(2023, 1, 15), date(2031, 1, 5)), None, None, None, None, None, None]
    with pytest.raises(ValueError):
        periods.cutoff_day(2017)


def test_periods_tell_what_is_wrong_and_required_raises(spark):
    rows = spark.createDataFrame([("A", "1/1/2020-1/1/2028", "TRUE", "5"), ("B", "x", "no", "1.5"), (None, "1/1/2020-1/1/2028", "false", None), ("C", "1/1/2020-1/1/2028", "TRUE", ""), ("C", "1/1/2020-1/1/2028", "TRUE", ""), ("S", "1/1/2019-1/1/2027", "TRUE", "1"), ("T", "1/1/2018-1/1/2026", "TRUE", "1")], "key string, period string, started string, units string")
    fixed = spark.createDataFrame([(k, "1/1/2019-1/1/2027", "1/1/2023-1/1/2031") for k in "ST"], "key string, old string, new string")
    found = periods.periods(rows, "key", "period", "started", ["units"], fixed)
    problems = {(r.key, tuple(r.problems)) for r in found.collect()}
    assert problems == {("A", ()), ("B", ("no period", "no flag", "not a count: units")), (None, ("no key",)), ("C", ("repeated key",)), ("S", ()), ("T", ("neither the old nor the new period",))}
    assert {r.start for r in found.where("key in ('S', 'T')").collect()} == {date(2023, 1, 1)}
    assert periods.required(found.where("key = 'A'")).count() == 1
    with pytest.raises(Exception, match="no period"):
        periods.required(found).collect()
    assert periods.periods(rows.limit(0), "key", "period", "started").count() == 0


def test_plans_are_bound_to_their_digest_and_leave_nothing_to_do(spark):
    maps = "key string, fields map<string,string>, n bigint"
    target = spark.createDataFrame([("a", {"x": "1", "y": "2"}, 1), ("b", {"x": "1"}, 1), ("c", {}, 2), ("d", {}, 1), (None, {"x": "1"}, 1)], maps)
    source = spark.createDataFrame([("a", {"x": "3"}, 1), ("b", {"x": "1"}, 1), ("c", {}, 1), ("e", None, 1), (None, {"x": "1"}, 1)], maps)
    plan = changes.change_plan(target, source, "key", ["x"])
    rows = {(r.key, r.route, tuple(r.blockers)) for r in plan.collect()}
    assert rows == {("a", "change", ()), ("b", "unchanged", ()), ("c", "blocked", ("ambiguous target",)), ("d", "blocked", ("no source",)), ("e", "blocked", ("no target",)), (None, "blocked", ("no source",)), (None, "blocked", ("no target",))}
    assert {tuple(r) for r in changes.updates(plan, "key").collect()} == {("a", "x", "1", "3"), ("a", "y", "2", None)}
    gates = changes.gates(plan).first()
    assert (gates.blocked, gates.change, gates.eligible, gates.complete) == (5, 1, False, False)
    digest = changes.plan_digest(plan, "key").first().digest
    assert digest == changes.plan_digest(plan.repartition(5), "key").first().digest
    assert changes.verified(plan, "key", digest).count() == plan.count()
    with pytest.raises(Exception, match="has changed"):
        changes.verified(plan.where("key = 'a'"), "key", digest).collect()
    after = sync.applied(target.where("n = 1 and key is not null"), sync.map_changes(target.where("n = 1"), source, "key"), "key")
    assert sync.map_changes(after, source, "key").count() == 0
    assert changes.gates(plan.limit(0)).first().complete


def test_cells_reuse_blank_records(spark):
    records = spark.createDataFrame([(1, "A/1", False), (2, "A/2", False), (3, "A/2", False), (4, None, True), (5, None, True), (6, None, False), (7, "Z", False)], "record int, identity string, blank boolean")
    cells = spark.createDataFrame([("A/1",), ("A/2",), ("B/1",), ("B/2",), ("B/3",)], "identity string")
    got = {tuple(r) for r in changes.routed_cells(records, cells, "identity", "record").collect()}
    assert got == {("A/1", 1, "matched"), ("A/2", 2, "repeated"), ("A/2", 3, "repeated"), (None, 6, "unidentified"), ("Z", 7, "orphan"), ("B/1", 4, "reuse"), ("B/2", 5, "reuse"), ("B/3", None, "create")}
    spare = {tuple(r) for r in changes.routed_cells(records, cells.limit(0), "identity", "record").collect()}
    assert (None, 4, "spare") in spare and ("A/1", 1, "orphan") in spare


def test_checks_count_failures_and_show_the_first(spark):
    rows = spark.range(100).selectExpr("id", "if(id % 3 = 0, null, id) as v")
    r = audits.check(rows, "v > 40", "lpad(id, 3, '0')", "d", "c").first()
    assert (r.status, r.objects_checked, r.failures, len(r.evidence), r.evidence[0]) == ("fail", 100, 39, 25, "041")
    r = audits.check(rows.limit(0), "v > 40", "id", "d", "c").first()
    assert (r.status, r.objects_checked, r.evidence) == ("pass", 0, [])


def record(**more):
    values = [""] * 69
    for at, v in more.items():
        values[int(at[1:]) - 1] = v
    return values


def test_series_counts_units_once_for_each_programme(spark):
    base = dict(c1="A Town", c3="2024", c24="1", c25="2", c34="4", c35="2/1/2024", c36="7", c9="5+", c51="SB 35 (2017); Y, SB 9 (2021) - Residential Lot Split;none", c61="12.5%")
    rows = [(1, record(**base)), (2, record(**(base | dict(c35="", c9="5+ Units", c51="N", c61="2")))), (3, record(c1="Elsewhere", c35="5/1/2024", c36="1")), (4, record(c1="A TOWN"))]
    loaded = spark.createDataFrame(rows, "source_index bigint, raw_values array<string>")
    places = spark.createDataFrame([("A TOWN", "A Town"), ("B", "B")], "juris_key string, juris_display string")
    each = series.located(series.stage_rows(loaded), places)
    assert sorted((r.source_index, r.stage, r.juris_key, r.total) for r in each.collect()) == [(1, "permit", "A TOWN", 7), (2, "permit", "A TOWN", 7), (3, "permit", None, 0)]
    cell = series.cells(each).where("juris_key = 'A TOWN'").first()
    assert (cell.year, cell.quarter, cell.vli, cell.ami, cell.total, cell.deed_restricted, cell["5_plus"], cell.sb35, cell.sb9, cell.density_bonus) == (2024, 1, 3, 4, 7, 1, 7, 7, 7, 0)
    assert each.where("bonus_unread").count() == 1
    wide = series.series(each, each.where("juris_key is not null"), places, 2023, 2024, F.lit("2025-01-01").cast("date"))
    assert wide.count() == 16 and {r.data_flags for r in wide.where("year = 2024 and juris_key = 'A TOWN'").collect()} == {"provisional_year"}
    assert {r.data_flags for r in wide.where("year = 2023").collect()} == {"no_apr_rows"}
    assert all(r.failures == 0 for r in series.series_checks(wide, places, 2023, 2024).collect())
    assert series.cells(each.limit(0)).count() == 0
