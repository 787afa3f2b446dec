from __future__ import annotations

import random
from datetime import date

import pytest

from snaploom.plans.snapshots import Columns, decisions, deduplicated, grow, settle

SCHEMA = (
    "source_index bigint, csv_physical_line bigint, report_year int, jurisdiction string, permit_date date, tracking_raw string, project_raw string, raw_apn string, street_address string, standard_address string, "
    "latitude string, longitude string, acutely_low bigint, extremely_low bigint, very_low bigint, low bigint, moderate bigint, above_moderate bigint, reported_total bigint, unit_category string, tenure string, other_day string, other_count string"
)
DAY = date(2024, 1, 15)


def row(i, year, **more):
    base = dict(source_index=i, csv_physical_line=i, report_year=year, jurisdiction="Example City", permit_date=DAY, tracking_raw="BP-100", project_raw="", raw_apn="", street_address="100 Main Street", standard_address="", latitude="", longitude="", acutely_low=0, extremely_low=0, very_low=0, low=0, moderate=0, above_moderate=1, reported_total=1, unit_category="5+ Units", tenure="Rental", other_day="", other_count="")
    return base | more


def removed(spark, rows, **options):
    out = deduplicated(spark.createDataFrame([tuple(r[f.split()[0]] for f in SCHEMA.split(", ")) for r in rows], SCHEMA), **options).collect()
    assert len(out) == len(rows)
    return {r.source_index: (r.rule, r.matched, r.retained) for r in out if r.decision == "removed"}


SCENARIOS = {
    "two letters swapped are two edits": ([row(1, 2023, street_address="100 N Mian St"), row(2, 2024, street_address="100 North Main Street")], {}),
    "same street": ([row(1, 2023), row(2, 2024, street_address="100 MAIN ST")], {1: "strong_linked_snapshot"}),
    "one edit": ([row(1, 2023, street_address="100 Mainn St"), row(2, 2024)], {1: "strong_linked_snapshot"}),
    "other house": ([row(1, 2023), row(2, 2024, street_address="102 Main Street", tracking_raw="BP-100")], {}),
    "other unit": ([row(1, 2023, street_address="100 Main St Apt 1"), row(2, 2024, street_address="100 Main St Apt 2")], {}),
    "several latest rows are kept": ([row(1, 2023), row(2, 2024), row(3, 2024)], {1: "strong_linked_snapshot"}),
    "undated rows are kept": ([row(1, 2023, permit_date=None), row(2, 2024, permit_date=None)], {}),
    "literal weak group": ([row(1, 2023, tracking_raw="N/A"), row(2, 2024, tracking_raw="N/A")], {1: "weak_literal_snapshot"}),
    "fewer latest rows are guarded": ([row(1, 2022, tracking_raw=""), row(2, 2022, tracking_raw=""), row(3, 2023, tracking_raw="")], {}),
    "residual by the same parcel": ([row(1, 2023, street_address="100 Main St", raw_apn="123-456-789"), row(2, 2024, street_address="88 Oak Ave", raw_apn="123-456-789")], {1: "strong_reliable_snapshot"}),
    "residual by project and house": ([row(1, 2023, street_address="100 Main St", project_raw="Heron Row"), row(2, 2024, street_address="100 Mayne Rd", project_raw="Heron Row")], {1: "strong_reliable_snapshot"}),
    "split into several": ([row(1, 2023, above_moderate=2, reported_total=2, street_address="5 Main St"), row(2, 2024, street_address="7 Main St"), row(3, 2024, street_address="9 Main St")], {1: "strong_aggregate_exception"}),
    "weak project and location": ([row(1, 2023, tracking_raw="", project_raw="Heron Row", tenure="Rental", latitude="1"), row(2, 2024, tracking_raw="", project_raw="Heron Row", latitude="2")], {1: "weak_project_snapshot"}),
    "weak dual location": ([row(1, 2023, tracking_raw="", raw_apn="123-456-789", latitude="1"), row(2, 2024, tracking_raw="", raw_apn="123-456-789", latitude="2")], {1: "weak_dual_location_snapshot"}),
    "weak both": ([row(1, 2023, tracking_raw="", project_raw="Heron Row", raw_apn="123-456-789", latitude="1"), row(2, 2024, tracking_raw="", project_raw="Heron Row", raw_apn="123-456-789", latitude="2")], {1: "weak_project_and_dual_location_snapshot"}),
    "house number out of the parcel": ([row(1, 2023, tracking_raw="", project_raw="Heron Row", raw_apn="100", street_address="Main Street"), row(2, 2024, tracking_raw="", project_raw="Heron Row", raw_apn="123-456-789")], {1: "weak_house_number_in_apn_transform"}),
    "carried forward by parcel": ([row(1, 2023, raw_apn="123-456-789"), row(2, 2024, tracking_raw="ENT-7", raw_apn="123-456-789", street_address="")], {1: "carried_forward_snapshot"}),
    "carried forward needs a signal": ([row(1, 2023), row(2, 2024, tracking_raw="ENT-7", street_address="9 Elm St")], {}),
    "siblings carry nothing": ([row(1, 2023, raw_apn="123-456-789"), row(2, 2024, tracking_raw="BP-101", raw_apn="123-456-789", street_address="102 Main St"), row(3, 2024, tracking_raw="BP-102", raw_apn="123-456-789", street_address="104 Main St")], {}),
}


REUSED = [row(1, 2023, street_address="1 Elm St", raw_apn="123-456-789", latitude="38.55", longitude="-121.45"), row(2, 2024, street_address="900 Oak Ave", raw_apn="123-456-789", latitude="38.55", longitude="-121.45"), row(3, 2024, permit_date=date(2023, 3, 3), street_address="9 Elm St")]
SCENARIOS["reused number with parcel and point"] = (REUSED, {1: "strong_reused_id_exception"})
SCENARIOS["chain of years"] = ([row(1, 2021), row(2, 2022, raw_apn="123-456-789"), row(3, 2023, tracking_raw="ENT-7", raw_apn="123-456-789", street_address="")], {1: "strong_linked_snapshot", 2: "carried_forward_snapshot"})


@pytest.fixture(scope="module")
def outcome(spark):
    """All scenarios in one table, each in a city of its own, forwards and backwards."""
    rows = [r | {"source_index": 100 * n + r["source_index"], "jurisdiction": f"City {n}"} for n, name in enumerate(sorted(SCENARIOS)) for r in SCENARIOS[name][0]]
    forwards, backwards = removed(spark, rows), removed(spark, rows[::-1])
    assert forwards == backwards
    return forwards


@pytest.mark.parametrize("name", sorted(SCENARIOS))
def test_rules(outcome, name):
    n = sorted(SCENARIOS).index(name)
    assert {i - 100 * n: r[0] for i, r in outcome.items() if i // 100 == n} == SCENARIOS[name][1]


def test_lineage_ends_in_the_last_row(outcome):
    n = 100 * sorted(SCENARIOS).index("chain of years")
    assert outcome[n + 1] == ("strong_linked_snapshot", [n + 2], [n + 3])
    assert outcome[n + 2] == ("carried_forward_snapshot", [n + 3], [n + 3])


def test_corroboration_by_another_stage(spark):
    more = dict(above_moderate=6, reported_total=6, other_day="2023-01-01", other_count="6")
    rows = [row(1, 2023, **more), row(2, 2024, tracking_raw="ENT-7", street_address="9 Elm St", **more)]
    columns = Columns(corroboration=("other_day", "other_count"))
    assert {i: r[0] for i, r in removed(spark, rows, columns=columns).items()} == {1: "carried_forward_snapshot"}
    assert removed(spark, rows) == {}


def test_empty_table(spark):
    assert removed(spark, []) == {}


def test_a_vetoed_bridge_is_rejected():
    assert grow([(0, 1, 2), (2, 2, 3), (2, 3, 4)], [(1, 4)]) == {1: 1, 2: 1, 3: 1, 4: 4}
    assert grow([(0, 1, 2), (2, 2, 3)], [(1, 3)]) == {1: 1, 2: 1, 3: 3}


def test_growth_without_vetoes_gives_connected_components():
    rng = random.Random(5)
    edges = [(0, *sorted(rng.sample(range(40), 2))) for _ in range(30)]
    home = grow(edges, [])
    for _, a, b in edges:
        assert home[a] == home[b]
    assert grow(edges[::-1], []) == home


def test_a_move_that_would_split_a_lineage_is_dropped(spark):
    years = {1: 2020, 2: 2021, 3: 2021, 4: 2022, 5: 2023, 6: 2020, 7: 2021}

    def settled(removed, candidates):
        tables = [spark.createDataFrame(list(d.items()), "source_index bigint, refs array<bigint>") for d in (candidates, removed)]
        return {r[0] for r in settle(*tables, spark.createDataFrame(list(years.items()), "source_index bigint, year int")).collect()}

    # row 1 ends in rows 2 and 3; moving both to different years would split it
    assert settled({1: [2, 3]}, {2: [4], 3: [5]}) == set()
    assert settled({1: [2, 3]}, {2: [4], 3: [4]}) == {2, 3}
    # a row that doesn't meet the others moves all the same, and one that points to a moved row ends where that one does
    assert settled({1: [2, 3]}, {2: [4], 3: [5], 7: [5], 6: [7]}) == {7, 6}
    assert settled({1: [2]}, {2: [4], 4: [5]}) == {2, 4}
    assert settled({}, {2: [4, 5]}) == set() and settled({1: [2]}, {}) == set()


def all_at_once(years, removed, candidates):
    """Settlement tried out move by move: every year's largest set of moves is cut down until no lineage is split."""
    toward, gone = dict(removed), set()

    def ends(n, moving):
        if n in moving:
            return {(moving[n], n)}
        return set().union(*(ends(m, moving) for m in toward[n])) if n in toward else {(years[n], None)}

    for year in sorted(set(years.values()), reverse=True):
        moving = {}
        for n in candidates:
            if years[n] == year:
                to = {y for m in candidates[n] for y, _ in ends(m, {})}
                if len(to) == 1:
                    moving[n] = min(to)
        while bad := {m for n in toward for y, m in ends(n, moving) if m is not None and len({y for y, _ in ends(n, moving)}) > 1}:
            moving = {n: y for n, y in moving.items() if n not in bad}
        toward |= {n: candidates[n] for n in moving}
        gone |= moving.keys()
    return gone


def test_settlement_of_random_lineages(spark):
    rng = random.Random(11)
    for _ in range(4):
        years = {i: 2018 + i % 6 for i in range(120)}
        later = {i: [j for j in years if years[j] > years[i] and j // 12 == i // 12] for i in years}
        picks = {i: sorted(rng.sample(later[i], min(len(later[i]), rng.randint(1, 2)))) for i in years if later[i] and rng.random() < 0.7}
        removed = {i: r for i, r in picks.items() if rng.random() < 0.5}
        # the rows removed by earlier rules end in one year each
        ok = {i: r for i, r in removed.items() if len({years[j] for j in r}) == 1 and not any(j in removed for j in r)}
        candidates = {i: r for i, r in picks.items() if i not in ok}
        tables = [spark.createDataFrame(list(d.items()), "source_index bigint, refs array<bigint>") for d in (candidates, ok)]
        got = {r[0] for r in settle(*tables, spark.createDataFrame(list(years.items()), "source_index bigint, year int")).collect()}
        assert got == all_at_once(years, ok, candidates) and got


def test_a_lineage_that_ends_in_several_years_is_an_error(spark):
    every = spark.createDataFrame([(1, 2020), (2, 2021), (3, 2022)], "source_index bigint, year int")
    removals = spark.createDataFrame([(1, "x", 2022, [2, 3], "")], "source_index bigint, rule string, latest_year int, refs array<bigint>, evidence string")
    with pytest.raises(Exception, match="several report years"):
        decisions(every, removals).collect()
