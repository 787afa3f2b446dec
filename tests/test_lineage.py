from __future__ import annotations

from snaploom.operators import relational as R


def ends(spark, edges):
    rows = R.lineage_ends(spark.createDataFrame(edges, "node bigint, next bigint")).collect()
    return sorted(((r.node, r.final, r.cyclic) for r in rows), key=repr)


def test_links_to_smaller_rows_are_followed(spark):
    assert ends(spark, [(5, 9), (9, 2), (2, 7), (4, 4), (None, 1), (3, None)]) == [(2, 7, False), (5, 7, False), (9, 7, False)]


def test_cycles_are_reported_and_hide_no_end(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 8), (0, 1), (0, 6), (10, 11), (11, 10), (7, 6)]
    want = [(n, 8, True) for n in (0, 1, 2, 3)] + [(0, 6, True), (7, 6, False), (10, None, True), (11, None, True)]
    assert ends(spark, edges) == sorted(want, key=repr)


def test_no_links(spark):
    assert ends(spark, []) == []
