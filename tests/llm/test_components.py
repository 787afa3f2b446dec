from __future__ import annotations

import random

from snaploom.llm.components import audit_groups, components, groups


def brute(pairs):
    home = {}

    def find(x):
        while home.setdefault(x, x) != x:
            x = home[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        home[max(a, b)] = min(a, b)
    return {x: find(x) for x in home}


def found(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    return {r.node: r.group_id for r in components(df).collect()}


def test_random_graph_chain_star_and_reversed_edges(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(1000, 1100)]
    star = [(5000, 5000 + i) for i in range(1, 200)]
    shuffled = list(range(2000, 2064))
    rng.shuffle(shuffled)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + chain + star + list(zip(shuffled, shuffled[1:]))
    pairs += [(b, a) for a, b in pairs[:50]] + [(7, 7)]
    want = {n: g for n, g in brute([p for p in pairs if p[0] != p[1]]).items()}
    assert found(spark, pairs) == want


def test_nulls_loops_and_empty(spark):
    assert found(spark, [(None, 1), (2, None), (3, 3)]) == {}
    assert found(spark, []) == {}
    v = spark.createDataFrame([(1,), (2,), (2,), (None,)], "node bigint")
    e = spark.createDataFrame([(2, 9)], "a bigint, b bigint")
    assert sorted(tuple(r) for r in groups(v, e).collect()) == [(1, 1), (2, 2)]


def test_audit_rows_with_odd_arrays(spark):
    schema = "audit_id bigint, source_index bigint, matched_source_indices array<bigint>, retained_source_indices array<bigint>, node bigint, hub string"
    rows = [(1, 10, [11, 11, 10, None], None, 1, ""), (2, 12, [], None, 1, ""), (3, 13, None, [12], 1, ""), (3, 13, None, [12], 1, ""), (4, 20, [21], [22], 1, ""), (5, 22, [30], [], 1, ""), (6, None, [40, 41], None, 1, "")]
    got = {r.source_index: r.group_id for r in audit_groups(spark.createDataFrame(rows, schema)).collect()}
    assert got == {10: 10, 11: 10, 12: 12, 13: 12, 20: 20, 21: 20, 22: 20, 30: 20, 40: 40, 41: 40}
    assert audit_groups(spark.createDataFrame([], schema)).count() == 0
