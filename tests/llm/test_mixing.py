from __future__ import annotations

import os
import random
from fractions import Fraction

import pytest

from snaploom.llm.encoding import TOKENIZERS
from snaploom.llm.mixing import highest_quotients, mixture, shard_quotas

needs_vocabulary = pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="no vocabulary files here")


def one_by_one(weights, seats, caps):
    given = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i in range(len(weights)) if given[i] < caps[i] and weights[i] > 0]
        if not open_:
            break
        given[max(open_, key=lambda i: (Fraction(weights[i]) / (2 * given[i] + 1), -i))] += 1
    return given


def test_quotients_agree_with_handing_out_one_by_one():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 8)
        weights = [rng.choice([0, 1, 2, 5, 11, 400]) for _ in range(n)]
        seats = rng.randint(0, 300)
        caps = [rng.choice([0, 3, 50, 1000]) for _ in range(n)]
        assert highest_quotients(weights, seats, caps) == one_by_one(weights, seats, caps)
        assert highest_quotients(weights, seats) == one_by_one(weights, seats, [seats] * n)


def test_quotas_of_shards_use_all_of_the_rest_and_no_more_than_a_shard_holds(spark):
    rng = random.Random(7)
    held = {s: [rng.randint(900, 1100) if s != "uneven" else rng.choice([0, 3, 50, 4000]) for _ in range(n)] for s, n in (("a", 40), ("b", 1), ("uneven", 30), ("all", 9))}
    rests = [("a", 21_037, 10), ("b", 7, 50), ("uneven", sum(held["uneven"]) - 5, 100), ("all", sum(held["all"]), 100)]
    t = spark.createDataFrame([(s, i, n) for s, h in held.items() for i, n in enumerate(h)], "source string, shard bigint, held bigint")
    r = spark.createDataFrame([(s, 1, rest, block) for s, rest, block in rests], "of_source string, rounds int, rest bigint, block bigint")
    got = {}
    for row in shard_quotas(t, r).collect():
        got.setdefault(row.of_source, {})[row.of_shard] = row.quota
    for s, rest, block in rests:
        assert sum(got[s].values()) == rest and all(0 <= q <= held[s][i] for i, q in got[s].items())
    # but for tokens short of a block, the quotas are those of the highest quotients
    seats = highest_quotients(held["a"], 21_037 // 10, [h // 10 for h in held["a"]])
    assert sum(q // 10 != n for q, n in zip((got["a"][i] for i in range(40)), seats)) <= 1


@needs_vocabulary
def test_sources_of_many_shards(spark):
    rng = random.Random(5)
    d = spark.createDataFrame([(i, f"{i} " + "permit " * rng.randint(3, 60), "big" if i % 3 else "small") for i in range(900)], "doc_id bigint, text string, source string")
    t = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3)], "source_name string, target_share double, max_repeats int")
    mixed, report = mixture(d, t, shard_tokens=1000)
    share = {r.source: r for r in report.collect()}
    assert all(abs(share[s].actual_share - share[s].due_share) < 0.01 and share[s].due_share == 0.5 for s in share)
    assert mixed.where("uses > 3 or source = 'big' and uses > 1").isEmpty()


@needs_vocabulary
def test_shares_caps_repeats_and_determinism(spark):
    rng = random.Random(4)
    words = ["permit", "unit", "house", "parcel", "county", "hearing"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(3, 60))), "big" if i % 3 else "small", 0, "x") for i in range(900)]
    docs += [(1000 + i, docs[1][1], "big", 0, "x") for i in range(300)] + [(2000, None, "big", 0, "x"), (2001, "", "small", 0, "x"), (2002, "no target", "other", 0, "x"), (2003, "no source", None, 0, "x"), (None, docs[2][1], "big", 0, "x")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, source string, shard int, quota string")
    t = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 3), ("absent", 0.1, 2), ("zero", 0.0, 2), (None, 0.5, 1)], "source_name string, target_share double, max_repeats int")
    mixed, report = mixture(d, t)
    rows = mixed.collect()
    texts = {k: x for k, x, *_ in docs}
    assert len({(r.source, texts[r.doc_id]) for r in rows}) == len(rows)
    assert all(r.uses <= {"big": 1, "small": 3}[r.source] for r in rows)
    share = {r.source: r.actual_share for r in report.collect()}
    assert abs(share["big"] - 2 / 3) < 0.01 and abs(share["small"] - 1 / 3) < 0.01 and share["absent"] == 0 and share["other"] == 0
    again = mixture(d.repartition(7), t)[0].collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


@needs_vocabulary
def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string, source string")
    t = spark.createDataFrame([("a", 1.0, 1)], "source_name string, target_share double, max_repeats int")
    mixed, report = mixture(d, t)
    assert mixed.count() == 0 and [r.actual_share for r in report.collect()] == [0.0]
    assert mixture(d.unionAll(spark.createDataFrame([(1, "x", "a")], d.schema)), t.limit(0))[0].count() == 0
