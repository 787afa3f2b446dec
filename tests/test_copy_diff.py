from __future__ import annotations

from datetime import datetime

from snaploom.operators.copy_diff import differences

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def found(spark, expected, desired):
    e = spark.createDataFrame(expected, "record_id string, expected_fields map<string,string>, synced_at timestamp, key string, side int")
    d = spark.createDataFrame(desired, "record_id string, desired_fields map<string,string>, synced_at timestamp, content string, at string")
    return sorted(tuple(x if x is not None else "<null>" for x in r) for r in differences(e, d).collect())


def row(key, fields, at=T1):
    return (key, fields, at, None, None)


def test_notation_does_not_differ(spark):
    e = {"vli": "1,000", "rhna_start": "1/2/24", "project": " a  b ", "undated_permits": None, "li": "0"}
    d = {"vli": "1000.0", "rhna_start": "2024-01-02", "project": "a b", "undated_permits": " ", "li": "0.00"}
    assert found(spark, [row("r", e)], [row("r", d)]) == []


def test_missing_value_differs_from_zero_and_case_counts(spark):
    e = {"vli": None, "project": "A", "mi": "2", "last_updated": "2024-02-30"}
    d = {"vli": "0", "project": "a", "mi": "two", "last_updated": "2024-02-30 "}
    assert found(spark, [row("r", e)], [row("r", d)]) == [("r", "mi", "differs"), ("r", "project", "differs"), ("r", "vli", "differs")]


def test_only_one_side_and_case_of_keys(spark):
    assert found(spark, [row("a", {}), row("B", {}), row(None, {})], [row("A", {}), row("B", None)]) == [("<null>", "", "only_expected"), ("A", "", "only_desired"), ("a", "", "only_expected")]


def test_latest_row_counts_and_ties_are_settled(spark):
    e = [row("r", {"vli": "1"}, T1), row("r", {"vli": "2"}, T2), row("r", {"vli": "2"}, T2), row("r", {"vli": "9"}, None)]
    assert found(spark, e, [row("r", {"vli": "2"}, T1)]) == []
    tied = [row("r", {"vli": "1"}, T1), row("r", {"vli": "5"}, T1)]
    assert found(spark, tied, [row("r", {"vli": "5"})]) == found(spark, tied[::-1], [row("r", {"vli": "5"})]) == []


def test_hot_key_long_values_and_empty_tables(spark):
    hot = [row("h", {"project": str(i)}, datetime(2024, 1, 1, 0, i // 60, i % 60)) for i in range(900)]
    assert found(spark, [*hot, row("x", {"project": "y" * 100_000})], [row("h", {"project": "899"}), row("x", {"project": "y" * 100_001})]) == [("x", "project", "differs")]
    assert found(spark, [], []) == []
    assert found(spark, [row("a", {"vli": "1"})], []) == [("a", "", "only_expected")]


def test_many_partitions_agree_with_brute_force(spark):
    e = [row(f"k{i}", {"vli": str(i % 7), "project": str(i % 3)}) for i in range(0, 400, 2)]
    d = [row(f"k{i}", {"vli": str(i % 5), "project": str(i % 3)}) for i in range(0, 400, 3)]
    left, right = {r[0]: r[1] for r in e}, {r[0]: r[1] for r in d}
    want = [(k, "", "only_expected") for k in left.keys() - right.keys()] + [(k, "", "only_desired") for k in right.keys() - left.keys()]
    want += [(k, f, "differs") for k in left.keys() & right.keys() for f in left[k] if left[k][f] != right[k][f]]
    assert found(spark, e, d) == sorted(want)
