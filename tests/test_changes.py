from __future__ import annotations

from snaploom.plans import sync

MAPS = "record_id string, fields map<string, string>"


def test_a_change_of_any_key_is_found(spark):
    before = spark.createDataFrame([("a", {"vli": "1", "tracking": "x"}), ("b", {"vli": "1", "old": "1"}), ("c", {"vli": "1"}), ("d", None), ("e", {})], MAPS)
    after = spark.createDataFrame([("a", {"tracking": "y", "vli": "1"}), ("b", {"vli": "1", "new": "2"}), ("c", {"vli": "1", "none": None}), ("d", {"vli": "1"}), ("f", {})], MAPS)
    rows = {(r.record_id, r.field_name, r.before, r.after) for r in sync.map_changes(before, after, "record_id").collect()}
    assert rows == {("a", "tracking", "x", "y"), ("b", "old", "1", None), ("b", "new", None, "2"), ("d", "vli", None, "1")}
    routes = {r.record_id: r.route for r in sync.map_routes(before, after, "record_id").collect()}
    assert routes == {"a": "change", "b": "change", "c": "unchanged", "d": "change", "e": "held: no source", "f": "blocked: no target"}
