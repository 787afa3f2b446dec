"""Desired-state plans: what to change in a target so that it agrees with a source, and proofs that nothing else does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(rows: DataFrame, key: str, fields: str, at: str) -> DataFrame:
    """(key, fields) of each key's newest row; of equally new ones the one with the greatest content."""
    text = F.to_json(F.array_sort(F.map_entries(fields)))
    pick = F.max_by(F.col(fields), F.struct(F.col(at).isNotNull().alias("known"), F.col(at).alias("at"), text.alias("text")))
    return rows.groupBy(key).agg(pick.alias("fields"))


def update_state(current: Column, expected: Column, desired: Column) -> Column:
    """Compare and set: nothing to do, to be written, or changed by someone else."""
    return F.when(current.eqNullSafe(desired), "already_current").when(current.eqNullSafe(expected), "pending").otherwise("conflict")


def routes(target: DataFrame, source: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, route): change or leave a record that both sides have; block or hold one that a side lacks."""
    t = target.select(key, F.struct(*[F.try_element_at("fields", F.lit(f)).alias(f) for f in fields]).alias("t"))
    s = source.select(key, F.struct(*[F.try_element_at("fields", F.lit(f)).alias(f) for f in fields]).alias("s"))
    route = F.when(F.col("t").isNull(), "blocked: no target").when(F.col("s").isNull(), "held: no source").when(~F.col("t").eqNullSafe(F.col("s")), "change").otherwise("unchanged")
    return t.join(s, key, "full").select(key, route.alias("route"))


def _changed_keys(before: Column, after: Column) -> Column:
    """The keys of either map whose values differ, a missing one being null."""
    keys = [F.coalesce(F.map_keys(c), F.array().cast("array<string>")) for c in (before, after)]
    return F.filter(F.array_union(*keys), lambda k: ~F.try_element_at(before, k).eqNullSafe(F.try_element_at(after, k)))


def map_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, field_name, before, after) for each key of either side's ``fields`` whose values differ; one row per change."""
    both = before.select(key, F.col("fields").alias("b")).join(after.select(key, F.col("fields").alias("a")), key)
    each = both.select(key, "b", "a", F.explode(_changed_keys(F.col("b"), F.col("a"))).alias("field_name"))
    return each.select(key, "field_name", *[F.try_element_at(c, F.col("field_name")).alias(n) for c, n in (("b", "before"), ("a", "after"))])


def applied(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """(key, fields) of a target after the changes: a changed key gets its value after, or goes if that is null."""
    each = changes.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("field_name", "after"))).alias("new"))
    both = target.select(key, "fields").join(each, key, "left")
    kept = F.map_filter("fields", lambda k, v: F.col("new").isNull() | ~F.map_contains_key("new", k))
    merged = F.map_concat(kept, F.map_filter("new", lambda k, v: v.isNotNull()))
    return both.select(key, F.when(F.col("new").isNull(), F.col("fields")).otherwise(merged).alias("fields"))


def map_routes(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """As ``routes``, over all keys of either side's ``fields``."""
    t, s = (df.select(key, F.struct("fields").alias(n)) for df, n in ((target, "t"), (source, "s")))
    changed = F.size(_changed_keys(F.col("t.fields"), F.col("s.fields"))) > 0
    route = F.when(F.col("t").isNull(), "blocked: no target").when(F.col("s").isNull(), "held: no source").when(changed, "change").otherwise("unchanged")
    return t.join(s, key, "full").select(key, route.alias("route"))


def ordered_digest(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(digest, n) of a dimension-sized table in key order; two tables agree if and only if their digests do."""
    each = rows.select(F.col(key).alias("k"), F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])).alias("d"))
    lists = each.agg(F.array_sort(F.collect_list(F.struct("k", "d"))).alias("all"))
    return lists.select(F.md5(F.array_join(F.transform("all", lambda x: x["d"]), "")).alias("digest"), F.size("all").cast("bigint").alias("n"))


def bag_digest(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(digest, digest2, n) of a table of any size and order: sums of row hashes, which partial aggregation can build."""
    h = [F.xxhash64(F.lit(i), *columns).cast("decimal(38,0)") for i in (1, 2)]
    return rows.agg(F.sum(h[0]).alias("digest"), F.sum(h[1]).alias("digest2"), F.count("*").alias("n"))


def projection_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """(n_left, n_right): rows of each side that the other lacks, counting repeats; both are 0 for equal projections."""
    cols = left.columns
    both = left.withColumn("n", F.lit(1)).unionAll(right.select(*cols).withColumn("n", F.lit(-1)))
    off = both.groupBy(*cols).agg(F.sum("n").alias("n")).where("n <> 0")
    return off.agg(F.coalesce(F.sum(F.greatest("n", F.lit(0))), F.lit(0)).cast("int").alias("n_left"), F.coalesce(F.sum(F.greatest(-F.col("n"), F.lit(0))), F.lit(0)).cast("int").alias("n_right"))
