"""Relational building blocks of snapshot reconciliation, each over any columns.

None of them collects rows; dimension sides are left to the planner's size
checks instead of being broadcast by force.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snaploom.storage import discard, saved


def renamed(df: DataFrame, **names: str) -> DataFrame:
    return df.withColumnsRenamed(names)


def window_select(facts: DataFrame, periods: DataFrame, key: str, day: str, year: str, start: str = "period_start", end: str = "period_end", cutoff: str | None = None) -> DataFrame:
    """Facts of a period: dated ones between its ends (and up to the cutoff), undated ones by their report year."""
    last = F.least(F.col(end), F.lit(cutoff).cast("date")) if cutoff else F.col(end)
    inside = F.when(F.col(day).isNull(), F.col(year).between(F.year(start), F.year(end))).otherwise(F.col(day).between(F.col(start), last))
    return facts.join(periods, key).where(inside)


def zero_filled(dimension: DataFrame, facts: DataFrame, key: str, sums: dict[str, Column], status: str = "data_status") -> DataFrame:
    """Sums of the facts for every member of the dimension, zeros where there are none."""
    totals = facts.groupBy(key).agg(*[F.sum(c).alias(n) for n, c in sums.items()], F.count("*").alias("n_rows"))
    filled = dimension.join(totals, key, "left").na.fill(0, [*sums, "n_rows"])
    return filled.withColumn(status, F.when(F.col("n_rows") > 0, "reported").otherwise("no_selected_rows"))


def override(base: DataFrame, overrides: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The base with an override's values wherever there is one for the key."""
    other = overrides.select(F.col(key), *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("overridden"))
    joined = base.join(other, key, "left")
    kept = [c for c in base.columns if c not in columns]
    picked = [F.when(F.col("overridden"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    return joined.select(*kept, *picked)


def pair_edges(rows: DataFrame, block: Sequence[str], id_: str, alike: Column | None = None, year: str | None = None) -> DataFrame:
    """(a, b) pairs of a block with a < b, of different years if given; ``alike`` may use ``l.`` and ``r.`` columns.

    Blocks with a single year are dropped before the join, as they can't give an edge.
    """
    if year is not None:
        wide = rows.groupBy(*block).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year")).where("first_year < last_year")
        rows = rows.join(wide.drop("first_year", "last_year"), list(block), "left_semi")
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in block] + [F.col(f"l.{id_}") < F.col(f"r.{id_}")]
    if year is not None:
        on.append(F.col(f"l.{year}") != F.col(f"r.{year}"))
    if alike is not None:
        on.append(alike)
    return rows.alias("l").join(rows.alias("r"), reduce(Column.__and__, on)).select(F.col(f"l.{id_}").alias("a"), F.col(f"r.{id_}").alias("b"))


def with_latest(rows: DataFrame, group: Sequence[str], year: str) -> DataFrame:
    """Adds the group's latest year, by aggregate and join, so that a large group isn't gathered in one task."""
    latest = rows.groupBy(*group).agg(F.max(year).alias("latest_year"))
    return rows.join(latest, list(group))


def latest_guarded(rows: DataFrame, group: Sequence[str], year: str) -> DataFrame:
    """Rows of earlier years, where the group's latest year has at least as many rows as any earlier one."""
    counts = rows.groupBy(*group, year).agg(F.count("*").alias("n"))
    shape = counts.groupBy(*group).agg(F.max(year).alias("latest_year"), F.max(F.struct(year, "n"))["n"].alias("latest_n"), F.max(F.struct("n", year))["n"].alias("most_n"), F.count("*").alias("n_years"))
    guarded = shape.where("n_years > 1 and latest_n >= most_n").select(*group, "latest_year")
    return rows.join(guarded, list(group)).where(F.col(year) < F.col("latest_year"))


def best_match(candidates: DataFrame, row: str, order: Sequence[Column]) -> DataFrame:
    """The first candidate of each row in the given order; the planner limits groups before the shuffle."""
    w = W.partitionBy(row).orderBy(*order)
    return candidates.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def references(rows: DataFrame, arrays: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(…, ref): each reference in the array columns, nulls and repeats dropped."""
    every = F.array_distinct(F.concat(*[F.coalesce(F.col(c), F.array().cast("array<bigint>")) for c in arrays]))
    return rows.select(*keep, F.explode(F.filter(every, lambda x: x.isNotNull())).alias("ref"))


def linked_values(rows: DataFrame, id_: str, links: str, targets: DataFrame, target_id: str, value: str, name: str = "linked") -> DataFrame:
    """For each row, the targets' values in the order of its links; links without a target are skipped."""
    each = rows.select(F.col(id_), F.posexplode(links).alias("at", "target"))
    found = each.join(targets.select(F.col(target_id).alias("target"), F.col(value).alias("value")), "target")
    lists = found.groupBy(id_).agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("pairs"))
    ordered = lists.select(id_, F.transform("pairs", lambda p: p["value"]).alias(name))
    return rows.select(id_).join(ordered, id_, "left").select(id_, F.coalesce(F.col(name), F.array()).alias(name))


def link_integrity(rows: DataFrame, id_: str, links: str, targets: DataFrame, target_id: str) -> DataFrame:
    """For each row with links: how many there are, how many repeat, and how many have no target."""
    each = rows.select(F.col(id_), F.explode(links).alias("target"))
    known = targets.select(F.col(target_id).alias("target"), F.lit(1).alias("known")).distinct()
    per = each.groupBy(id_, "target").agg(F.count("*").alias("n")).join(known, "target", "left")
    return per.groupBy(id_).agg(F.sum("n").alias("links"), F.sum(F.col("n") - 1).alias("repeated"), F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("orphans"))


def keyed_diff(before: DataFrame, after: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, field_name, before, after) for each field whose values differ, nulls being equal; one row per change."""
    b = before.select(F.col(key), *[F.col(f).cast("string").alias(f"b_{f}") for f in fields])
    a = after.select(F.col(key), *[F.col(f).cast("string").alias(f"a_{f}") for f in fields])
    changes = F.array(*[F.when(~F.col(f"b_{f}").eqNullSafe(F.col(f"a_{f}")), F.struct(F.lit(f).alias("field_name"), F.col(f"b_{f}").alias("before"), F.col(f"a_{f}").alias("after"))) for f in fields])
    return b.join(a, key).select(key, F.explode(F.filter(changes, lambda x: x.isNotNull())).alias("c")).select(key, "c.*")


def sides(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """For each key of either side: how many rows each has, and whether it is matched, repeated or on one side only."""
    l = left.groupBy(*key).agg(F.count("*").alias("n_left"))
    r = right.groupBy(*key).agg(F.count("*").alias("n_right"))
    both = l.join(r, list(key), "full").na.fill(0, ["n_left", "n_right"])
    found = F.when(F.col("n_left") == 0, "only_right").when(F.col("n_right") == 0, "only_left").when((F.col("n_left") > 1) | (F.col("n_right") > 1), "repeated").otherwise("matched")
    return both.withColumn("found_as", found)


def numbered(rows: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Adds each row's position from 0, without gathering all rows in one task.

    Rows are range-partitioned, sorted and kept; the partitions' sizes, one
    number each, give where each begins.
    """
    ordered = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()), "numbered")
    first = F.shiftleft(F.col("part").cast("bigint"), 33)
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n"))
    begins = sizes.withColumn("begin", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))).select("part", F.coalesce("begin", F.lit(0)).alias("begin"))
    return ordered.join(begins, "part").withColumn(name, F.col("begin") + F.col("nth") - first).drop("part", "nth", "begin")


def zipped(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """The first row of one side with the first of the other, and so on."""
    return numbered(left, left_order).join(numbered(right, right_order), "position")


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with both counts."""
    cols = left.columns
    l, r = (df.select(*cols, F.lit(s).alias("side")) for df, s in ((left, 1), (right, -1)))
    return l.unionAll(r).groupBy(*cols).agg(F.sum(F.when(F.col("side") == 1, 1).otherwise(0)).alias("n_left"), F.sum(F.when(F.col("side") == -1, 1).otherwise(0)).alias("n_right")).where("n_left <> n_right")


def mode_share(rows: DataFrame, group: Sequence[str], value: str, least_rows: int = 10, least_share: float = 0.5) -> DataFrame:
    """Groups in which one value makes up a large share: the most frequent, the smallest of equally frequent ones."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
    top = counts.groupBy(*group).agg(F.sum("n").alias("n_rows"), F.min(F.struct((-F.col("n")).alias("m"), F.col(value).alias("top"))).alias("t"))
    share = F.bround((-F.col("t.m")) / F.col("n_rows"), 4)
    return top.select(*group, "n_rows", F.col("t.top").alias("top_value"), (-F.col("t.m")).alias("top_n"), share.alias("top_share")).where((F.col("n_rows") >= least_rows) & (-F.col("t.m") >= least_share * F.col("n_rows")))


def quarter_spine(dimension: DataFrame, key: str, first_year: int, last_year: int) -> DataFrame:
    """Every member with every quarter of the years, and the day each begins."""
    slots = F.transform(F.sequence(F.lit(0), F.lit((last_year - first_year + 1) * 4 - 1)), lambda i: F.struct((F.lit(first_year) + F.floor(i / 4)).cast("int").alias("year"), (i % 4 + 1).cast("int").alias("quarter")))
    grid = dimension.select(key, F.explode(slots).alias("s")).select(key, "s.year", "s.quarter")
    return grid.withColumn("starts", F.make_date("year", F.col("quarter") * 3 - 2, F.lit(1)))


def ancestors(edges: DataFrame, most_levels: int = 64) -> DataFrame:
    """(node, final) for an acyclic table of (node, next) edges: every end that a node reaches.

    Paths are doubled each round, so that a chain of any length needs a
    logarithmic number of joins; more than ``2 ** most_levels`` steps mean a cycle.
    """
    paths = saved(edges.select("node", F.col("next").alias("final"), F.lit(False).alias("done")).distinct(), "paths")
    for _ in range(most_levels):
        onward = paths.select(F.col("node").alias("from"), F.col("final").alias("to"), F.lit(True).alias("goes"))
        step = saved(paths.join(onward, F.col("final") == F.col("from"), "left").select("node", F.coalesce("to", "final").alias("final"), F.col("goes").isNull().alias("done")).distinct(), "paths")
        discard(paths)
        paths = step
        if paths.where("not done").isEmpty():
            return paths.select("node", "final")
    raise ValueError("the edges have a cycle")


def peel(edges: DataFrame) -> DataFrame:
    """The (node, next) edges that are left when nodes without outgoing edges are taken off again and again: those on or before cycles."""
    left = saved(edges.where("node is not null and next is not null").distinct(), "peel")
    size = left.count()
    while size:
        sources = left.select(F.col("node").alias("source")).distinct()
        step = saved(left.join(sources, F.col("next") == F.col("source"), "left_semi"), "peel")
        n = step.count()
        discard(left)
        left = step
        if n == size:
            break
        size = n
    return left


def lineage_ends(edges: DataFrame) -> DataFrame:
    """(node, final, cyclic): every end that a node reaches over any edges, and whether it is on or before a cycle.

    Nodes that reach no end have a null one. Edges of a node to itself lead
    nowhere. Edges on or before cycles are taken off before paths are doubled;
    the ends behind them are then carried back over them until none is new.
    """
    every = saved(edges.where("node <> next").select("node", "next").distinct(), "lineage")
    loops = peel(every)
    on_loops = loops.select("node").distinct()
    ends = ancestors(every.join(loops, ["node", "next"], "left_anti"))
    known = fresh = saved(ends.join(on_loops, "node", "left_semi"), "ends")
    carried = []
    while not fresh.isEmpty():
        back = loops.join(fresh.toDF("next", "final"), "next").select("node", "final").distinct()
        fresh = saved(back.join(known, ["node", "final"], "left_anti"), "ends")
        known = known.unionAll(fresh)
        carried.append(fresh)
    found = reduce(DataFrame.unionAll, carried, ends)
    return found.join(on_loops.withColumn("cyclic", F.lit(True)), "node", "full").select("node", "final", F.coalesce("cyclic", F.lit(False)).alias("cyclic"))
