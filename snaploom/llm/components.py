"""Consolidating pairwise matches into groups: connected components by Boruvka hooking.

Each round, every component selects its smallest outgoing edge, edges being
ordered by their smaller and then their larger end, and hooks to the other end.
As all edges are ordered alike, the only cycles are pairs that select the same
edge; their smaller end becomes the root, and it is the smallest label of its
tree. Trees collapse by pointer doubling, edges are relabelled and
deduplicated, and rounds repeat until no edge is left. The number of components
with edges at least halves in a round, whatever the shape of the graph, so
chains and hubs of any length need a logarithmic number of rounds.

Selecting edges is an aggregate with partial sums before the shuffle; the joins
meet labels that are unique on one side, so a hub with a third of all edges is
split by the adaptive skew join. Nothing but row counts reaches the driver.

Defined results: null ends are no members; loops and repeated or reversed edges
change nothing; a vertex without other members is a group of its own; an empty
table of edges leaves every vertex alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaploom.storage import discard, saved


def _hooks(edges: DataFrame) -> DataFrame:
    """(node, parent): each end of an edge and its smallest neighbour, roots pointing to themselves.

    The smallest neighbour is the other end of the smallest outgoing edge,
    whether it is below the node or above it.
    """
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e"))
    return ends.select("e.node", "e.other").groupBy("node").agg(F.min("other").alias("parent"))


def _rooted(hooks: DataFrame) -> DataFrame:
    back = hooks.select(F.col("node").alias("up"), F.col("parent").alias("up_parent"))
    mutual = (F.col("up_parent") == F.col("node")) & (F.col("node") < F.col("parent"))
    return hooks.join(back, F.col("parent") == F.col("up")).select("node", F.when(mutual, F.col("node")).otherwise(F.col("parent")).alias("parent"))


def _doubled(tree: DataFrame) -> DataFrame:
    up = tree.select(F.col("node").alias("up"), F.col("parent").alias("up_parent"))
    return tree.join(up, F.col("parent") == F.col("up")).select("node", F.col("up_parent").alias("parent"), (F.col("parent") != F.col("up_parent")).alias("moved"))


def _collapsed(tree: DataFrame) -> DataFrame:
    while True:
        step = saved(_doubled(tree), "tree")
        discard(tree)
        tree = step
        if tree.where("moved").isEmpty():
            return tree.select("node", "parent")


def _distinct_pairs(edges: DataFrame) -> DataFrame:
    low, high = F.least("a", "b"), F.greatest("a", "b")
    return edges.where("a <> b").select(low.alias("a"), high.alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, group_id) for all ends of ``edges`` (a, b); group_id is the smallest node linked to it."""
    spark = edges.sparkSession
    left = saved(_distinct_pairs(edges), "edges")
    maps: list[DataFrame] = []
    while not left.isEmpty():
        first = saved(_rooted(_hooks(left)), "tree")
        kept = _collapsed(first)
        maps.append(kept)
        to_a, to_b = kept.toDF("node_a", "root_a"), kept.toDF("node_b", "root_b")
        moved = left.join(to_a, F.col("a") == F.col("node_a")).join(to_b, F.col("b") == F.col("node_b")).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        after = saved(_distinct_pairs(moved), "edges")
        discard(left)
        left = after
    discard(left)
    if not maps:
        return spark.createDataFrame([], "node bigint, group_id bigint")
    # roots of a round are the nodes of the next: compose from the last round, where tables are smallest
    total = maps.pop().toDF("node", "group_id")
    while maps:
        later = total.toDF("later", "later_group")
        step = maps.pop().toDF("node", "root")
        total = step.join(later, F.col("root") == F.col("later"), "left").select("node", F.coalesce("later_group", "root").alias("group_id"))
    return total


def groups(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, group_id) for every vertex, those without edges included."""
    found = components(edges).toDF("linked", "linked_group")
    return vertices.where("node is not null").distinct().join(found, F.col("node") == F.col("linked"), "left").select("node", F.coalesce("linked_group", "node").alias("group_id"))


def audit_members(audit: DataFrame) -> DataFrame:
    """(source_index, member) of every entry, the entry's own row first among its members."""
    arrays = [F.coalesce(F.col(c), F.array().cast("array<bigint>")) for c in ("matched_source_indices", "retained_source_indices")]
    # an entry without its own row still links the members of its arrays: its hub is then its smallest member
    every = F.array_distinct(F.filter(F.concat(F.array("source_index"), *arrays), lambda x: x.isNotNull()))
    return audit.select(every.alias("every")).select(F.coalesce(F.col("every").getItem(0), F.lit(None)).alias("hub"), F.explode("every").alias("member"))


def audit_groups(audit: DataFrame) -> DataFrame:
    """(source_index, group_id) for every row that ``audit`` names."""
    pairs = audit_members(audit)
    found = groups(pairs.select(F.col("member").alias("node")), pairs.select(F.col("hub").alias("a"), F.col("member").alias("b")))
    return found.select(F.col("node").alias("source_index"), "group_id")
