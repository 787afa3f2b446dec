"""Queries of snapshot deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.plans import snapshots
from snaploom.queries import snapshot_sql as sql
from snaploom.queries.registry import query
from snaploom.storage import saved, table


@query()
def deduplicated_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.deduplicated(table(spark, sf_dir, "permit_records"))


@query(sql.DECISIONS)
def snapshot_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decisions of all rules but the carrying forward of rows."""
    return snapshots.deduplicated(table(spark, sf_dir, "permit_records"), carried_forward=False)


@query()
def deduplication_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = deduplicated_permits(spark, sf_dir)
    return d.groupBy("decision", "rule").agg(F.count("*").alias("n_rows"))


def _strong(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saved(snapshots.prepared(table(spark, sf_dir, "permit_records")).where("day is not null and id <> ''"), "strong")


@query(f"WITH {sql.EDGES} SELECT a, b, kind FROM edges")
def strong_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    strong = _strong(spark, sf_dir)
    return snapshots.strong_edges(strong).select("a", "b", "kind")


@query(f"WITH {sql.PREPARED}, {sql.COLLISIONS} SELECT place, id FROM collisions")
def reused_number_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.collisions(_strong(spark, sf_dir))


@query(f"WITH RECURSIVE {sql.COMPONENTS} SELECT source_index, component FROM comps")
def constrained_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.strong_components(_strong(spark, sf_dir)).select("source_index", "component")


@query(f"WITH RECURSIVE {sql.BLOCKS} SELECT * FROM blocks")
def strong_block_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    strong = _strong(spark, sf_dir)
    return snapshots.strong_blocks(strong, snapshots.strong_components(strong))


@query(sql.CARRIED)
def carried_forward_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.carried_candidates(snapshots.prepared(table(spark, sf_dir, "permit_records")))
