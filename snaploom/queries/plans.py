"""Queries of change plans: differences between a source and a target, and what may be written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.operators import relational as R
from snaploom.plans import sync
from snaploom.queries.registry import query
from snaploom.storage import table

_NEWEST = "(SELECT record_id, {0} AS fields FROM {1} QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY synced_at DESC, CAST({0} AS VARCHAR) DESC) = 1)"
_EXPECTED, _DESIRED = _NEWEST.format("expected_fields", "sync_expected"), _NEWEST.format("desired_fields", "sync_desired")
# all keys of the maps
_FIELDS = ("vli", "li", "mi", "ami", "permit_total", "undated_permits", "rhna_start", "rhna_end", "last_updated", "jurisdiction", "project", "tracking", "data_status", "review_note")


def _copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return tuple(sync.newest(table(spark, sf_dir, f"sync_{n}"), "record_id", f"{n}_fields", "synced_at") for n in ("expected", "desired"))  # type: ignore[return-value]


@query(" UNION ALL ".join(f"SELECT record_id, '{f}' AS field_name, e.fields['{f}'] AS before, d.fields['{f}'] AS after FROM {_EXPECTED} e JOIN {_DESIRED} d USING (record_id) WHERE e.fields['{f}'] IS DISTINCT FROM d.fields['{f}']" for f in _FIELDS))
def keyed_diff_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, d = (c.select("record_id", *[F.try_element_at("fields", F.lit(f)).alias(f) for f in _FIELDS]) for c in _copies(spark, sf_dir))
    return R.keyed_diff(e, d, "record_id", _FIELDS)


@query(f"SELECT record_id, CASE WHEN e.fields IS NULL THEN 'create' ELSE 'orphan' END AS action FROM {_EXPECTED} e FULL JOIN {_DESIRED} d USING (record_id) WHERE e.fields IS NULL OR d.fields IS NULL")
def keyed_diff_orphans_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, d = _copies(spark, sf_dir)
    found = R.sides(e, d, ["record_id"]).where("found_as in ('only_left', 'only_right')")
    return found.select("record_id", F.when(F.col("found_as") == "only_right", "create").otherwise("orphan").alias("action"))


@query(f"""
WITH cur AS (SELECT record_id, CASE WHEN record_id < 'recM' THEN d.fields['permit_total'] WHEN record_id < 'recg' THEN e.fields['permit_total'] ELSE 'other' END AS current, e.fields['permit_total'] AS expected, d.fields['permit_total'] AS desired FROM {_EXPECTED} e JOIN {_DESIRED} d USING (record_id))
SELECT record_id, CASE WHEN current IS NOT DISTINCT FROM desired THEN 'already_current' WHEN current IS NOT DISTINCT FROM expected THEN 'pending' ELSE 'conflict' END AS state FROM cur""")
def update_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, d = _copies(spark, sf_dir)
    total = F.try_element_at("fields", F.lit("permit_total"))
    both = e.select("record_id", total.alias("expected")).join(d.select("record_id", total.alias("desired")), "record_id")
    current = F.when(F.col("record_id") < "recM", F.col("desired")).when(F.col("record_id") < "recg", F.col("expected")).otherwise("other")
    return both.withColumn("current", current).select("record_id", sync.update_state(F.col("current"), F.col("expected"), F.col("desired")).alias("state"))


@query(f"SELECT field_name, count(*) AS n FROM ({' UNION ALL '.join(f'''SELECT '{f}' AS field_name FROM {_EXPECTED} e JOIN {_DESIRED} d USING (record_id) WHERE e.fields['{f}'] IS DISTINCT FROM d.fields['{f}']''' for f in _FIELDS)}) GROUP BY 1")
def change_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_diff_changes(spark, sf_dir).groupBy("field_name").agg(F.count("*").alias("n"))


@query("SELECT md5(string_agg(md5(concat_ws('|', juris_key, juris_display, county, CAST(unincorporated AS VARCHAR), CAST(period_start AS VARCHAR), CAST(period_end AS VARCHAR), CAST(cycle_started AS VARCHAR))), '' ORDER BY juris_key)) AS digest, count(*) AS n FROM jurisdictions")
def snapshot_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.ordered_digest(table(spark, sf_dir, "jurisdictions"), "juris_key", ["juris_key", "juris_display", "county", "unincorporated", "period_start", "period_end", "cycle_started"])


@query("""
WITH pinned AS (SELECT * FROM (VALUES ('JURIS_NAME', 1), ('APN', 5), ('SCORE', 68), ('UNKNOWN_COLUMN', 70)) t(column_name, ordinal))
SELECT column_name, CASE WHEN a.ordinal IS NULL THEN 'missing' ELSE 'moved' END AS problem FROM pinned p LEFT JOIN a2_columns a USING (column_name) WHERE a.ordinal IS DISTINCT FROM p.ordinal""")
def schema_pin_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    pinned = spark.createDataFrame([("JURIS_NAME", 1), ("APN", 5), ("SCORE", 68), ("UNKNOWN_COLUMN", 70)], "column_name string, pinned int")
    a = table(spark, sf_dir, "a2_columns")
    return pinned.join(a, "column_name", "left").where(~F.col("ordinal").eqNullSafe(F.col("pinned"))).select("column_name", F.when(F.col("ordinal").isNull(), "missing").otherwise("moved").alias("problem"))


@query("""
SELECT audit_id, CASE WHEN len(retained_source_indices) = 1 AND retained_report_year BETWEEN 2018 AND 2025 AND month(permit_date) IS NOT NULL THEN retained_source_indices[1] || '/' || retained_report_year || '/' || quarter(permit_date) END AS identity FROM dedup_audit""")
def record_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = (F.size("retained_source_indices") == 1) & F.col("retained_report_year").between(2018, 2025) & F.col("permit_date").isNotNull()
    text = F.concat_ws("/", F.col("retained_source_indices")[0].cast("string"), F.col("retained_report_year").cast("string"), F.quarter("permit_date").cast("string"))
    return table(spark, sf_dir, "dedup_audit").select("audit_id", F.when(whole, text).alias("identity"))


@query(f"""
WITH e AS (SELECT record_id, fields FROM {_EXPECTED}), d AS (SELECT record_id, fields FROM {_DESIRED})
SELECT record_id, CASE WHEN e.fields IS NULL THEN 'blocked: no target' WHEN d.fields IS NULL THEN 'held: no source' WHEN {" OR ".join(f"e.fields['{f}'] IS DISTINCT FROM d.fields['{f}']" for f in _FIELDS)} THEN 'change' ELSE 'unchanged' END AS route FROM e FULL JOIN d USING (record_id)""")
def change_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, d = _copies(spark, sf_dir)
    return sync.routes(e, d, "record_id", _FIELDS)


_ALL_CHANGES = f"""SELECT record_id, field_name, b[field_name] AS before, a[field_name] AS after FROM (SELECT record_id, e.fields AS b, d.fields AS a, unnest(list_distinct(list_concat(map_keys(e.fields), map_keys(d.fields)))) AS field_name FROM {_EXPECTED} e JOIN {_DESIRED} d USING (record_id)) WHERE b[field_name] IS DISTINCT FROM a[field_name]"""


@query(_ALL_CHANGES)
def keyed_diff_changes_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over whichever keys either side has; ``keyed_diff_changes`` names them."""
    return sync.map_changes(*_copies(spark, sf_dir), "record_id")


@query(f"SELECT field_name, count(*) AS n FROM ({_ALL_CHANGES}) GROUP BY 1")
def change_summary_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_diff_changes_whole(spark, sf_dir).groupBy("field_name").agg(F.count("*").alias("n"))


@query(f"""
WITH e AS (SELECT record_id, fields, true AS known FROM {_EXPECTED}), d AS (SELECT record_id, fields, true AS known FROM {_DESIRED}), c AS (SELECT DISTINCT record_id FROM ({_ALL_CHANGES}))
SELECT record_id, CASE WHEN e.known IS NULL THEN 'blocked: no target' WHEN d.known IS NULL THEN 'held: no source' WHEN record_id IN (SELECT record_id FROM c) THEN 'change' ELSE 'unchanged' END AS route FROM e FULL JOIN d USING (record_id)""")
def change_routes_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.map_routes(*_copies(spark, sf_dir), "record_id")


@query("""
WITH a AS (SELECT source_index, permit_date, report_year FROM permit_records), b AS (SELECT source_index, permit_date, report_year FROM dedup_audit)
SELECT CAST((SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS INT) AS n_left, CAST((SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS INT) AS n_right""")
def projection_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the ledger's projection lacks of the permits', and the other way round."""
    columns = ["source_index", "permit_date", "report_year"]
    return sync.projection_difference(table(spark, sf_dir, "permit_records").select(*columns), table(spark, sf_dir, "dedup_audit").select(*columns))
