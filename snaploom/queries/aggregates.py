"""Queries of aggregations, windows and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.operators import relational as R
from snaploom.queries.joins import _PERMITS, BANDS, CUTOFF, permits
from snaploom.queries.registry import query
from snaploom.storage import table

UNITS = " + ".join(BANDS)


def _units():
    return sum((F.col(b) for b in BANDS[1:]), F.col(BANDS[0]))


@query(f"SELECT rule_name, count(*) AS n_rows, count(DISTINCT source_index) AS n_distinct, CAST(sum(units) AS BIGINT) AS units FROM dedup_audit JOIN (SELECT source_index, {UNITS} AS units FROM permit_records) USING (source_index) GROUP BY 1")
def removal_rule_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").select("source_index", _units().alias("units"))
    a = table(spark, sf_dir, "dedup_audit").select("rule_name", "source_index")
    return a.join(p, "source_index").groupBy("rule_name").agg(F.count("*").alias("n_rows"), F.countDistinct("source_index").alias("n_distinct"), F.sum("units").alias("units"))


@query(f"SELECT count(*) AS n_rows, count(DISTINCT jurisdiction) AS n_places, max(report_year) AS last_year, count(*) FILTER (reported_total <> {UNITS}) AS n_mismatched, CAST(coalesce(sum(reported_total - ({UNITS})) FILTER (reported_total <> {UNITS}), 0) AS BIGINT) AS net_mismatch FROM permit_records")
def selection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    off = F.col("reported_total") != _units()
    return table(spark, sf_dir, "permit_records").agg(
        F.count("*").alias("n_rows"), F.countDistinct("jurisdiction").alias("n_places"), F.max("report_year").alias("last_year"),
        F.count_if(off).alias("n_mismatched"), F.coalesce(F.sum(F.when(off, F.col("reported_total") - _units())), F.lit(0)).alias("net_mismatch"),
    )


@query("SELECT jurisdiction, report_year, count(*) AS n FROM permit_records GROUP BY ALL")
def raw_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "permit_records").groupBy("jurisdiction", "report_year").agg(F.count("*").alias("n"))


@query("SELECT unit_category, count(*) AS n FROM permit_records GROUP BY 1")
def counts_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "permit_records").groupBy("unit_category").agg(F.count("*").alias("n"))


_CELLS = ", ".join(f"CAST(sum({b}) AS BIGINT) AS {b}" for b in BANDS)


@query(f"""
SELECT juris_key, CAST(year(permit_date) AS INT) AS year, CAST(quarter(permit_date) AS INT) AS quarter, {_CELLS}, CAST(coalesce(sum({UNITS}) FILTER (unit_category = 'ADU'), 0) AS BIGINT) AS adu_units, CAST(coalesce(sum({UNITS}) FILTER (tenure IN ('R', 'Renter')), 0) AS BIGINT) AS renter_units
FROM {_PERMITS} WHERE permit_date IS NOT NULL GROUP BY 1, 2, 3""")
def conditional_band_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = permits(spark, sf_dir).where("permit_date is not null")
    extra = {"adu_units": F.col("unit_category") == "ADU", "renter_units": F.col("tenure").isin("R", "Renter")}
    sums = [F.sum(b).alias(b) for b in BANDS] + [F.coalesce(F.sum(F.when(c, _units())), F.lit(0)).alias(n) for n, c in extra.items()]
    return p.groupBy("juris_key", F.year("permit_date").alias("year"), F.quarter("permit_date").alias("quarter")).agg(*sums)


@query(f"""
WITH c AS (SELECT juris_key, CAST(year(permit_date) AS INT) AS year, CAST(quarter(permit_date) AS INT) AS quarter, sum({UNITS}) AS units FROM {_PERMITS} WHERE permit_date IS NOT NULL GROUP BY ALL)
SELECT j.juris_key, y.year, q.quarter, CAST(coalesce(c.units, 0) AS BIGINT) AS units FROM jurisdictions j, (SELECT CAST(unnest(range(2018, 2026)) AS INT) AS year) y, (SELECT CAST(unnest(range(1, 5)) AS INT) AS quarter) q LEFT JOIN c ON c.juris_key = j.juris_key AND c.year = y.year AND c.quarter = q.quarter""")
def quarterly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = permits(spark, sf_dir).where("permit_date is not null")
    cells = p.groupBy("juris_key", F.year("permit_date").alias("year"), F.quarter("permit_date").alias("quarter")).agg(F.sum(_units()).alias("units"))
    spine = R.quarter_spine(table(spark, sf_dir, "jurisdictions"), "juris_key", 2018, 2025).drop("starts")
    return spine.join(cells, ["juris_key", "year", "quarter"], "left").na.fill(0, ["units"])


@query("""
SELECT report_year, count(*) AS n_rows, count(*) FILTER (trim(latitude) <> '' AND try_cast(latitude AS DOUBLE) IS NULL) AS n_unreadable, CAST(coalesce(sum(reported_total) FILTER (try_cast(latitude AS DOUBLE) > 37), 0) AS BIGINT) AS units_north FROM permit_records GROUP BY 1""")
def positive_text_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("latitude").try_cast("double")
    return table(spark, sf_dir, "permit_records").groupBy("report_year").agg(F.count("*").alias("n_rows"), F.count_if((F.trim("latitude") != "") & n.isNull()).alias("n_unreadable"), F.coalesce(F.sum(F.when(n > 37, F.col("reported_total"))), F.lit(0)).alias("units_north"))


@query("""
WITH c AS (SELECT jurisdiction_display, report_year, unit_category, count(*) AS n FROM permit_records WHERE unit_category IS NOT NULL GROUP BY ALL),
t AS (SELECT jurisdiction_display, report_year, CAST(sum(n) OVER (PARTITION BY jurisdiction_display, report_year) AS BIGINT) AS n_rows, unit_category AS top_value, n AS top_n, row_number() OVER (PARTITION BY jurisdiction_display, report_year ORDER BY n DESC, unit_category) AS r FROM c)
SELECT jurisdiction_display, report_year, n_rows, top_value, top_n, round_even(top_n / n_rows, 4) AS top_share FROM t WHERE r = 1 AND n_rows >= 10 AND top_n >= 0.5 * n_rows""")
def mode_share_heaping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and years half of whose rows are of one category."""
    return R.mode_share(table(spark, sf_dir, "permit_records"), ["jurisdiction_display", "report_year"], "unit_category")


@query(f"SELECT juris_key, CAST(sum({UNITS}) AS BIGINT) AS undated_units FROM {_PERMITS} WHERE permit_date IS NULL GROUP BY 1 HAVING sum({UNITS}) <> 0")
def undated_by_jurisdiction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permits(spark, sf_dir).where("permit_date is null").groupBy("juris_key").agg(F.sum(_units()).alias("undated_units")).where("undated_units <> 0")


@query(f"SELECT juris_key, CAST(coalesce(sum({UNITS}) FILTER (permit_date BETWEEN period_start AND period_end), 0) AS BIGINT) AS in_cycle FROM {_PERMITS} JOIN (SELECT juris_key, period_start, period_end FROM jurisdictions) USING (juris_key) GROUP BY 1")
def in_cycle_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = permits(spark, sf_dir).join(table(spark, sf_dir, "jurisdictions").select("juris_key", "period_start", "period_end"), "juris_key")
    return rows.groupBy("juris_key").agg(F.coalesce(F.sum(F.when(F.col("permit_date").between(F.col("period_start"), F.col("period_end")), _units())), F.lit(0)).alias("in_cycle"))


@query("SELECT period_start, period_end, count(*) AS n, count(*) FILTER (cycle_started) AS n_started FROM jurisdictions GROUP BY ALL")
def cycle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "jurisdictions").groupBy("period_start", "period_end").agg(F.count("*").alias("n"), F.count_if("cycle_started").alias("n_started"))


@query(f"""
WITH r AS (SELECT DISTINCT source_index FROM dedup_audit), t AS (SELECT p.*, {UNITS} AS units, p.source_index IN (SELECT source_index FROM r) AS removed FROM permit_records p)
SELECT count(*) AS selected_rows, count(*) FILTER (NOT removed) AS retained_rows, count(*) FILTER (removed) AS removed_rows, CAST(sum(units) AS BIGINT) AS selected_units, CAST(sum(units) FILTER (NOT removed) AS BIGINT) AS retained_units, CAST(sum(units) FILTER (removed) AS BIGINT) AS removed_units, sum(units) = sum(units) FILTER (NOT removed) + sum(units) FILTER (removed) AS conserved FROM t""")
def conservation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "dedup_audit").select("source_index", F.lit(True).alias("gone")).distinct()
    t = table(spark, sf_dir, "permit_records").select("source_index", _units().alias("units")).join(gone, "source_index", "left").withColumn("removed", F.col("gone").isNotNull())
    part = {"selected": F.lit(True), "retained": ~F.col("removed"), "removed": F.col("removed")}
    sums = t.agg(*[F.count_if(c).alias(f"{n}_rows") for n, c in part.items()], *[F.sum(F.when(c, F.col("units"))).alias(f"{n}_units") for n, c in part.items()])
    return sums.withColumn("conserved", F.col("selected_units") == F.col("retained_units") + F.col("removed_units"))


@query(f"SELECT unit_category, tenure, count(*) AS n_rows, CAST(sum({UNITS}) AS BIGINT) AS units, CAST(grouping(unit_category) AS INT) AS all_categories, CAST(grouping(tenure) AS INT) AS all_tenures FROM permit_records GROUP BY GROUPING SETS ((unit_category, tenure), (unit_category), (tenure), ())")
def band_cross_foot(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").withColumn("units", _units())
    sets = p.cube("unit_category", "tenure").agg(F.count("*").alias("n_rows"), F.sum("units").alias("units"), F.grouping("unit_category").cast("int").alias("all_categories"), F.grouping("tenure").cast("int").alias("all_tenures"))
    return sets.select("unit_category", "tenure", "n_rows", "units", "all_categories", "all_tenures")


@query(f"SELECT jurisdiction_display AS place, CAST(sum({UNITS}) FILTER (batch_no = 1) AS BIGINT) AS before, CAST(sum({UNITS}) AS BIGINT) AS after, CAST(coalesce(sum({UNITS}) FILTER (batch_no > 1), 0) AS BIGINT) AS delta FROM permit_records GROUP BY 1")
def before_after_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").withColumn("units", _units())
    return p.groupBy(F.col("jurisdiction_display").alias("place")).agg(F.sum(F.when(F.col("batch_no") == 1, F.col("units"))).alias("before"), F.sum("units").alias("after"), F.coalesce(F.sum(F.when(F.col("batch_no") > 1, F.col("units"))), F.lit(0)).alias("delta"))


@query("""
WITH b AS (SELECT juris_key, CASE WHEN count(p.source_index) FILTER (batch_no = 1) > 0 THEN 'reported' ELSE 'none' END AS before, CASE WHEN count(p.source_index) > 0 THEN 'reported' ELSE 'none' END AS after FROM jurisdictions j LEFT JOIN permit_records p ON p.jurisdiction = j.juris_key GROUP BY 1)
SELECT before, after, count(*) AS n FROM b GROUP BY ALL""")
def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").groupBy(F.col("jurisdiction").alias("juris_key")).agg(F.count_if(F.col("batch_no") == 1).alias("first"), F.count("*").alias("every"))
    b = table(spark, sf_dir, "jurisdictions").select("juris_key").join(p, "juris_key", "left").na.fill(0)
    named = [F.when(F.col(c) > 0, "reported").otherwise("none").alias(n) for c, n in (("first", "before"), ("every", "after"))]
    return b.select(*named).groupBy("before", "after").agg(F.count("*").alias("n"))


@query("SELECT report_year, count(*) AS n, count(*) FILTER (permit_date IS NULL) AS n_undated, 4 * count(*) FILTER (permit_date IS NULL) <= count(*) AS within_quarter FROM permit_records GROUP BY 1")
def share_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    undated = F.count_if(F.col("permit_date").isNull())
    return table(spark, sf_dir, "permit_records").groupBy("report_year").agg(F.count("*").alias("n"), undated.alias("n_undated"), (undated * 4 <= F.count("*")).alias("within_quarter"))


@query("""
WITH e AS (SELECT audit_id, unnest(retained_source_indices) AS ref FROM dedup_audit)
SELECT audit_id, CAST(sum(DISTINCT p.reported_total) AS BIGINT) AS distinct_total, max(p.permit_date) AS last_day, list_sort(list(DISTINCT p.unit_category)) AS categories, CAST(floor(100.0 * sum(p.reported_total) / count(p.reported_total)) AS BIGINT) AS average_cents FROM e JOIN permit_records p ON p.source_index = e.ref GROUP BY 1""")
def link_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "dedup_audit").select("audit_id", F.explode("retained_source_indices").alias("source_index"))
    p = table(spark, sf_dir, "permit_records").select("source_index", "reported_total", "permit_date", "unit_category")
    average = F.floor(F.try_divide(F.lit(100.0) * F.sum("reported_total"), F.count("reported_total")))
    return e.join(p, "source_index").groupBy("audit_id").agg(F.sum_distinct("reported_total").alias("distinct_total"), F.max("permit_date").alias("last_day"), F.array_sort(F.collect_set("unit_category")).alias("categories"), average.alias("average_cents"))


@query("SELECT audit_id, CAST(len(coalesce(matched_source_indices, [])) AS INT) AS n_links, len(coalesce(matched_source_indices, [])) > 1 AS several FROM dedup_audit")
def link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.coalesce(F.size("matched_source_indices"), F.lit(0))
    n = F.when(F.col("matched_source_indices").isNull(), 0).otherwise(n).cast("int")
    return table(spark, sf_dir, "dedup_audit").select("audit_id", n.alias("n_links"), (n > 1).alias("several"))


@query("""
SELECT source_index, count(*) AS n, CAST(count(*) - 1 AS BIGINT) AS excess, count(DISTINCT rule_name) > 1 AS conflicting FROM dedup_audit GROUP BY 1 HAVING count(*) > 1""")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "dedup_audit").groupBy("source_index").agg(F.count("*").alias("n"), (F.count("*") - 1).alias("excess"), (F.countDistinct("rule_name") > 1).alias("conflicting"))
    return g.where("n > 1")


@query("SELECT snapshot_file, count(*) FILTER (regexp_matches(raw_line, '#(REF|VALUE|N/A|DIV/0)!?')) AS n_errors, count(*) AS n FROM apr_lines GROUP BY 1")
def error_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "apr_lines").groupBy("snapshot_file").agg(F.count_if(F.col("raw_line").rlike("#(REF|VALUE|N/A|DIV/0)!?")).alias("n_errors"), F.count("*").alias("n"))


_CHECKS = {
    "dates in period": ("critical", "permit_date IS NULL OR permit_date >= DATE '2000-01-01'"),
    "total is sum of bands": ("warning", f"reported_total = {UNITS}"),
    "has a parcel": ("info", "formatted_apn <> ''"),
}


@query(" UNION ALL ".join(f"SELECT '{n}' AS check_name, '{s}' AS severity, count(*) AS objects, count(*) FILTER (NOT coalesce({c}, false)) AS failures, CASE WHEN count(*) FILTER (NOT coalesce({c}, false)) = 0 THEN 'pass' ELSE 'fail' END AS status FROM permit_records" for n, (s, c) in _CHECKS.items()))
def check_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records")
    # all checks in one pass over the rows, then one row for each
    sums = p.agg(F.count("*").alias("objects"), *[F.count_if(~F.coalesce(F.expr(c), F.lit(False))).alias(f"f{i}") for i, (_, c) in enumerate(_CHECKS.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"), F.col("objects"), F.col(f"f{i}").alias("failures")) for i, (n, (s, _)) in enumerate(_CHECKS.items())])
    return sums.select(F.explode(rows).alias("r")).select("r.*").withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


@query("""
WITH c AS (SELECT dup_group, report_year, count(*) AS n FROM ledger_rows GROUP BY ALL), s AS (SELECT dup_group, max(report_year) AS last_year, arg_max(n, report_year) AS last_n, max(n) AS most FROM c GROUP BY 1 HAVING count(*) > 1)
SELECT ledger_id, dup_group, last_year AS latest_year FROM ledger_rows JOIN s USING (dup_group) WHERE last_n >= most AND report_year < last_year""")
def snapshot_latest_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.latest_guarded(table(spark, sf_dir, "ledger_rows"), ["dup_group"], "report_year").select("ledger_id", "dup_group", "latest_year")


@query(f"SELECT report_year, count(*) AS n FROM {_PERMITS} WHERE permit_date > DATE '{CUTOFF}' GROUP BY 1")
def beyond_cutoff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permits(spark, sf_dir).where(F.col("permit_date") > F.lit(CUTOFF).cast("date")).groupBy("report_year").agg(F.count("*").alias("n"))


@query("SELECT juris_key, juris_display FROM jurisdictions ORDER BY lower(juris_display)")
def casefolded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "jurisdictions").select("juris_key", "juris_display").orderBy(F.lower("juris_display"))


@query("SELECT lower(doc_title) AS title, count(*) AS n, CAST(count(*) - 1 AS BIGINT) AS excess FROM documents WHERE doc_title IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def case_folded_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "documents").where("doc_title is not null").groupBy(F.lower("doc_title").alias("title")).agg(F.count("*").alias("n"))
    return g.where("n > 1").withColumn("excess", F.col("n") - 1)

