"""Queries of joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.operators import relational as R
from snaploom.queries.registry import query
from snaploom.storage import table

CUTOFF = "2022-12-31"
BANDS = ("acutely_low", "extremely_low", "very_low", "low", "moderate", "above_moderate")


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permit rows with the key of their jurisdiction as listed; rows typed otherwise have none."""
    p, j = table(spark, sf_dir, "permit_records"), table(spark, sf_dir, "jurisdictions")
    names = j.select("juris_key", F.explode(F.array_distinct(F.array("juris_key", "juris_display"))).alias("jurisdiction"))
    return p.join(names, "jurisdiction")


_PERMITS = "(SELECT p.*, n.juris_key FROM permit_records p JOIN (SELECT juris_key, juris_key AS name FROM jurisdictions UNION SELECT juris_key, juris_display FROM jurisdictions) n ON p.jurisdiction = n.name)"


@query(f"""
SELECT source_index, juris_key, permit_date FROM {_PERMITS} p JOIN jurisdictions j USING (juris_key)
WHERE CASE WHEN permit_date IS NULL THEN report_year BETWEEN year(period_start) AND year(period_end) ELSE permit_date BETWEEN period_start AND least(period_end, DATE '{CUTOFF}') END""")
def period_window_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.window_select(permits(spark, sf_dir), table(spark, sf_dir, "jurisdictions"), "juris_key", "permit_date", "report_year", cutoff=CUTOFF)
    return rows.select("source_index", "juris_key", "permit_date")


@query("SELECT jurisdiction, count(*) AS n FROM permit_records WHERE jurisdiction IS NOT NULL AND jurisdiction NOT IN (SELECT juris_key FROM jurisdictions UNION SELECT juris_display FROM jurisdictions) GROUP BY 1")
def unmatched_jurisdictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "jurisdictions")
    names = j.select(F.explode(F.array("juris_key", "juris_display")).alias("jurisdiction"))
    p = table(spark, sf_dir, "permit_records").where("jurisdiction is not null")
    return p.join(names, "jurisdiction", "left_anti").groupBy("jurisdiction").agg(F.count("*").alias("n"))


@query(f"SELECT juris_key FROM jurisdictions WHERE juris_key NOT IN (SELECT juris_key FROM {_PERMITS} WHERE report_year = 2025)")
def periods_without_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = permits(spark, sf_dir).where("report_year = 2025")
    return table(spark, sf_dir, "jurisdictions").join(rows, "juris_key", "left_anti").select("juris_key")


@query("""
WITH o AS (SELECT juris_key, DATE '2017-01-01' AS period_start, DATE '2025-01-01' AS period_end FROM jurisdictions WHERE unincorporated)
SELECT j.juris_key, coalesce(o.period_start, j.period_start) AS period_start, coalesce(o.period_end, j.period_end) AS period_end FROM jurisdictions j LEFT JOIN o USING (juris_key)""")
def override_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "jurisdictions")
    o = j.where("unincorporated").select("juris_key", F.lit("2017-01-01").cast("date").alias("period_start"), F.lit("2025-01-01").cast("date").alias("period_end"))
    return R.override(j.select("juris_key", "period_start", "period_end"), o, "juris_key", ["period_start", "period_end"])


@query(f"""
SELECT j.juris_key, {", ".join(f"CAST(coalesce(sum({b}), 0) AS BIGINT) AS {b}" for b in BANDS)}, CAST(coalesce(sum(CASE WHEN permit_date IS NULL THEN {" + ".join(BANDS)} END), 0) AS BIGINT) AS undated_units, count(p.source_index) AS n_rows,
  CASE WHEN count(p.source_index) > 0 THEN 'reported' ELSE 'no_selected_rows' END AS data_status
FROM jurisdictions j LEFT JOIN {_PERMITS} p USING (juris_key) GROUP BY 1""")
def jurisdiction_totals_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = sum((F.col(b) for b in BANDS[1:]), F.col(BANDS[0]))
    sums = {b: F.col(b) for b in BANDS} | {"undated_units": F.when(F.col("permit_date").isNull(), units)}
    return R.zero_filled(table(spark, sf_dir, "jurisdictions").select("juris_key"), permits(spark, sf_dir), "juris_key", sums)


@query("""
WITH a AS (SELECT jurisdiction_display AS place, CAST(sum(reported_total) AS BIGINT) AS permit_units FROM permit_records GROUP BY 1), b AS (SELECT jurisdiction_display AS place, CAST(sum(reported_total) AS BIGINT) AS ledger_units FROM ledger_rows GROUP BY 1)
SELECT place, permit_units, ledger_units FROM a JOIN b USING (place)""")
def merged_stage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "permit_records").groupBy(F.col("jurisdiction_display").alias("place")).agg(F.sum("reported_total").alias("permit_units"))
    b = table(spark, sf_dir, "ledger_rows").groupBy(F.col("jurisdiction_display").alias("place")).agg(F.sum("reported_total").alias("ledger_units"))
    return a.join(b, "place")


@query("""
SELECT a.source_index AS a, b.source_index AS b FROM permit_records a JOIN permit_records b ON a.jurisdiction = b.jurisdiction AND a.permit_date = b.permit_date AND a.source_index < b.source_index AND a.report_year <> b.report_year AND a.formatted_apn = b.formatted_apn WHERE a.formatted_apn <> ''""")
def block_pair_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").where("formatted_apn <> ''").select("source_index", "jurisdiction", "permit_date", "report_year", "formatted_apn")
    return R.pair_edges(p, ["jurisdiction", "permit_date", "formatted_apn"], "source_index", year="report_year")


@query("""
WITH m AS (SELECT *, max(report_year) OVER (PARTITION BY jurisdiction, tracking_raw) AS last_year FROM permit_records WHERE tracking_raw <> '' AND jurisdiction IS NOT NULL)
SELECT a.source_index AS earlier, b.source_index AS latest FROM m a JOIN m b ON a.jurisdiction = b.jurisdiction AND a.tracking_raw = b.tracking_raw AND a.report_year < a.last_year AND b.report_year = b.last_year AND a.permit_date = b.permit_date""")
def cross_year_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").where("tracking_raw <> ''").select("source_index", "jurisdiction", "tracking_raw", "report_year", "permit_date")
    rows = R.with_latest(p, ["jurisdiction", "tracking_raw"], "report_year")
    early = rows.where("report_year < latest_year").select(F.col("source_index").alias("earlier"), "jurisdiction", "tracking_raw", "permit_date")
    late = rows.where("report_year = latest_year").select(F.col("source_index").alias("latest"), "jurisdiction", "tracking_raw", "permit_date")
    return early.join(late, ["jurisdiction", "tracking_raw", "permit_date"]).select("earlier", "latest")


@query("""
SELECT DISTINCT a.jurisdiction_display, a.tracking_raw FROM permit_records a JOIN permit_records b ON a.jurisdiction_display = b.jurisdiction_display AND a.tracking_raw = b.tracking_raw AND a.report_year = b.report_year AND a.formatted_apn <> b.formatted_apn WHERE a.formatted_apn <> '' AND b.formatted_apn <> '' AND a.tracking_raw <> ''""")
def collision_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").where("formatted_apn <> '' AND tracking_raw <> '' AND jurisdiction_display is not null AND report_year is not null")
    per = p.groupBy("jurisdiction_display", "tracking_raw", "report_year").agg(F.min("formatted_apn").alias("low"), F.max("formatted_apn").alias("high"))
    return per.where("low <> high").select("jurisdiction_display", "tracking_raw").distinct()


_REFS = "(SELECT source_index, unnest(list_distinct(list_concat(coalesce(retained_source_indices, []), coalesce(matched_source_indices, [])))) AS ref FROM dedup_audit)"


@query(f"SELECT source_index FROM permit_records WHERE source_index IN (SELECT source_index FROM dedup_audit UNION SELECT ref FROM {_REFS})")
def ledger_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "dedup_audit")
    refs = R.references(a, ["retained_source_indices", "matched_source_indices"]).unionAll(a.select("source_index"))
    return table(spark, sf_dir, "permit_records").select("source_index").join(refs, F.col("source_index") == F.col("ref"), "left_semi")


@query("SELECT p.source_index, a.audit_id, coalesce(a.rule_name, 'kept') AS decision FROM permit_records p LEFT JOIN dedup_audit a USING (source_index)")
def audit_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "dedup_audit").select("source_index", "audit_id", "rule_name")
    p = table(spark, sf_dir, "permit_records").select("source_index")
    return p.join(a, "source_index", "left").select("source_index", "audit_id", F.coalesce("rule_name", F.lit("kept")).alias("decision"))


@query("""
WITH a AS (SELECT jurisdiction_display AS place, CAST(sum(reported_total) AS BIGINT) AS published FROM permit_records GROUP BY 1), b AS (SELECT jurisdiction_display AS place, CAST(sum(acutely_low + extremely_low + very_low + low + moderate + above_moderate) AS BIGINT) AS recounted FROM permit_records GROUP BY 1)
SELECT place, published, recounted FROM a FULL JOIN b USING (place) WHERE published IS DISTINCT FROM recounted AND place IS NOT NULL""")
def totals_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").withColumnRenamed("jurisdiction_display", "place")
    a = p.groupBy("place").agg(F.sum("reported_total").alias("published"))
    b = p.groupBy("place").agg(F.sum(sum((F.col(x) for x in BANDS[1:]), F.col(BANDS[0]))).alias("recounted"))
    return a.join(b, "place", "full").where(~F.col("published").eqNullSafe(F.col("recounted"))).where("place is not null")


@query("""
WITH l AS (SELECT record_id, count(*) AS n_left FROM sync_expected GROUP BY 1), r AS (SELECT record_id, count(*) AS n_right FROM sync_desired GROUP BY 1)
SELECT record_id, coalesce(n_left, 0) AS n_left, coalesce(n_right, 0) AS n_right, CASE WHEN n_left IS NULL THEN 'only_right' WHEN n_right IS NULL THEN 'only_left' WHEN n_left > 1 OR n_right > 1 THEN 'repeated' ELSE 'matched' END AS found_as FROM l FULL JOIN r USING (record_id)""")
def record_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.sides(table(spark, sf_dir, "sync_expected"), table(spark, sf_dir, "sync_desired"), ["record_id"])


@query("""
WITH l AS (SELECT record_id, count(*) AS n_left FROM sync_expected GROUP BY 1), r AS (SELECT record_id, count(*) AS n_right FROM sync_desired GROUP BY 1)
SELECT record_id, CASE WHEN n_left IS NULL THEN 'unexpected' WHEN n_right IS NULL THEN 'missing' ELSE 'ambiguous' END AS problem FROM l FULL JOIN r USING (record_id) WHERE n_left IS DISTINCT FROM 1 OR n_right IS DISTINCT FROM 1""")
def one_to_one_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the two copies that don't face exactly one on the other side."""
    sides = R.sides(table(spark, sf_dir, "sync_expected"), table(spark, sf_dir, "sync_desired"), ["record_id"]).where("found_as <> 'matched'")
    problem = F.when(F.col("found_as") == "only_right", "unexpected").when(F.col("found_as") == "only_left", "missing").otherwise("ambiguous")
    return sides.select("record_id", problem.alias("problem"))


@query("""
WITH x AS (SELECT source_index, retained_source_indices[1] AS target, report_year FROM dedup_audit WHERE len(retained_source_indices) = 1)
SELECT x.source_index, x.target, p.report_year AS target_year FROM x JOIN permit_records p ON p.source_index = x.target AND p.report_year >= x.report_year""")
def single_link_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "dedup_audit").where("size(retained_source_indices) = 1").select("source_index", F.col("retained_source_indices")[0].alias("target"), "report_year")
    p = table(spark, sf_dir, "permit_records").select(F.col("source_index").alias("target"), F.col("report_year").alias("target_year"))
    return x.join(p, "target").where("target_year >= report_year").select("source_index", "target", "target_year")


_ALIASES = "SELECT juris_key, unnest([lower(juris_display), 'city of ' || lower(juris_display), lower(juris_display) || ', ca', lower(juris_display) || ' (' || lower(county) || ' county)']) AS alias FROM jurisdictions"
_ALIASED = f"(SELECT alias, min(juris_key) AS juris_key FROM ({_ALIASES}) GROUP BY 1 HAVING count(DISTINCT juris_key) = 1)"


@query(f"""
SELECT p.source_index, j.juris_key, CASE WHEN p.jurisdiction = j.juris_key THEN 'name' ELSE 'alias' END AS found_by FROM permit_records p LEFT JOIN {_ALIASED} a ON lower(trim(p.jurisdiction)) = a.alias JOIN jurisdictions j ON j.juris_key = CASE WHEN p.jurisdiction IN (SELECT juris_key FROM jurisdictions) THEN p.jurisdiction ELSE a.juris_key END""")
def alias_map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with their place by its key, or else by one of its aliases; an alias of several places is none."""
    j = table(spark, sf_dir, "jurisdictions")
    name, county = F.lower("juris_display"), F.lower("county")
    each = j.select(F.col("juris_key").alias("key"), F.explode(F.array(name, F.concat(F.lit("city of "), name), F.concat(name, F.lit(", ca")), F.concat(name, F.lit(" ("), county, F.lit(" county)")))).alias("alias"))
    aliases = each.groupBy("alias").agg(F.min("key").alias("by_alias"), F.count_distinct("key").alias("n")).where("n = 1").drop("n")
    keys = j.select("juris_key")
    p = table(spark, sf_dir, "permit_records").select("source_index", "jurisdiction").join(keys, F.col("jurisdiction") == F.col("juris_key"), "left").withColumnRenamed("juris_key", "by_key")
    found = p.join(aliases, F.lower(F.trim("jurisdiction")) == F.col("alias"), "left").select("source_index", F.coalesce("by_key", "by_alias").alias("juris_key"), F.when(F.col("by_key").isNotNull(), "name").otherwise("alias").alias("found_by"))
    return found.where("juris_key is not null")


@query("""
WITH s AS (SELECT audit_id, CASE WHEN len(coalesce(retained_source_indices, [])) > 0 THEN retained_source_indices[1] END AS by_id, CASE WHEN trim(coalesce(tracking_id, '')) <> '' THEN tracking_id END AS by_value, jurisdiction FROM dedup_audit)
SELECT audit_id, source_index, 'id' AS found_by FROM s JOIN permit_records ON source_index = by_id UNION ALL SELECT audit_id, source_index, 'value' FROM s JOIN permit_records p ON by_id IS NULL AND p.tracking_raw = by_value AND p.jurisdiction = s.jurisdiction
UNION ALL SELECT audit_id, NULL, 'no selector' FROM s WHERE by_id IS NULL AND by_value IS NULL""")
def match_by_id_or_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entry's rows by the index it retains, or else by its number and place; entries with neither are told."""
    s = table(spark, sf_dir, "dedup_audit").select("audit_id", F.try_element_at("retained_source_indices", F.lit(1)).alias("by_id"), F.when(F.trim("tracking_id") != "", F.col("tracking_id")).alias("tracking_raw"), "jurisdiction")
    p = table(spark, sf_dir, "permit_records").select("source_index", "tracking_raw", "jurisdiction")
    by_id = s.join(p.select("source_index"), F.col("by_id") == F.col("source_index")).select("audit_id", "source_index", F.lit("id").alias("found_by"))
    by_value = s.where("by_id is null").join(p, ["tracking_raw", "jurisdiction"]).select("audit_id", "source_index", F.lit("value").alias("found_by"))
    neither = s.where("by_id is null and tracking_raw is null").select("audit_id", F.lit(None).cast("bigint").alias("source_index"), F.lit("no selector").alias("found_by"))
    return by_id.unionAll(by_value).unionAll(neither)


@query("""
WITH l AS (SELECT juris_key, report_year, permit_date FROM (SELECT n.juris_key, p.* FROM permit_records p JOIN (SELECT juris_key, juris_display AS name FROM jurisdictions) n ON p.jurisdiction = n.name)),
a AS (SELECT juris_key, year(permit_date) AS y, quarter(permit_date) AS q, count(*) AS n FROM l WHERE permit_date IS NOT NULL GROUP BY ALL),
b AS (SELECT n.juris_key, year(permit_date) AS y, quarter(permit_date) AS q, count(*) AS n FROM ledger_rows r JOIN (SELECT juris_key, juris_display AS name FROM jurisdictions) n ON r.jurisdiction_display = n.name WHERE permit_date IS NOT NULL GROUP BY ALL)
SELECT juris_key, CAST(y AS INT) AS year, CAST(q AS INT) AS quarter, CASE WHEN a.n IS NULL THEN 'orphan' WHEN b.n IS NULL THEN 'missing' ELSE 'matched' END AS found_as FROM a FULL JOIN b USING (juris_key, y, q)""")
def series_record_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "jurisdictions").select("juris_key", F.col("juris_display").alias("name"))
    cell = ["juris_key", F.year("permit_date").alias("year"), F.quarter("permit_date").alias("quarter")]
    a = table(spark, sf_dir, "permit_records").where("permit_date is not null").join(j, F.col("jurisdiction") == F.col("name")).select(*cell).distinct()
    b = table(spark, sf_dir, "ledger_rows").where("permit_date is not null").join(j, F.col("jurisdiction_display") == F.col("name")).select(*cell).distinct()
    names = F.when(F.col("found_as") == "only_right", "orphan").when(F.col("found_as") == "only_left", "missing").otherwise("matched")
    return R.sides(a, b, ["juris_key", "year", "quarter"]).select("juris_key", "year", "quarter", names.alias("found_as"))


@query("""
WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents WHERE text IS NULL OR text = ''), b AS (SELECT audit_id, row_number() OVER (ORDER BY audit_id) - 1 AS position FROM dedup_audit)
SELECT position, doc_id, audit_id FROM a JOIN b USING (position)""")
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanks = table(spark, sf_dir, "documents").where("text is null or text = ''").select("doc_id")
    return R.zipped(blanks, table(spark, sf_dir, "dedup_audit").select("audit_id"), ["doc_id"], ["audit_id"])


@query("SELECT a.audit_id, list(p.tracking_raw ORDER BY i) AS linked FROM (SELECT audit_id, unnest(matched_source_indices) AS target, generate_subscripts(matched_source_indices, 1) AS i FROM dedup_audit) a JOIN permit_records p ON p.source_index = a.target GROUP BY 1")
def linked_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, p = table(spark, sf_dir, "dedup_audit"), table(spark, sf_dir, "permit_records")
    return R.linked_values(a, "audit_id", "matched_source_indices", p, "source_index", "tracking_raw").where("size(linked) > 0")


@query("""
WITH e AS (SELECT audit_id, unnest(matched_source_indices) AS target FROM dedup_audit), k AS (SELECT source_index FROM permit_records WHERE batch_no = 1), per AS (SELECT audit_id, target, count(*) AS n FROM e GROUP BY ALL)
SELECT audit_id, CAST(sum(n) AS BIGINT) AS links, CAST(sum(n - 1) AS BIGINT) AS repeated, CAST(sum(CASE WHEN target IN (SELECT source_index FROM k) THEN 0 ELSE n END) AS BIGINT) AS orphans FROM per GROUP BY 1""")
def link_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = table(spark, sf_dir, "permit_records").where("batch_no = 1")
    return R.link_integrity(table(spark, sf_dir, "dedup_audit"), "audit_id", "matched_source_indices", history, "source_index")


@query("SELECT dup_group, ledger_id, report_year FROM (SELECT *, rank() OVER (PARTITION BY dup_group ORDER BY report_year DESC) AS r FROM ledger_rows WHERE report_year IS NOT NULL) WHERE r = 1")
def latest_linked_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.with_latest(table(spark, sf_dir, "ledger_rows").where("report_year is not null"), ["dup_group"], "report_year")
    return rows.where("report_year = latest_year").select("dup_group", "ledger_id", "report_year")


@query("""
WITH e AS (SELECT audit_id, unnest(list_concat(coalesce(matched_source_indices, []), coalesce(retained_source_indices, []))) AS target FROM dedup_audit)
SELECT audit_id, list_sort(list(DISTINCT l.tenure)) AS tenures FROM e JOIN permit_records p ON p.source_index = e.target JOIN ledger_rows l ON l.jurisdiction_display = p.jurisdiction_display AND l.permit_date = p.permit_date WHERE l.tenure IS NOT NULL GROUP BY 1""")
def two_hop_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = R.references(table(spark, sf_dir, "dedup_audit"), ["matched_source_indices", "retained_source_indices"], ["audit_id"])
    p = table(spark, sf_dir, "permit_records").select(F.col("source_index").alias("ref"), "jurisdiction_display", "permit_date")
    values = table(spark, sf_dir, "ledger_rows").where("tenure is not null").select("jurisdiction_display", "permit_date", "tenure").distinct()
    return e.join(p, "ref").join(values, ["jurisdiction_display", "permit_date"]).groupBy("audit_id").agg(F.array_sort(F.collect_set("tenure")).alias("tenures"))


@query("SELECT a.audit_id, p.street_address FROM dedup_audit a JOIN permit_records p ON p.source_index = a.matched_source_indices[-1]")
def last_link_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.try_element_at("matched_source_indices", F.lit(-1)).alias("source_index")
    return table(spark, sf_dir, "dedup_audit").select("audit_id", last).join(table(spark, sf_dir, "permit_records").select("source_index", "street_address"), "source_index").select("audit_id", "street_address")


@query("""
(SELECT 'only_permits' AS side, jurisdiction_display AS place FROM permit_records WHERE jurisdiction_display IS NOT NULL EXCEPT SELECT 'only_permits', jurisdiction_display FROM ledger_rows)
UNION ALL (SELECT 'only_ledger', jurisdiction_display FROM ledger_rows WHERE jurisdiction_display IS NOT NULL EXCEPT SELECT 'only_ledger', jurisdiction_display FROM permit_records)""")
def symmetric_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (table(spark, sf_dir, t).where("jurisdiction_display is not null").select(F.col("jurisdiction_display").alias("place")).distinct() for t in ("permit_records", "ledger_rows"))
    sides = R.sides(a, b, ["place"]).where("found_as in ('only_left', 'only_right')")
    return sides.select(F.when(F.col("found_as") == "only_left", "only_permits").otherwise("only_ledger").alias("side"), "place")


@query("SELECT audit_id, list_sort(list_distinct(list_concat(coalesce(matched_source_indices, []), coalesce(retained_source_indices, [])))) AS refs, len(list_intersect(coalesce(matched_source_indices, []), coalesce(retained_source_indices, []))) > 0 AS overlap FROM dedup_audit")
def reference_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (F.coalesce(F.col(c), F.array().cast("array<bigint>")) for c in ("matched_source_indices", "retained_source_indices"))
    return table(spark, sf_dir, "dedup_audit").select("audit_id", F.array_sort(F.array_union(a, b)).alias("refs"), (F.size(F.array_intersect(a, b)) > 0).alias("overlap"))


@query("""
WITH a AS (SELECT formatted_apn AS v, count(*) AS n_left FROM permit_records WHERE batch_no = 1 GROUP BY 1), b AS (SELECT formatted_apn AS v, count(*) AS n_right FROM permit_records WHERE batch_no > 1 GROUP BY 1)
SELECT v, coalesce(n_left, 0) AS n_left, coalesce(n_right, 0) AS n_right FROM a FULL JOIN b USING (v) WHERE coalesce(n_left, 0) <> coalesce(n_right, 0)""")
def multiset_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").select("batch_no", F.col("formatted_apn").alias("v"))
    return R.multiset_difference(p.where("batch_no = 1").select("v"), p.where("batch_no > 1").select("v"))


@query("""
WITH c AS (SELECT a.source_index AS a, b.source_index AS b, CAST(a.formatted_apn = b.formatted_apn AS INT) + CAST(a.latitude = b.latitude AS INT) + CAST(a.street_address = b.street_address AS INT) AS signals
  FROM permit_records a JOIN permit_records b ON a.jurisdiction = b.jurisdiction AND a.permit_date = b.permit_date AND a.report_year < b.report_year)
SELECT a AS source_index, b AS best, signals FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY signals DESC, b) AS r FROM c WHERE signals > 0) WHERE r = 1""")
def best_match_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").select("source_index", "jurisdiction", "permit_date", "report_year", "formatted_apn", "latitude", "street_address")
    signals = sum(((F.col(f"l.{c}") == F.col(f"r.{c}")).cast("int") for c in ("latitude", "street_address")), (F.col("l.formatted_apn") == F.col("r.formatted_apn")).cast("int"))
    on = (F.col("l.jurisdiction") == F.col("r.jurisdiction")) & (F.col("l.permit_date") == F.col("r.permit_date")) & (F.col("l.report_year") < F.col("r.report_year"))
    c = p.alias("l").join(p.alias("r"), on).select(F.col("l.source_index").alias("source_index"), F.col("r.source_index").alias("best"), signals.alias("signals")).where("signals > 0")
    return R.best_match(c, "source_index", [F.col("signals").desc(), F.col("best")])


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT source_index AS node, unnest(retained_source_indices) AS next FROM dedup_audit), f AS (SELECT node, next FROM e WHERE next > node), w AS (SELECT node, next AS final FROM f UNION SELECT w.node, f.next FROM w JOIN f ON w.final = f.node)
SELECT node, final FROM w WHERE final NOT IN (SELECT node FROM f)""")
def lineage_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = R.references(table(spark, sf_dir, "dedup_audit"), ["retained_source_indices"], ["source_index"])
    return R.ancestors(e.where("ref > source_index").select(F.col("source_index").alias("node"), F.col("ref").alias("next")))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT source_index AS node, unnest(retained_source_indices) AS next FROM dedup_audit), f AS (SELECT node, next FROM e WHERE next <> node), w AS (SELECT node, next AS final FROM f UNION SELECT w.node, f.next FROM w JOIN f ON w.final = f.node),
looped AS (SELECT node FROM w WHERE node = final), cyclic AS (SELECT node FROM looped UNION SELECT node FROM w WHERE final IN (SELECT node FROM looped)), ends AS (SELECT node, final FROM w WHERE final NOT IN (SELECT node FROM f))
SELECT node, final, node IN (SELECT node FROM cyclic) AS cyclic FROM ends UNION ALL SELECT node, NULL, true FROM cyclic WHERE node NOT IN (SELECT node FROM ends)""")
def lineage_resolution_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all retained links, whichever index is larger; ``lineage_resolution`` follows those to larger ones only, as its SQL does."""
    e = R.references(table(spark, sf_dir, "dedup_audit"), ["retained_source_indices"], ["source_index"])
    return R.lineage_ends(e.select(F.col("source_index").alias("node"), F.col("ref").alias("next")))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT source_index AS node, unnest(matched_source_indices) AS next FROM dedup_audit), r AS (SELECT node, next FROM e UNION SELECT r.node, e.next FROM r JOIN e ON r.next = e.node), cyclic AS (SELECT DISTINCT node FROM r WHERE node = next)
SELECT node, next FROM e WHERE next IN (SELECT node FROM cyclic) OR next IN (SELECT node FROM r WHERE r.next IN (SELECT node FROM cyclic))""")
def dependency_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = R.references(table(spark, sf_dir, "dedup_audit"), ["matched_source_indices"], ["source_index"])
    return R.peel(e.select(F.col("source_index").alias("node"), F.col("ref").alias("next")))


@query("""SELECT p.source_index, j.county FROM permit_records p LEFT JOIN jurisdictions j ON upper(trim(p.jurisdiction)) = j.juris_key""")
def folded_key_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "jurisdictions").select("juris_key", "county")
    return table(spark, sf_dir, "permit_records").join(j, F.upper(F.trim("jurisdiction")) == F.col("juris_key"), "left").select("source_index", "county")


@query("SELECT juris_key, year, quarter, make_date(year, quarter * 3 - 2, 1) AS starts FROM jurisdictions, (SELECT CAST(unnest(range(2018, 2026)) AS INT) AS year), (SELECT CAST(unnest(range(1, 5)) AS INT) AS quarter)")
def dense_quarter_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.quarter_spine(table(spark, sf_dir, "jurisdictions"), "juris_key", 2018, 2025)



