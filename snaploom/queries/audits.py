"""Audit checks over the domain tables, each beside the SQL of its objects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.operators import relational as R
from snaploom.plans import audits, sync
from snaploom.plans.snapshots import RULES
from snaploom.queries.joins import BANDS
from snaploom.queries.plans import _DESIRED, _EXPECTED, _copies
from snaploom.queries.registry import QUERIES, SQL
from snaploom.storage import table

Objects = Callable[[SparkSession, str], DataFrame]
UNITS = " + ".join(BANDS)
COUNTS = ("vli", "li", "mi", "ami", "permit_total", "undated_permits")
_CHECKS: list[str] = []


def audit(domain: str, name: str, failed: str, label: str, sql: str, severity: str = "error", sql_failed: str | None = None) -> Callable[[Objects], Objects]:
    """Registers a check whose objects the function gives and the SQL gives too."""

    def register(objects: Objects) -> Objects:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return audits.check(objects(spark, sf_dir), failed, label, domain, name, severity)

        QUERIES[f"audit_{objects.__name__}"] = run
        SQL[f"audit_{objects.__name__}"] = audits.check_sql(sql, sql_failed or failed, label, domain, name, severity)
        _CHECKS.append(f"audit_{objects.__name__}")
        return objects

    return register


@audit("dependencies", "computed fields are valid", "reported_total IS NULL OR reported_total < 0", "source_index", "SELECT * FROM permit_records")
def computed_fields(spark, sf_dir):
    return table(spark, sf_dir, "permit_records").select("source_index", "reported_total")


_REFS = "SELECT audit_id, jurisdiction, 'matched' AS kind, unnest(list_distinct(matched_source_indices)) AS ref FROM dedup_audit UNION ALL SELECT audit_id, jurisdiction, 'retained', unnest(list_distinct(retained_source_indices)) FROM dedup_audit"


@audit("dependencies", "references resolve by their kind", "target IS NULL OR (kind = 'retained' AND target_place <> jurisdiction)", "audit_id", f"SELECT r.*, p.source_index AS target, p.jurisdiction AS target_place FROM ({_REFS}) r LEFT JOIN permit_records p ON p.source_index = r.ref WHERE r.ref IS NOT NULL")
def references_resolve(spark, sf_dir):
    a = table(spark, sf_dir, "dedup_audit")
    refs = R.references(a, ["matched_source_indices"], ["audit_id", "jurisdiction"]).withColumn("kind", F.lit("matched")).unionAll(R.references(a, ["retained_source_indices"], ["audit_id", "jurisdiction"]).withColumn("kind", F.lit("retained")))
    targets = table(spark, sf_dir, "permit_records").select(F.col("source_index").alias("target"), F.col("jurisdiction").alias("target_place"))
    return refs.join(targets, F.col("ref") == F.col("target"), "left")


@audit("dependencies", "links have their inverse", "inverse IS NULL", "source_index || '>' || ref", """
WITH e AS (SELECT DISTINCT source_index, unnest(matched_source_indices) AS ref FROM dedup_audit) SELECT e.source_index, e.ref, b.source_index AS inverse FROM e LEFT JOIN e b ON b.source_index = e.ref AND b.ref = e.source_index WHERE e.ref <> e.source_index""", "warning")
def inverse_links(spark, sf_dir):
    e = R.references(table(spark, sf_dir, "dedup_audit"), ["matched_source_indices"], ["source_index"]).distinct().where("ref <> source_index")
    back = e.select(F.col("ref").alias("source_index"), F.col("source_index").alias("ref"), F.lit(True).alias("inverse"))
    return e.join(back, ["source_index", "ref"], "left")


@audit("dependencies", "single links are single", "size(retained_source_indices) > 1", "audit_id", "SELECT * FROM dedup_audit", "warning", "len(retained_source_indices) > 1")
def single_links(spark, sf_dir):
    return table(spark, sf_dir, "dedup_audit").select("audit_id", "retained_source_indices")


@audit("dependencies", "stored counts are those of what they count", "n_chars <> length(text)", "doc_id", "SELECT doc_id, n_chars, text FROM documents WHERE text IS NOT NULL")
def count_fields(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "n_chars", "text")


_SAME = "permit_date IS NOT DISTINCT FROM own_date AND jurisdiction IS NOT DISTINCT FROM own_place AND report_year IS NOT DISTINCT FROM own_year"


@audit("dependencies", "lookups equal what they look up", f"NOT ({_SAME})", "source_index", "SELECT a.source_index, a.permit_date, a.jurisdiction, a.report_year, p.permit_date AS own_date, p.jurisdiction AS own_place, p.report_year AS own_year FROM dedup_audit a JOIN permit_records p USING (source_index)")
def lookups(spark, sf_dir):
    own = table(spark, sf_dir, "permit_records").select("source_index", F.col("permit_date").alias("own_date"), F.col("jurisdiction").alias("own_place"), F.col("report_year").alias("own_year"))
    return table(spark, sf_dir, "dedup_audit").select("source_index", "permit_date", "jurisdiction", "report_year").join(own, "source_index")


@audit("dependencies", "the last link has the retained year", "target_year <> retained_report_year", "audit_id", "SELECT audit_id, retained_report_year, p.report_year AS target_year FROM dedup_audit a JOIN permit_records p ON p.source_index = a.retained_source_indices[-1]")
def last_links(spark, sf_dir):
    last = F.try_element_at("retained_source_indices", F.lit(-1)).alias("source_index")
    years = table(spark, sf_dir, "permit_records").select("source_index", F.col("report_year").alias("target_year"))
    return table(spark, sf_dir, "dedup_audit").select("audit_id", "retained_report_year", last).join(years, "source_index")


@audit("dependencies", "rollups equal their groups", "stored IS DISTINCT FROM rolled OR (members = 0 AND stored IS NOT NULL)", "dup_group", "SELECT dup_group, max(retained_report_year) AS stored, max(report_year) AS rolled, count(report_year) AS members FROM ledger_rows GROUP BY 1")
def rollups(spark, sf_dir):
    return table(spark, sf_dir, "ledger_rows").groupBy("dup_group").agg(F.max("retained_report_year").alias("stored"), F.max("report_year").alias("rolled"), F.count("report_year").alias("members"))


@audit("dependencies", "a filled source has a filled output", "standard = ''", "batch_no", "SELECT batch_no, trim(coalesce(standard_address, '')) AS standard FROM permit_records WHERE trim(coalesce(street_address, '')) <> ''", "warning")
def filled_outputs(spark, sf_dir):
    p = table(spark, sf_dir, "permit_records").where("trim(coalesce(street_address, '')) <> ''")
    return p.selectExpr("batch_no", "trim(coalesce(standard_address, '')) as standard")


@audit("places", "places are listed once", "n <> 1", "name", "SELECT lower(juris_display) AS name, count(*) AS n FROM jurisdictions GROUP BY 1")
def places_listed_once(spark, sf_dir):
    return table(spark, sf_dir, "jurisdictions").groupBy(F.lower("juris_display").alias("name")).agg(F.count("*").alias("n"))


_PERIOD = "SELECT source_index, permit_date, period_start, period_end, reported_total, {units} AS units FROM permit_records p JOIN jurisdictions j ON p.jurisdiction = j.juris_display"


@audit("places", "totals are their bands unless overridden", "coalesce(reported_total, units) <> units", "source_index", f"SELECT source_index, reported_total, {UNITS} AS units FROM permit_records")
def totals_of_bands(spark, sf_dir):
    return table(spark, sf_dir, "permit_records").selectExpr("source_index", "reported_total", f"{UNITS} as units")


@audit("places", "dates are in the half-open period", "NOT (permit_date >= period_start AND permit_date < period_end)", "source_index", _PERIOD.format(units=UNITS), "warning")
def dates_in_period(spark, sf_dir):
    j = table(spark, sf_dir, "jurisdictions").select(F.col("juris_display").alias("jurisdiction"), "period_start", "period_end")
    return table(spark, sf_dir, "permit_records").select("source_index", "jurisdiction", "permit_date").join(j, "jurisdiction")


@audit("places", "matched and retained links agree", "NOT agree", "audit_id", "SELECT audit_id, len(list_filter(coalesce(retained_source_indices, []), lambda x: NOT list_contains(coalesce(matched_source_indices, []), x))) = 0 AS agree FROM dedup_audit", "warning")
def links_agree(spark, sf_dir):
    m, r = (f"coalesce({c}, cast(array() as array<bigint>))" for c in ("matched_source_indices", "retained_source_indices"))
    return table(spark, sf_dir, "dedup_audit").selectExpr("audit_id", f"size(array_except({r}, {m})) = 0 as agree")


@audit("places", "every place has one current period", "n <> 1", "juris_key", "SELECT juris_key, count(*) FILTER (period_start <= DATE '2024-06-30' AND period_end > DATE '2024-06-30') AS n FROM jurisdictions GROUP BY 1")
def current_periods(spark, sf_dir):
    now = (F.col("period_start") <= F.lit("2024-06-30").cast("date")) & (F.col("period_end") > F.lit("2024-06-30").cast("date"))
    return table(spark, sf_dir, "jurisdictions").groupBy("juris_key").agg(F.count_if(now).alias("n"))


@audit("places", "counties have as many places as report", "listed IS DISTINCT FROM reporting", "county", """
WITH a AS (SELECT county, count(*) AS listed FROM jurisdictions GROUP BY 1), b AS (SELECT county, count(DISTINCT juris_key) AS reporting FROM permit_records p JOIN jurisdictions j ON p.jurisdiction = j.juris_display GROUP BY 1) SELECT county, listed, reporting FROM a FULL JOIN b USING (county)""", "warning")
def county_counts(spark, sf_dir):
    j = table(spark, sf_dir, "jurisdictions")
    p = table(spark, sf_dir, "permit_records").select(F.col("jurisdiction").alias("juris_display")).distinct()
    return j.groupBy("county").agg(F.count("*").alias("listed")).join(j.join(p, "juris_display").groupBy("county").agg(F.count_distinct("juris_key").alias("reporting")), "county", "full")


_FIELDS = ("vli", "li", "mi", "ami", "permit_total", "undated_permits", "rhna_start", "rhna_end", "last_updated", "jurisdiction", "project", "tracking", "data_status", "review_note")
_UNPIVOTED = " UNION ALL ".join(f"SELECT record_id, '{f}' AS field_name, e.fields['{f}'] AS before, d.fields['{f}'] AS after FROM {_EXPECTED} e JOIN {_DESIRED} d USING (record_id)" for f in _FIELDS)


def _unpivoted(spark, sf_dir) -> DataFrame:
    e, d = _copies(spark, sf_dir)
    both = e.select("record_id", F.col("fields").alias("e")).join(d.select("record_id", F.col("fields").alias("d")), "record_id")
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), F.try_element_at("e", F.lit(f)).alias("before"), F.try_element_at("d", F.lit(f)).alias("after")) for f in _FIELDS])
    return both.select("record_id", F.explode(each).alias("x")).select("record_id", "x.*")


@audit("sync", "current values pass through", "before IS DISTINCT FROM after", "field_name", _UNPIVOTED)
def values_pass_through(spark, sf_dir):
    return _unpivoted(spark, sf_dir)


@audit("sync", "records are there once", "n <> 1", "record_id", "SELECT record_id, count(*) AS n FROM sync_desired GROUP BY 1", "warning")
def records_once(spark, sf_dir):
    return table(spark, sf_dir, "sync_desired").groupBy("record_id").agg(F.count("*").alias("n"))


@audit("sync", "restricted columns have their unrestricted twins", "twin IS NULL", "column_name", "SELECT a.column_name, b.column_name AS twin FROM a2_columns a LEFT JOIN a2_columns b ON b.column_name = regexp_replace(a.column_name, '_DR$', '_NDR') WHERE regexp_matches(a.column_name, 'INCOME_DR$')")
def column_twins(spark, sf_dir):
    c = table(spark, sf_dir, "a2_columns").select("column_name")
    twins = c.select(F.col("column_name").alias("twin"))
    return c.where(F.col("column_name").rlike("INCOME_DR$")).join(twins, F.regexp_replace("column_name", "_DR$", "_NDR") == F.col("twin"), "left")


@audit("sync", "helpers are empty unless there is a group", "n = 1 AND retained IS NOT NULL", "dup_group", "SELECT dup_group, count(*) AS n, max(retained_report_year) AS retained FROM ledger_rows GROUP BY 1", "warning")
def gated_helpers(spark, sf_dir):
    return table(spark, sf_dir, "ledger_rows").groupBy("dup_group").agg(F.count("*").alias("n"), F.max("retained_report_year").alias("retained"))


@audit("sync", "display names pass through", "jurisdiction_display IS DISTINCT FROM juris_display", "juris_key", "SELECT j.juris_key, p.jurisdiction_display, j.juris_display FROM permit_records p JOIN jurisdictions j ON p.jurisdiction = j.juris_key", "warning")
def display_passes_through(spark, sf_dir):
    j = table(spark, sf_dir, "jurisdictions").select("juris_key", "juris_display")
    return table(spark, sf_dir, "permit_records").select(F.col("jurisdiction").alias("juris_key"), "jurisdiction_display").join(j, "juris_key")


@audit("sync", "the state of a period fits its flag", "(state <> 'to come') <> cycle_started", "juris_key || ' ' || state || ' ' || since", """
SELECT juris_key, cycle_started, CASE WHEN period_start > DATE '2024-06-30' THEN 'to come' WHEN period_end < DATE '2024-06-30' THEN 'ended' ELSE 'current' END AS state, strftime(CASE WHEN period_end < DATE '2024-06-30' THEN period_end ELSE period_start END, '%m/%d/%Y') AS since FROM jurisdictions""")
def period_states(spark, sf_dir):
    day = F.lit("2024-06-30").cast("date")
    state = F.when(F.col("period_start") > day, "to come").when(F.col("period_end") < day, "ended").otherwise("current")
    since = F.date_format(F.when(F.col("period_end") < day, F.col("period_end")).otherwise(F.col("period_start")), "MM/dd/yyyy")
    return table(spark, sf_dir, "jurisdictions").select("juris_key", "cycle_started", state.alias("state"), since.alias("since"))


_NUMBERS = f"SELECT record_id, field_name, try_cast(replace(trim(before), ',', '') AS DOUBLE) AS before, try_cast(replace(trim(after), ',', '') AS DOUBLE) AS after FROM ({_UNPIVOTED}) WHERE field_name IN {COUNTS}"


def _numbers(spark, sf_dir) -> DataFrame:
    def number(c: str):
        return F.regexp_replace(F.trim(c), ",", "").try_cast("double").alias(c)

    return _unpivoted(spark, sf_dir).where(F.col("field_name").isin(*COUNTS)).select("record_id", "field_name", number("before"), number("after"))


@audit("sync", "managed cells equal their source, blanks being zero", "coalesce(before, 0) <> coalesce(after, 0)", "field_name", _NUMBERS)
def managed_cells(spark, sf_dir):
    return _numbers(spark, sf_dir)


@audit("sync", "no cell is blank where its source is zero", "(before IS NULL) <> (after IS NULL) AND coalesce(before, after) = 0", "field_name", _NUMBERS, "warning")
def blanks_for_zeros(spark, sf_dir):
    return _numbers(spark, sf_dir)


@audit("sync", "totals of both copies are equal", "before <> after", "field_name", f"SELECT field_name, sum(coalesce(before, 0)) AS before, sum(coalesce(after, 0)) AS after FROM ({_NUMBERS}) GROUP BY 1")
def live_totals(spark, sf_dir):
    return _numbers(spark, sf_dir).groupBy("field_name").agg(F.sum(F.coalesce("before", F.lit(0))).alias("before"), F.sum(F.coalesce("after", F.lit(0))).alias("after"))


@audit("sync", "a plan leaves nothing to plan", "n > 0", "record_id", f"SELECT record_id, 0 AS n FROM {_EXPECTED} JOIN {_DESIRED} d USING (record_id)")
def plan_is_idempotent(spark, sf_dir):
    e, d = _copies(spark, sf_dir)
    applied = sync.applied(e, sync.map_changes(e, d, "record_id"), "record_id")
    again = sync.map_changes(applied, d, "record_id").groupBy("record_id").agg(F.count("*").alias("n"))
    return applied.join(d.select("record_id"), "record_id").join(again, "record_id", "left").select("record_id", F.coalesce("n", F.lit(0)).alias("n"))


_CLASSES = "CASE WHEN reported_total IS NULL THEN 'unknown' WHEN very_low * 2 >= reported_total THEN 'mostly' WHEN very_low > 0 THEN 'some' ELSE 'none' END"


@audit("formulas", "classes have their colours and totals", "colour IS NULL OR class IN ('mostly', 'some') AND reported_total < very_low", "class || ' ' || coalesce(colour, '')", f"""
SELECT class, colour, reported_total, very_low FROM (SELECT {_CLASSES} AS class, reported_total, very_low FROM permit_records) LEFT JOIN (VALUES ('mostly', 'green'), ('some', 'yellow'), ('none', 'grey')) c(name, colour) ON class = name""", "warning")
def classes_and_colours(spark, sf_dir):
    colours = spark.createDataFrame([("mostly", "green"), ("some", "yellow"), ("none", "grey")], "class string, colour string")
    return table(spark, sf_dir, "permit_records").selectExpr(f"{_CLASSES} as class", "reported_total", "very_low").join(colours, "class", "left")


@audit("emails", "no token is repeated", "n > n_distinct", "audit_id", "SELECT audit_id, len(matched_source_indices) AS n, len(list_distinct(matched_source_indices)) AS n_distinct FROM dedup_audit WHERE matched_source_indices IS NOT NULL", "warning")
def repeated_tokens(spark, sf_dir):
    return table(spark, sf_dir, "dedup_audit").where("matched_source_indices is not null").selectExpr("audit_id", "size(matched_source_indices) as n", "size(array_distinct(matched_source_indices)) as n_distinct")


@audit("artifacts", "documents keep their schema", "doc_id IS NULL OR n_chars < 0 OR (report_year IS NOT NULL AND report_year NOT BETWEEN 2000 AND 2030) OR (lang IS NOT NULL AND length(lang) <> 2) OR received_at < published_at", "doc_id", "SELECT * FROM documents", "warning")
def document_schema(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars", "report_year", "lang", "received_at", "published_at")


@audit("artifacts", "keys are unique and totals additive", "n > 1 OR off > 0", "source_index", f"SELECT source_index, count(*) AS n, count(*) FILTER (reported_total <> {UNITS}) AS off FROM permit_records GROUP BY 1", "warning")
def keys_and_totals(spark, sf_dir):
    return table(spark, sf_dir, "permit_records").groupBy("source_index").agg(F.count("*").alias("n"), F.count_if(F.expr(f"reported_total <> {UNITS}")).alias("off"))


@audit("artifacts", "invariants are true", "NOT holds", "name", f"""
SELECT 'batches add up' AS name, (SELECT count(*) FROM permit_records WHERE batch_no = 1) + (SELECT count(*) FROM permit_records WHERE batch_no > 1) = (SELECT count(*) FROM permit_records) AS holds
UNION ALL SELECT 'bands add up', (SELECT sum({UNITS}) FROM permit_records) = (SELECT {" + ".join(f"sum({b})" for b in BANDS)} FROM permit_records) UNION ALL SELECT 'totals add up', (SELECT sum(reported_total) FROM permit_records) = (SELECT sum({UNITS}) FROM permit_records)""")
def invariants(spark, sf_dir):
    p = table(spark, sf_dir, "permit_records")
    sums = p.agg(F.count("*").alias("n"), F.count_if(F.col("batch_no") == 1).alias("a"), F.count_if(F.col("batch_no") > 1).alias("b"), F.sum(F.expr(UNITS)).alias("units"), F.sum("reported_total").alias("total"), *[F.sum(b).alias(b) for b in BANDS])
    return sums.selectExpr(f"stack(3, 'batches add up', a + b = n, 'bands add up', units = {UNITS}, 'totals add up', total = units) as (name, holds)")


@audit("artifacts", "copies were last updated on the same days", "n <> 1", "name", """
WITH e AS (SELECT 'expected' AS name, synced_at FROM sync_expected UNION ALL SELECT 'desired', synced_at FROM sync_desired) SELECT name, count(DISTINCT CAST(synced_at AS DATE)) AS n FROM e GROUP BY 1""", "warning")
def update_days(spark, sf_dir):
    e, d = (table(spark, sf_dir, f"sync_{n}").select(F.lit(n).alias("name"), F.to_date("synced_at").alias("day")) for n in ("expected", "desired"))
    return e.unionAll(d).groupBy("name").agg(F.count_distinct("day").alias("n"))


_EDGES = """SELECT a.audit_id, r.ref, p.source_index AS target, p.report_year AS target_year, a.retained_report_year, s.source_index AS removed FROM dedup_audit a JOIN (SELECT audit_id, unnest(list_distinct(retained_source_indices)) AS ref FROM dedup_audit) r USING (audit_id)
LEFT JOIN permit_records p ON p.source_index = r.ref LEFT JOIN (SELECT DISTINCT source_index FROM dedup_audit) s ON s.source_index = r.ref WHERE r.ref IS NOT NULL"""


def _edges(spark, sf_dir) -> DataFrame:
    a = table(spark, sf_dir, "dedup_audit")
    refs = R.references(a, ["retained_source_indices"], ["audit_id", "retained_report_year"])
    targets = table(spark, sf_dir, "permit_records").select(F.col("source_index").alias("target"), F.col("report_year").alias("target_year"))
    removed = a.select(F.col("source_index").alias("removed")).distinct()
    return refs.join(targets, F.col("ref") == F.col("target"), "left").join(removed, F.col("ref") == F.col("removed"), "left")


@audit("artifacts", "ledger edges lead to rows", "target IS NULL", "audit_id", _EDGES)
def missing_edges(spark, sf_dir):
    return _edges(spark, sf_dir)


@audit("artifacts", "ledger edges lead to kept rows", "removed IS NOT NULL", "audit_id", _EDGES)
def stale_edges(spark, sf_dir):
    return _edges(spark, sf_dir)


@audit("artifacts", "ledger edges lead to the retained year", "target_year <> retained_report_year", "audit_id", _EDGES)
def year_mismatched_edges(spark, sf_dir):
    return _edges(spark, sf_dir)


_KNOWN = ", ".join(f"('{r}')" for r in RULES)


@audit("artifacts", "every rule has its summary", "rows IS NULL OR known IS NULL", "coalesce(known, rule_name)", f"SELECT k.known, a.rule_name, a.rows FROM (SELECT rule_name, count(*) AS rows FROM dedup_audit GROUP BY 1) a FULL JOIN (VALUES {_KNOWN}) k(known) ON k.known = a.rule_name", "warning")
def rule_summaries(spark, sf_dir):
    known = spark.createDataFrame([(r,) for r in RULES], "known string")
    return table(spark, sf_dir, "dedup_audit").groupBy("rule_name").agg(F.count("*").alias("rows")).join(known, F.col("rule_name") == F.col("known"), "full")


_PARCELS = "[0-9]{3,4}-[0-9]{3}-[0-9]{3}"


@audit("surface", "identifiers in texts resolve", "raw_apn IS NULL", "id", f"SELECT i.id, p.raw_apn FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '{_PARCELS}')) AS id FROM documents) i LEFT JOIN (SELECT DISTINCT raw_apn FROM permit_records) p ON p.raw_apn = i.id", "warning")
def text_identifiers(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(_PARCELS), 0)).alias("id")).distinct()
    known = table(spark, sf_dir, "permit_records").select("raw_apn").distinct()
    return ids.join(known, F.col("id") == F.col("raw_apn"), "left")


def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks, counted by status and severity."""
    return audits.summary(audits.report([QUERIES[n](spark, sf_dir) for n in _CHECKS]))


QUERIES["audit_summary"] = audit_summary
SQL["audit_summary"] = "SELECT status, severity, count(*) AS checks, CAST(sum(failures) AS BIGINT) AS failures FROM (" + " UNION ALL ".join(f"SELECT * FROM ({SQL[n]})" for n in _CHECKS) + ") GROUP BY ALL"
