"""Queries of reviews: pace before and after, coverage, residuals, and renderings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.functions.pace import pace
from snaploom.plans import series as S
from snaploom.queries.problems import p1_loaded
from snaploom.queries.registry import query
from snaploom.queries.series import _LOADED, _SERIES, series_table
from snaploom.sources import compliance
from snaploom.storage import table

_THROUGH = "2021-06-30"
_UNITS = "coalesce(p.reported_total, 0)"
# an allocation isn't known for every place: not known isn't zero
_ALLOCATION = "CASE length(juris_key) % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 3 * length(juris_key) END"


def _status(c: str) -> str:
    return f"CASE WHEN allocation IS NULL THEN 'unknown_allocation' WHEN allocation = 0 THEN 'no_allocation' WHEN elapsed = 0 THEN 'not_started' WHEN {c} >= due THEN 'on_pace' ELSE 'behind_pace' END"


_PACES = f"""t AS (SELECT j.juris_key, {_ALLOCATION} AS allocation, period_start AS s, period_end AS e, CAST(coalesce(sum({_UNITS}) FILTER (batch_no = 1), 0) AS BIGINT) AS before, CAST(coalesce(sum({_UNITS}), 0) AS BIGINT) AS after FROM jurisdictions j LEFT JOIN permit_records p ON p.jurisdiction = j.juris_display GROUP BY ALL),
d AS (SELECT *, least(greatest(date_diff('day', s, DATE '{_THROUGH}'), 0), date_diff('day', s, e)) AS elapsed FROM t), m AS (SELECT *, (allocation * elapsed + date_diff('day', s, e) - 1) // date_diff('day', s, e) AS due FROM d),
review AS (SELECT juris_key, allocation, before, after, {_status("before")} AS status_before, {_status("after")} AS status_after FROM m)"""


def _review(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = F.coalesce("reported_total", F.lit(0))
    sums = table(spark, sf_dir, "permit_records").groupBy(F.col("jurisdiction").alias("juris_display")).agg(F.sum(F.when(F.col("batch_no") == 1, units)).alias("before"), F.sum(units).alias("after"))
    t = table(spark, sf_dir, "jurisdictions").join(sums, "juris_display", "left").na.fill(0, ["before", "after"]).withColumn("allocation", F.expr(_ALLOCATION))

    def status(c: str) -> Column:
        found = pace(F.col(c), F.coalesce("allocation", F.lit(0)), F.col("period_start"), F.col("period_end"), F.lit(_THROUGH).cast("date"))
        return F.when(F.col("allocation").isNull(), "unknown_allocation").otherwise(found["status"]).alias(f"status_{c}")

    return t.select("juris_key", "allocation", "before", "after", status("before"), status("after"))


@query(f"WITH {_PACES} SELECT juris_key, CAST(allocation AS INT) AS allocation, before, after, status_before, status_after FROM review")
def pace_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each place's pace by the accepted history and by all batches; places whose allocation isn't known have no pace."""
    return _review(spark, sf_dir)


@query(f"WITH {_PACES} SELECT status_before, status_after, count(*) AS n, CAST(sum(after - before) AS BIGINT) AS added FROM review GROUP BY ALL")
def pace_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _review(spark, sf_dir).groupBy("status_before", "status_after").agg(F.count("*").alias("n"), F.sum(F.col("after") - F.col("before")).alias("added"))


_GUARDED = """'IF({Allocation} = 0, "no allocation", IF({' || county || ' units} >= ROUNDUP({Allocation} * ' || date_days || ' / ' || all_days || ', 0), "on pace", "behind"))'"""
_DAYS = f"least(greatest(datediff(DATE'{_THROUGH}', period_start), 0), datediff(period_end, period_start))"
_DAYS_SQL = f"least(greatest(date_diff('day', period_start, DATE '{_THROUGH}'), 0), date_diff('day', period_start, period_end))"


@query(f"WITH t AS (SELECT *, {_DAYS_SQL} AS date_days, date_diff('day', period_start, period_end) AS all_days FROM jurisdictions), f AS (SELECT juris_key, {_GUARDED} AS formula FROM t) SELECT juris_key, formula, contains(formula, 'IF({{Allocation}} = 0') AS zero_safe FROM f".replace("{{", "{").replace("}}", "}"))
def pace_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pace of each place as a formula of another system, and whether it is guarded against zero."""
    t = table(spark, sf_dir, "jurisdictions").withColumn("date_days", F.expr(_DAYS)).withColumn("all_days", F.datediff("period_end", "period_start"))
    f = t.select("juris_key", F.expr(_GUARDED).alias("formula"))
    return f.withColumn("zero_safe", F.col("formula").contains("IF({Allocation} = 0"))


@query("""WITH d AS (SELECT juris_key, count(*) AS n_documents, count(DISTINCT source) AS n_sources FROM documents WHERE juris_key IS NOT NULL GROUP BY 1)
SELECT coalesce(j.juris_key, d.juris_key) AS juris_key, coalesce(n_documents, 0) AS n_documents, coalesce(n_sources, 0) AS n_sources, CASE WHEN j.juris_key IS NULL THEN 'unlisted' WHEN d.juris_key IS NULL THEN 'missing' ELSE 'covered' END AS coverage FROM jurisdictions j FULL JOIN d USING (juris_key)""")
def document_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("juris_key is not null").groupBy("juris_key").agg(F.count("*").alias("n_documents"), F.count_distinct("source").alias("n_sources"))
    j = table(spark, sf_dir, "jurisdictions").select("juris_key", F.lit(True).alias("listed"))
    both = j.join(d, "juris_key", "full")
    coverage = F.when(F.col("listed").isNull(), "unlisted").when(F.col("n_documents").isNull(), "missing").otherwise("covered")
    return both.select("juris_key", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("n_sources", F.lit(0)).alias("n_sources"), coverage.alias("coverage"))


@query("""WITH a AS (SELECT jurisdiction_display AS place, CAST(sum(reported_total) AS BIGINT) AS new FROM permit_records GROUP BY 1), b AS (SELECT jurisdiction_display AS place, CAST(sum(reported_total) AS BIGINT) AS old FROM ledger_rows GROUP BY 1), c AS (SELECT jurisdiction_display AS place, count(*) AS projected FROM address_records GROUP BY 1)
SELECT coalesce(a.place, b.place) AS place, new - old - coalesce(projected, 0) AS residual, CASE WHEN a.place IS NULL THEN 'not in the new data' WHEN b.place IS NULL THEN 'not in the old data' WHEN new IS NULL OR old IS NULL THEN 'no total' END AS error FROM (SELECT * FROM a WHERE place IS NOT NULL) a FULL JOIN (SELECT * FROM b WHERE place IS NOT NULL) b ON a.place = b.place LEFT JOIN c ON c.place = coalesce(a.place, b.place)""")
def review_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What new totals exceed the old ones and a projection by; what hinders that is told for each place."""
    p, l, a = (table(spark, sf_dir, t).where("jurisdiction_display is not null").groupBy(F.col("jurisdiction_display").alias("place")) for t in ("permit_records", "ledger_rows", "address_records"))
    new, old, projected = p.agg(F.sum("reported_total").alias("new"), F.lit(1).alias("in_new")), l.agg(F.sum("reported_total").alias("old"), F.lit(1).alias("in_old")), a.agg(F.count("*").alias("projected"))
    both = new.join(old, "place", "full").join(projected, "place", "left")
    error = F.when(F.col("in_new").isNull(), "not in the new data").when(F.col("in_old").isNull(), "not in the old data").when(F.col("new").isNull() | F.col("old").isNull(), "no total")
    return both.select("place", (F.col("new") - F.col("old") - F.coalesce("projected", F.lit(0))).alias("residual"), error.alias("error"))


@query("""SELECT audit_id, CASE WHEN len(retained_source_indices) = 1 THEN retained_source_indices[1] END AS single, CASE WHEN retained_source_indices IS NULL THEN 'absent' WHEN len(retained_source_indices) = 0 THEN 'empty' WHEN len(retained_source_indices) = 1 THEN 'single' ELSE 'several' END AS found FROM dedup_audit""")
def lookup_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, n = F.col("retained_source_indices"), F.size("retained_source_indices")
    found = F.when(links.isNull(), "absent").when(n == 0, "empty").when(n == 1, "single").otherwise("several")
    return table(spark, sf_dir, "dedup_audit").select("audit_id", F.when(n == 1, links[0]).alias("single"), found.alias("found"))


@query(f"WITH {_LOADED} SELECT source_index, stage, vli, li, mi, ami, reported, CASE WHEN reported = vli + li + mi + ami THEN 'agrees' WHEN reported = 0 THEN 'missing' ELSE 'differs' END AS total_status FROM stages")
def stage_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four bands of every record and stage, and whether they make up the reported total."""
    rows = S.stage_rows(p1_loaded(spark, sf_dir))
    bands = F.col("vli") + F.col("li") + F.col("mi") + F.col("ami")
    status = F.when(F.col("reported") == bands, "agrees").when(F.col("reported") == 0, "missing").otherwise("differs")
    return rows.select("source_index", "stage", "vli", "li", "mi", "ami", "reported", status.alias("total_status"))


_LINE = "concat('[\"', juris_key, '\", ', year, ', ', quarter, ', \"', data_flags, '\", ', permits_total, ', ', entitlements_total, ', ', completions_total, ']')"


@query(f"WITH {_SERIES} SELECT key, {_LINE} AS line FROM series")
def series_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of text for each row of the series."""
    return series_table(spark, sf_dir).select("key", F.expr(_LINE.replace('\\"', '"')).alias("line"))


@query("""SELECT source_name, x.name AS setting, x.value FROM (SELECT source_name, unnest([struct_pack(name := 'max_repeats', value := CAST(max_repeats AS VARCHAR)), struct_pack(name := 'target_share', value := CAST(round(target_share, 6) AS VARCHAR))]) AS x FROM mix_targets)""")
def exploded_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested settings as rows, one for each name."""
    t = table(spark, sf_dir, "mix_targets")
    items = F.array(F.struct(F.lit("max_repeats").alias("name"), F.col("max_repeats").cast("string").alias("value")), F.struct(F.lit("target_share").alias("name"), F.round("target_share", 6).cast("string").alias("value")))
    return t.select("source_name", F.explode(items).alias("x")).select("source_name", F.col("x.name").alias("setting"), F.col("x.value").alias("value"))


_STATUSES = {"IN": "in compliance", "OUT": "out of compliance", "UNDER REVIEW": "pending"}
_CSV = """CASE length(juris_key) % 7 WHEN 0 THEN juris_display || ',6th cycle,In,2024-05-01 10:00' WHEN 1 THEN juris_display || ', 6th ,out,5/1/2024' WHEN 2 THEN '"' || juris_display || '",7,Under  Review,' WHEN 3 THEN ' , ,,' WHEN 4 THEN juris_display || ',8th,In,2024-05-01' WHEN 5 THEN juris_display || ',5th,Unknown,soon' ELSE juris_display || ',6th cycle,In' END"""


@query(f"""
WITH l AS (SELECT unnest([{_CSV}, 'Jurisdiction,Cycle,Status,Updated']) AS line, juris_display FROM jurisdictions), s AS (SELECT list_transform(string_split(replace(line, '"', ''), ','), lambda x: trim(x)) AS c FROM l WHERE regexp_replace(line, '[\\s,]', '', 'g') <> ''), f AS (SELECT * FROM s WHERE c <> ['Jurisdiction', 'Cycle', 'Status', 'Updated']),
r AS (SELECT regexp_replace(upper(strip_accents(trim(regexp_replace(c[1], '(?i)\\s*([-(]\\s*unincorporated\\s*\\)?)\\s*$', '')))), '\\s+', ' ', 'g') AS key, CASE WHEN regexp_full_match(c[2], '(?i)([5-7])(st|nd|rd|th)?( cycle)?') THEN CAST(c[2][1] AS INT) END AS cycle,
  CASE regexp_replace(upper(c[3]), '\\s+', ' ', 'g') WHEN 'IN' THEN 'in compliance' WHEN 'OUT' THEN 'out of compliance' WHEN 'UNDER REVIEW' THEN 'pending' END AS status, CAST(coalesce(try_strptime(split_part(c[4], ' ', 1), '%Y-%m-%d'), try_strptime(split_part(c[4], ' ', 1), '%m/%d/%Y')) AS DATE) AS updated, len(c) AS width, coalesce(c[4], '') AS written FROM f),
n AS (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM r)
SELECT key, cycle, status, updated, list_filter([CASE WHEN width <> 4 THEN 'columns' END, CASE WHEN key = '' THEN 'no name' END, CASE WHEN n > 1 THEN 'repeated name' END, CASE WHEN cycle IS NULL THEN 'cycle' END, CASE WHEN status IS NULL THEN 'status' END, CASE WHEN written <> '' AND updated IS NULL THEN 'updated' END], lambda x: x IS NOT NULL) AS problems FROM n""")
def compliance_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of the places in every way that it may be written, read and checked."""
    j = table(spark, sf_dir, "jurisdictions")
    lines = j.select(F.explode(F.array(F.expr(_CSV), F.lit(",".join(compliance.HEADER)))).alias("line"))
    return compliance.within(compliance.compliance_rows(lines, "line", _STATUSES), 100, 700)
