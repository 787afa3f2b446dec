"""Queries of planning periods and cycles; texts to read are made from the places' own values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.functions import identifiers as I
from snaploom.plans import periods as P
from snaploom.plans.series import provisional
from snaploom.queries.registry import query
from snaploom.queries.scalars import _SPACE, _strip
from snaploom.storage import table

# how a period is written depends on the length of the place's name; a few ways are wrong
_WRITTEN = """CASE length(juris_key) % 6 WHEN 0 THEN us_start || ' - ' || us_end WHEN 1 THEN us_start || '-' || us_end WHEN 2 THEN iso_start || '-' || iso_end WHEN 3 THEN us_end || '-' || us_start WHEN 4 THEN slash_start || '-' || slash_end ELSE us_start || '-' || us_end || '-' END"""
_FLAGGED = "CASE WHEN length(juris_key) % 5 = 0 THEN 'yes' WHEN cycle_started THEN ' true' ELSE 'FALSE' END"
_UNITS = "CASE length(juris_key) % 4 WHEN 0 THEN '1,200' WHEN 1 THEN '12.0' WHEN 2 THEN '1.5' ELSE '' END"
_READ = """CASE WHEN len(parts) = 2 THEN [CAST(coalesce(try_strptime(trim(parts[1]), '%m/%d/%Y'), try_strptime(trim(parts[1]), '%Y/%m/%d')) AS DATE), CAST(coalesce(try_strptime(trim(parts[2]), '%m/%d/%Y'), try_strptime(trim(parts[2]), '%Y/%m/%d')) AS DATE)] END"""


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "jurisdictions")
    forms = {"us": "MM/dd/yyyy", "iso": "yyyy-MM-dd", "slash": "yyyy/M/d"}
    written = j.select("juris_key", "cycle_started", "unincorporated", *[F.date_format(f"period_{e}", f).alias(f"{n}_{e}") for n, f in forms.items() for e in ("start", "end")])
    return written.select("juris_key", "unincorporated", F.expr(_WRITTEN).alias("period"), F.expr(_FLAGGED).alias("started"), F.expr(_UNITS).alias("units"))


_TEXTS = f"""t AS (SELECT juris_key, cycle_started, unincorporated, strftime(period_start, '%m/%d/%Y') AS us_start, strftime(period_end, '%m/%d/%Y') AS us_end, strftime(period_start, '%Y-%m-%d') AS iso_start, strftime(period_end, '%Y-%m-%d') AS iso_end, strftime(period_start, '%Y/%-m/%-d') AS slash_start, strftime(period_end, '%Y/%-m/%-d') AS slash_end FROM jurisdictions),
w AS (SELECT juris_key, unincorporated, {_WRITTEN} AS period, {_FLAGGED} AS started, {_UNITS} AS units FROM t), s AS (SELECT *, string_split(trim(period), '-') AS parts FROM w), r AS (SELECT *, {_READ} AS days FROM s),
v AS (SELECT *, CASE WHEN days[1] <= days[2] THEN days END AS ok, CASE upper(trim(started)) WHEN 'TRUE' THEN true WHEN 'FALSE' THEN false END AS flag FROM r)"""


@query(f"""WITH {_TEXTS}, c AS (SELECT *, CASE WHEN unincorporated THEN [DATE '2023-01-15', DATE '2031-01-15'] END AS now, CASE WHEN unincorporated THEN [DATE '2019-06-30', DATE '2027-06-30'] END AS was FROM v)
SELECT juris_key AS key, coalesce(now, ok)[1] AS start, coalesce(now, ok)[2] AS "end", flag AS started, CASE WHEN trim(units) <> '' THEN CAST(trunc(CAST(replace(units, ',', '') AS DOUBLE)) AS BIGINT) END AS units,
  list_filter([CASE WHEN ok IS NULL THEN 'no period' END, CASE WHEN now IS NOT NULL AND ok IS NOT NULL AND ok <> was AND ok <> now THEN 'neither the old nor the new period' END, CASE WHEN flag IS NULL THEN 'no flag' END, CASE WHEN units = '1.5' THEN 'not a count: units' END], lambda x: x IS NOT NULL) AS problems FROM c""")
def planning_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counties' periods are corrected: they may come with the old one or the new one."""
    rows = _texts(spark, sf_dir)
    corrections = rows.where("unincorporated").select(F.col("juris_key").alias("key"), F.lit("06/30/2019-06/30/2027").alias("old"), F.lit("01/15/2023-01/15/2031").alias("new"))
    return P.periods(rows, "juris_key", "period", "started", ["units"], corrections)


@query(f"WITH {_TEXTS} SELECT juris_key, ok[1] AS start, ok[2] AS \"end\" FROM v")
def planning_period_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("juris_key", P.planning_period(F.col("period")).alias("p")).select("juris_key", "p.start", "p.end")


_OVERRIDES = "SELECT juris_key AS key, 7 AS cycle, DATE '2023-01-15' AS start, DATE '2031-01-15' AS \"end\" FROM jurisdictions WHERE unincorporated UNION ALL SELECT 'NOWHERE', 7, DATE '2023-01-15', DATE '2031-01-15' UNION ALL SELECT min(juris_key), 5, DATE '2013-01-15', DATE '2021-01-15' FROM jurisdictions WHERE unincorporated"
_POLICY = f"""o AS ({_OVERRIDES}), n AS (SELECT key, count(*) AS n, arg_min(o, cycle) AS new FROM o GROUP BY 1),
policy AS (SELECT coalesce(n.key, juris_key) AS key, coalesce(new.cycle, 6) AS cycle, coalesce(new.start, period_start) AS start, coalesce(new."end", period_end) AS "end", CASE WHEN juris_key IS NULL THEN 'override of an unknown key' WHEN n > 1 THEN 'several overrides of one key' END AS problem FROM jurisdictions FULL JOIN n ON n.key = juris_key)"""


def _policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "jurisdictions")

    def override(keys: DataFrame, cycle: int, start: str, end: str) -> DataFrame:
        return keys.select("key", F.lit(cycle).alias("cycle"), F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))

    counties = j.where("unincorporated").select(F.col("juris_key").alias("key"))
    unknown = spark.createDataFrame([("NOWHERE",)], "key string")
    first = counties.agg(F.min("key").alias("key"))
    overrides = override(counties.unionAll(unknown), 7, "2023-01-15", "2031-01-15").unionAll(override(first, 5, "2013-01-15", "2021-01-15"))
    return P.with_policy(j.select(F.col("juris_key").alias("key"), F.col("period_start").alias("start"), F.col("period_end").alias("end")), overrides)


@query(f"WITH {_POLICY} SELECT * FROM policy")
def cycle_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _policy(spark, sf_dir)


@query(f"WITH {_POLICY}, e AS (SELECT 6 AS cycle, count(*) FILTER (NOT unincorporated) AS expected FROM jurisdictions UNION ALL SELECT 7, count(*) FILTER (unincorporated) FROM jurisdictions), a AS (SELECT cycle, count(*) AS actual FROM policy WHERE problem IS NULL GROUP BY 1) SELECT cycle, coalesce(expected, 0) AS expected, coalesce(actual, 0) AS actual, expected = actual AS agrees FROM e FULL JOIN a USING (cycle)")
def policy_cycle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "jurisdictions")
    expected = j.agg(F.count_if(~F.col("unincorporated")).alias("a"), F.count_if("unincorporated").alias("b")).selectExpr("stack(2, 6, a, 7, b) as (cycle, expected)")
    return P.cycle_counts(_policy(spark, sf_dir), expected)


@query("SELECT year, (SELECT CAST(max(received_at) AS DATE) FROM permit_records) <= make_date(year + 1, 6, 30) AS provisional FROM (SELECT DISTINCT report_year AS year FROM permit_records WHERE report_year IS NOT NULL)")
def provisional_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records")
    years = p.where("report_year is not null").select(F.col("report_year").alias("year"), F.lit(1).alias("one")).distinct()
    last = p.agg(F.to_date(F.max("received_at")).alias("last_updated"), F.lit(1).alias("one"))
    return years.join(last, "one").select("year", provisional(F.col("last_updated"), F.col("year")).alias("provisional"))


_BARE = "regexp_replace(jurisdiction_display, '(?i)\\s*([-(]\\s*unincorporated\\s*\\)?)\\s*$', '')"
_NAME = f"regexp_replace({_strip(f'upper(strip_accents({_BARE}))')}, '{_SPACE}+', ' ', 'g')"


@query(f"SELECT jurisdiction_display AS display, {_NAME} AS key, regexp_matches(jurisdiction_display, '(?i)unincorporated') AS unincorporated FROM (SELECT DISTINCT jurisdiction_display FROM permit_records WHERE jurisdiction_display IS NOT NULL)")
def place_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key a displayed name has in other tables, and whether it is a county's own territory."""
    names = table(spark, sf_dir, "permit_records").where("jurisdiction_display is not null").select(F.col("jurisdiction_display").alias("display")).distinct()
    return names.select("display", I.bare_key(F.col("display")).alias("key"), F.col("display").rlike("(?i)unincorporated").alias("unincorporated"))
