"""Queries of the general data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.operators import activities, copy_diff, strict_load
from snaploom.sources import records
from snaploom.storage import new_path, table

# fixed values: the positions of BP_ISSUE_DT1 and NO_BUILDING_PERMITS in the 69 columns of a Table A2 file
A2 = strict_load.RecordShape(fields=69, date_at=35, count_at=36)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strict_load.rejected(table(spark, sf_dir, "apr_lines"), A2)


def p1_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strict_load.load(table(spark, sf_dir, "apr_lines"), A2)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_diff.differences(table(spark, sf_dir, "sync_expected"), table(spark, sf_dir, "sync_desired"))


def activity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = activities.activities(p1_loaded(spark, sf_dir), "source_index", "raw_values")
    off = F.col("total") != F.col("band_units")
    return each.groupBy("activity").agg(F.count("*").alias("n_rows"), F.count("day").alias("n_dated"), F.sum("total").alias("units"), F.sum("band_units").alias("band_units"), F.count_if(off).alias("n_mismatched"))


def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conforming records written to text files and read back, line breaks inside quotes and all, as often as each comes."""
    folder = new_path(spark, "records")
    good = strict_load.conforming(table(spark, sf_dir, "apr_lines"), A2)
    good.select(F.substring("line", 2, 2**31 - 1).alias("value")).write.text(folder)
    return records.records(spark, folder).groupBy(F.md5("raw_line").alias("digest")).agg(F.count("*").alias("n"))


QUERIES = {"csv_records": csv_records, "activity_totals": activity_totals, "p1_found": p1_found, "p1_loaded": p1_loaded, "p5_found": p5_found}

_FIELD = r',(?:"[^"]*(?:""[^"]*)*"|[^",][^,]*|)'
_DAY = r"regexp_full_match({0}, '[0-9]{{1,2}}/[0-9]{{1,2}}/([0-9]{{4}}|[0-9]{{2}})') AND coalesce(try_strptime({0}, '%m/%d/%y'), try_strptime({0}, '%m/%d/%Y')) IS NOT NULL OR regexp_full_match({0}, '[0-9]{{4}}(-[0-9]{{1,2}}-|/[0-9]{{1,2}}/)[0-9]{{1,2}}') AND coalesce(try_strptime({0}, '%Y-%m-%d'), try_strptime({0}, '%Y/%m/%d')) IS NOT NULL"
_SPACE = r"[\s\x{00a0}\x{2000}-\x{200a}\x{3000}]+"
_NEWEST = "SELECT record_id, unnest(map_entries({0}), recursive := true) FROM (SELECT * FROM sync_{1} QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY synced_at DESC) = 1)"
_VALUE = f"""CASE WHEN trim(v) = '' THEN NULL WHEN key IN {copy_diff.COUNTS} THEN coalesce(CAST(try_cast(replace(v, ',', '') AS DOUBLE) AS VARCHAR), v)
  WHEN key IN {copy_diff.DAYS} THEN coalesce(CAST(CAST(coalesce(try_strptime(v, '%m/%d/%y'), try_strptime(v, '%m/%d/%Y'), try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%Y/%m/%d')) AS DATE) AS VARCHAR), v) ELSE v END"""

SQL: dict[str, str] = {
    "p1_found": f"""
WITH l AS (SELECT source_index, ',' || raw_line AS line FROM apr_lines),
s AS (SELECT *, regexp_full_match(line, '(?:{_FIELD})+') AS quoted, regexp_full_match(line, '(?:{_FIELD}){{69}}') AS wide FROM l),
f AS (SELECT *, CASE WHEN wide THEN regexp_extract(line, '^(?:{_FIELD}){{34}}({_FIELD})', 1) END AS d, CASE WHEN wide THEN regexp_extract(line, '^(?:{_FIELD}){{35}}({_FIELD})', 1) END AS n FROM s),
v AS (SELECT *, trim(trim(d[2:], '"')) AS day, replace(trim(trim(n[2:], '"')), ',', '') AS total FROM f),
r AS (SELECT source_index, CASE WHEN NOT quoted THEN ['quoting'] WHEN NOT wide THEN ['column_count'] ELSE list_filter([CASE WHEN day <> '' AND NOT ({_DAY.format("day")}) THEN 'permit_date' END,
  CASE WHEN total <> '' AND NOT coalesce(regexp_full_match(total, '[0-9.]+([eE][+-]?[0-9]+)?') AND try_cast(total AS DOUBLE) = floor(try_cast(total AS DOUBLE)), false) THEN 'reported_total' END], lambda x: x IS NOT NULL) END AS reasons FROM v)
SELECT source_index, unnest(reasons) AS reason FROM r""",
    "p1_loaded": f"""
WITH f AS (SELECT source_index, ',' || raw_line AS line, regexp_extract_all(',' || raw_line, '{_FIELD}') AS x FROM apr_lines), g AS (SELECT source_index, list_transform(x, lambda y: CASE WHEN starts_with(y, ',"') THEN replace(y[3:-2], '""', '"') ELSE y[2:] END) AS raw_values FROM f WHERE len(x) = 69 AND array_to_string(x, '') = line),
v AS (SELECT *, trim(raw_values[35]) AS d, replace(trim(raw_values[36]), ',', '') AS n FROM g)
SELECT source_index, raw_values, CAST(coalesce(try_strptime(d, '%m/%d/%y'), try_strptime(d, '%m/%d/%Y'), try_strptime(d, '%Y-%m-%d'), try_strptime(d, '%Y/%m/%d')) AS DATE) AS permit_date, CAST(try_cast(n AS DOUBLE) AS BIGINT) AS reported_total FROM v
WHERE (d = '' OR {_DAY.format("d")}) AND (n = '' OR coalesce(regexp_full_match(n, '[0-9.]+([eE][+-]?[0-9]+)?') AND try_cast(n AS DOUBLE) = floor(try_cast(n AS DOUBLE)), false))""",
    "csv_records": f"""
WITH f AS (SELECT raw_line, ',' || raw_line AS line, regexp_extract_all(',' || raw_line, '{_FIELD}') AS x FROM apr_lines), v AS (SELECT raw_line, trim(trim(x[35][2:], '"')) AS d, replace(trim(trim(x[36][2:], '"')), ',', '') AS n FROM f WHERE len(x) = 69 AND array_to_string(x, '') = line)
SELECT md5(raw_line) AS digest, count(*) AS n FROM v WHERE (d = '' OR {_DAY.format("d")}) AND (n = '' OR coalesce(regexp_full_match(n, '[0-9.]+([eE][+-]?[0-9]+)?') AND try_cast(n AS DOUBLE) = floor(try_cast(n AS DOUBLE)), false)) GROUP BY 1""",
    "activity_totals": f"""
WITH f AS (SELECT source_index, ',' || raw_line AS line, regexp_extract_all(',' || raw_line, '{_FIELD}') AS v FROM apr_lines), g AS (SELECT source_index, list_transform(v, lambda x: trim(trim(x[2:], '"'))) AS v FROM f WHERE len(v) = 69 AND array_to_string(v, '') = line),
h AS (SELECT * FROM g WHERE (v[35] = '' OR {_DAY.format("v[35]")}) AND (v[36] = '' OR coalesce(regexp_full_match(replace(v[36], ',', ''), '[0-9.]+([eE][+-]?[0-9]+)?') AND try_cast(replace(v[36], ',', '') AS DOUBLE) = floor(try_cast(replace(v[36], ',', '') AS DOUBLE)), false))),
a AS ({" UNION ALL ".join(f"SELECT '{a.name}' AS activity, v[{a.day}] <> '' AND ({_DAY.format(f"v[{a.day}]")}) AS dated, CASE WHEN v[{a.total}] = '' THEN 0 ELSE CAST(try_cast(replace(v[{a.total}], ',', '') AS DOUBLE) AS BIGINT) END AS total, {' + '.join(f"CASE WHEN v[{i}] = '' THEN 0 ELSE CAST(try_cast(replace(v[{i}], ',', '') AS DOUBLE) AS BIGINT) END" for i in a.bands)} AS band_units FROM h" for a in activities.A2_ACTIVITIES)})
SELECT activity, count(*) AS n_rows, count(*) FILTER (dated) AS n_dated, CAST(sum(total) AS BIGINT) AS units, CAST(sum(band_units) AS BIGINT) AS band_units, count(*) FILTER (total <> band_units) AS n_mismatched FROM a GROUP BY 1""",
    "p5_found": f"""
WITH e AS (SELECT record_id, key, {_VALUE} AS v FROM (SELECT record_id, key, regexp_replace(regexp_replace(value, '{_SPACE}', ' ', 'g'), '^ | $', '', 'g') AS v FROM ({_NEWEST.format("expected_fields", "expected")}))),
d AS (SELECT record_id, key, {_VALUE} AS v FROM (SELECT record_id, key, regexp_replace(regexp_replace(value, '{_SPACE}', ' ', 'g'), '^ | $', '', 'g') AS v FROM ({_NEWEST.format("desired_fields", "desired")})))
SELECT record_id, '' AS field_name, 'only_expected' AS found_as FROM sync_expected WHERE record_id NOT IN (SELECT record_id FROM sync_desired) GROUP BY 1
UNION ALL SELECT record_id, '', 'only_desired' FROM sync_desired WHERE record_id NOT IN (SELECT record_id FROM sync_expected) GROUP BY 1
UNION ALL SELECT record_id, key, 'differs' FROM e FULL JOIN d USING (record_id, key) WHERE record_id IN (SELECT record_id FROM sync_expected) AND record_id IN (SELECT record_id FROM sync_desired) AND e.v IS DISTINCT FROM d.v""",
}
