"""Queries of the quarterly series, over the conforming records of the wide file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.operators.activities import A2_ACTIVITIES
from snaploom.plans import series as S
from snaploom.queries.problems import _DAY, _FIELD, p1_loaded
from snaploom.queries.registry import query
from snaploom.queries.scalars import _SPACE, _strip
from snaploom.storage import saved, table

FIRST, LAST = 2018, 2025


def _key(c: str) -> str:
    return f"regexp_replace({_strip(f'upper({c})')}, '{_SPACE}+', ' ', 'g')"


def _day(c: str) -> str:
    return f"CAST(CASE WHEN {_DAY.format(c)} THEN coalesce(try_strptime({c}, '%m/%d/%y'), try_strptime({c}, '%m/%d/%Y'), try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%Y/%m/%d')) END AS DATE)"


def _sum(at: tuple[int, ...]) -> str:
    return " + ".join(f"CASE WHEN v[{i}] = '' THEN 0 ELSE CAST(try_cast(replace(v[{i}], ',', '') AS DOUBLE) AS BIGINT) END" for i in at)


def _stage(a) -> str:
    pairs = [a.bands[i : i + 2] for i in range(0, len(a.bands), 2)]
    of = {"vli": sum(pairs[:3], ()), "li": pairs[3], "mi": pairs[4], "ami": pairs[5], "total": a.bands, "deed_restricted": tuple(p[0] for p in pairs[:-1])}
    reported = f"CASE WHEN v[{a.total}] = '' THEN 0 ELSE CAST(try_cast(replace(v[{a.total}], ',', '') AS DOUBLE) AS BIGINT) END"
    return f"SELECT source_index, place, report_year, unit_category, labels, bonus, '{a.name}' AS stage, {_day(f'v[{a.day}]')} AS day, {reported} AS reported, {', '.join(f'{_sum(at)} AS {n}' for n, at in of.items())} FROM h"


def _list(values) -> str:
    return ", ".join(f"'{x}'" for x in values)


_LOADED = f"""
f AS (SELECT source_index, ',' || raw_line AS line, regexp_extract_all(',' || raw_line, '{_FIELD}') AS x FROM apr_lines),
g AS (SELECT source_index, list_transform(x, lambda y: trim(CASE WHEN starts_with(y, ',"') THEN replace(y[3:-2], '""', '"') ELSE y[2:] END)) AS v FROM f WHERE len(x) = 69 AND array_to_string(x, '') = line),
h AS (SELECT source_index, v, {_key(f"v[{S.PLACE}]")} AS place, CASE WHEN v[{S.YEAR}] = '' THEN 0 ELSE CAST(try_cast(v[{S.YEAR}] AS DOUBLE) AS INT) END AS report_year, {_key(f"v[{S.UNIT_CATEGORY}]")} AS unit_category, CASE WHEN v[{S.BONUS}] = '' THEN 0 ELSE try_cast(replace(v[{S.BONUS}], ',', '') AS DOUBLE) END AS bonus,
  list_sort(list_distinct(list_filter(list_transform(string_split(replace(v[{S.PROGRAM}], ';', ','), ','), lambda l: {_key("l")}), lambda l: l NOT IN ({_list(S.NO_PROGRAMS)})))) AS labels
  FROM g WHERE (v[35] = '' OR {_DAY.format("v[35]")}) AND (v[36] = '' OR coalesce(regexp_full_match(replace(v[36], ',', ''), '[0-9.]+([eE][+-]?[0-9]+)?') AND try_cast(replace(v[36], ',', '') AS DOUBLE) = floor(try_cast(replace(v[36], ',', '') AS DOUBLE)), false))),
names AS (SELECT juris_key, {_key("juris_key")} AS name FROM jurisdictions UNION SELECT juris_key, {_key("juris_display")} FROM jurisdictions),
stages AS (SELECT * FROM ({" UNION ALL ".join(_stage(a) for a in A2_ACTIVITIES)}) s LEFT JOIN names ON place = name WHERE total > 0 OR reported > 0)"""
_CATEGORY = "CASE unit_category " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.UNIT_CATEGORIES.items()) + " END"
_PROGRAM = "CASE {0} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.PROGRAMS.items()) + " END"
_SUMS = {m: m for m in S.MEASURES[:6]} | {m: f"CASE WHEN {_CATEGORY} = '{m}' THEN total END" for m in S.UNIT_CATEGORIES.values()}
_SUMS |= {m: f"CASE WHEN list_contains(list_transform(labels, lambda l: {_PROGRAM.format('l')}), '{m}') THEN total END" for m in ("sb35", "sb9", "ab2011")} | {"density_bonus": "CASE WHEN bonus > 0 THEN total END"}
_CELLS = f"cells AS (SELECT stage, juris_key, year(day) AS year, quarter(day) AS quarter, {', '.join(f'CAST(coalesce(sum({_SUMS[m]}), 0) AS BIGINT) AS {chr(34)}{m}{chr(34)}' for m in S.MEASURES)} FROM stages WHERE day IS NOT NULL GROUP BY ALL)"
_HEAPS = f"""days AS (SELECT stage, juris_key, year(day) AS year, day, count(*) AS n FROM stages WHERE day IS NOT NULL GROUP BY ALL),
heaps AS (SELECT * FROM (SELECT stage, juris_key, year, CAST(sum(n) AS BIGINT) AS dated_rows, arg_min(day, (-n, day)) AS date, max(n) AS rows FROM days GROUP BY ALL) WHERE dated_rows >= {S.HEAPED_ROWS} AND rows >= {S.HEAPED_SHARE} * dated_rows)"""


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.located(S.stage_rows(p1_loaded(spark, sf_dir)), table(spark, sf_dir, "jurisdictions"))


@query(f'WITH {_LOADED}, {_CELLS} SELECT stage, juris_key, CAST(year AS INT) AS year, CAST(quarter AS INT) AS quarter, {", ".join(chr(34) + m + chr(34) for m in S.MEASURES)} FROM cells')
def quarterly_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measures of all stages; rows of places that aren't listed are in cells without a key."""
    return S.cells(_rows(spark, sf_dir))


_UPDATED = "(SELECT CAST(max(received_at) AS DATE) FROM permit_records)"
_WIDE = ", ".join(f"CAST(coalesce((max(\"{m}\") FILTER (stage = '{s}')), 0) AS BIGINT) AS \"{n}_{m}\"" for s, n in S.STAGES.items() for m in S.MEASURES)
_NAMES = [f"{n}_{m}" for n in S.STAGES.values() for m in S.MEASURES]
_RAISED = {"no_apr_rows": "table_a2_rows IS NULL", "provisional_year": f"{_UPDATED} <= make_date(year + 1, 6, 30)"} | {f"{s}_dates_heaped": f"list_contains(heaps, '{s}')" for s in S.STAGES}
_SERIES = f"""{_LOADED}, {_CELLS}, {_HEAPS},
filed AS (SELECT juris_key, report_year AS year, count(*) AS table_a2_rows FROM h JOIN names ON place = name GROUP BY ALL), heaped AS (SELECT juris_key, year, list(DISTINCT stage) AS heaps FROM heaps GROUP BY ALL),
wide AS (SELECT juris_key, year, quarter, {_WIDE} FROM cells GROUP BY ALL),
grid AS (SELECT juris_key, year, quarter FROM jurisdictions, (SELECT CAST(unnest(range({FIRST}, {LAST + 1})) AS INT) AS year), (SELECT CAST(unnest(range(1, 5)) AS INT) AS quarter)),
series AS (SELECT juris_key || '|' || year || '-Q' || quarter AS key, juris_key, year, quarter, make_date(year, quarter * 3 - 2, 1) AS quarter_start, coalesce(table_a2_rows, 0) AS table_a2_rows,
  array_to_string(list_filter([{", ".join(f"CASE WHEN {_RAISED[f]} THEN '{f}' END" for f in S.FLAGS)}], lambda x: x IS NOT NULL), ',') AS data_flags, {", ".join(f'coalesce("{n}", 0) AS "{n}"' for n in _NAMES)}
  FROM grid LEFT JOIN filed USING (juris_key, year) LEFT JOIN heaped USING (juris_key, year) LEFT JOIN wide USING (juris_key, year, quarter))"""


@query(f"WITH {_SERIES} SELECT * FROM series")
def series_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "jurisdictions")
    # the lines are taken apart once, for the cells, the heaps and the rows filed
    loaded = saved(p1_loaded(spark, sf_dir).select("source_index", "raw_values"), "loaded")
    rows = saved(S.located(S.stage_rows(loaded), places), "stages")
    filed = S.located(loaded.select(S.I.key(F.col("raw_values")[S.PLACE - 1]).alias("place"), S.count_or_zero(F.col("raw_values")[S.YEAR - 1]).cast("int").alias("report_year")), places).where("juris_key is not null")
    updated = table(spark, sf_dir, "permit_records").agg(F.to_date(F.max("received_at")).alias("last_updated"))
    # one row for each place beside the one day, so that the flags need no number from the driver
    dated = places.select("juris_key", F.lit(True).alias("one")).join(updated.withColumn("one", F.lit(True)), "one").select("juris_key", "last_updated")
    wide = S.series(rows, filed, places, FIRST, LAST, F.lit(None).cast("date"))
    provisional = S.provisional(F.col("last_updated"), F.col("year"))
    flags = F.when(provisional, F.concat_ws(",", F.nullif(F.col("data_flags"), F.lit("")), F.lit("provisional_year"))).otherwise(F.col("data_flags"))
    return wide.join(dated, "juris_key").withColumn("data_flags", flags).drop("last_updated")


def _exceeds(n: str, parts) -> str:
    return " + ".join(f'"{n}_{m}"' for m in parts)


@query(f"""WITH {_SERIES}, per_place AS (SELECT juris_key, count(s.key) AS n, count(DISTINCT s.key) AS keys FROM jurisdictions FULL JOIN series s USING (juris_key) GROUP BY ALL)
SELECT 'dense grid, unique keys' AS "check", count(*) AS objects_checked, count(*) FILTER (n <> {4 * (LAST - FIRST + 1)} OR keys <> {4 * (LAST - FIRST + 1)}) AS failures FROM per_place
UNION ALL SELECT 'bands add up to totals', count(*), count(*) FILTER ({" OR ".join(f'{_exceeds(n, S.MEASURES[:4])} <> "{n}_total"' for n in S.STAGES.values())}) FROM series
UNION ALL SELECT 'categories are within totals', count(*), count(*) FILTER ({" OR ".join(f'{_exceeds(n, S.UNIT_CATEGORIES.values())} > "{n}_total"' for n in S.STAGES.values())}) FROM series
UNION ALL SELECT 'no measure below zero', count(*), count(*) FILTER ({" OR ".join(f'"{n}" < 0' for n in _NAMES)}) FROM series""")
def series_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.series_checks(series_table(spark, sf_dir), table(spark, sf_dir, "jurisdictions"), FIRST, LAST)


@query(f"WITH {_LOADED}, {_HEAPS} SELECT stage, juris_key, CAST(year AS INT) AS year, dated_rows, date, rows, round(rows / dated_rows, 4) AS share FROM heaps")
def heaped_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.heaped(_rows(spark, sf_dir))


@query(f"""WITH {_LOADED}, l AS (SELECT stage, unnest(labels) AS label FROM stages WHERE day IS NOT NULL)
SELECT stage, label, count(*) AS n_rows, CASE WHEN {_PROGRAM.format("label")} IS NOT NULL THEN {_PROGRAM.format("label")} WHEN label IN ({_list(S.SKIPPED_PROGRAMS)}) THEN 'skipped' ELSE 'unrecognised' END AS counted_as FROM l GROUP BY ALL""")
def program_label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = _rows(spark, sf_dir).where("day is not null").select("stage", F.explode("labels").alias("label"))
    as_ = F.coalesce(S.lookup(F.col("label"), S.PROGRAMS), F.when(F.col("label").isin(*S.SKIPPED_PROGRAMS), "skipped").otherwise("unrecognised"))
    return each.groupBy("stage", "label").agg(F.count("*").alias("n_rows")).withColumn("counted_as", as_)


@query(f"WITH {_LOADED} SELECT stage, unit_category, coalesce({_CATEGORY}, 'unrecognised') AS counted_as, count(*) AS n_rows, CAST(sum(total) AS BIGINT) AS units, CAST(sum(deed_restricted) AS BIGINT) AS deed_restricted FROM stages GROUP BY ALL")
def unit_category_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_ = F.coalesce(S.lookup(F.col("unit_category"), S.UNIT_CATEGORIES), F.lit("unrecognised"))
    return _rows(spark, sf_dir).groupBy("stage", "unit_category", as_.alias("counted_as")).agg(F.count("*").alias("n_rows"), F.sum("total").alias("units"), F.sum("deed_restricted").alias("deed_restricted"))


@query(f"WITH {_LOADED} SELECT stage, count(*) FILTER (bonus IS NULL) AS unread_rows, count(*) FILTER (bonus > 0) AS bonus_rows, CAST(coalesce(sum(total) FILTER (bonus > 0), 0) AS BIGINT) AS bonus_units FROM stages WHERE day IS NOT NULL GROUP BY ALL")
def density_bonus_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    bonus = F.col("bonus") > 0
    return _rows(spark, sf_dir).where("day is not null").groupBy("stage").agg(F.count_if("bonus_unread").alias("unread_rows"), F.count_if(bonus).alias("bonus_rows"), F.coalesce(F.sum(F.when(bonus, F.col("total"))), F.lit(0)).alias("bonus_units"))


@query(f"""WITH {_LOADED} SELECT stage, juris_key, CAST(coalesce(sum(total) FILTER (day IS NOT NULL), 0) AS BIGINT) AS dated_units, CAST(coalesce(sum(total) FILTER (day IS NULL), 0) AS BIGINT) AS undated_units,
  CAST(coalesce(sum(total) FILTER (day BETWEEN period_start AND least(period_end, DATE '2022-12-31')), 0) AS BIGINT) AS in_cycle_units, CAST(sum(total) AS BIGINT) AS units FROM stages LEFT JOIN jurisdictions USING (juris_key) GROUP BY ALL""")
def stage_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated, undated and in-cycle units of each stage and place; those of places that aren't listed are in rows without a key."""
    periods = table(spark, sf_dir, "jurisdictions").select("juris_key", "period_start", F.least("period_end", F.lit("2022-12-31").cast("date")).alias("last_day"))
    rows = _rows(spark, sf_dir).join(periods, "juris_key", "left")

    def units(when) -> F.Column:
        return F.coalesce(F.sum(F.when(when, F.col("total"))), F.lit(0))

    day = F.col("day")
    return rows.groupBy("stage", "juris_key").agg(units(day.isNotNull()).alias("dated_units"), units(day.isNull()).alias("undated_units"), units(day.between(F.col("period_start"), F.col("last_day"))).alias("in_cycle_units"), F.sum("total").alias("units"))
