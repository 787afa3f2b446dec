"""Queries of scalar functions over the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.functions import identifiers as I
from snaploom.functions import scalars as S
from snaploom.functions.pace import pace
from snaploom.queries.registry import query
from snaploom.storage import table

_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


_COMPACT = "regexp_replace(upper(trim(coalesce({0}, ''))), '[^A-Z0-9]', '', 'g')"
_EMPTY_IDS = ", ".join(f"'{x}'" for x in I.EMPTY_IDS)
_EMPTY_PARCELS = ", ".join(f"'{x}'" for x in I.EMPTY_PARCELS)


@query(f"""
WITH t AS (SELECT source_index, {_COMPACT.format('tracking_raw')} AS compact_id, {_COMPACT.format('raw_apn')} AS apn FROM permit_records)
SELECT source_index, compact_id, CASE WHEN length(compact_id) < 3 OR compact_id IN ({_EMPTY_IDS}) THEN '' ELSE compact_id END AS tracking_id,
  CASE WHEN apn IN ({_EMPTY_PARCELS}) THEN '' ELSE apn END AS raw_parcel,
  CASE WHEN apn IN ({_EMPTY_PARCELS}) THEN '' ELSE array_to_string(list_transform(regexp_extract_all(apn, '([A-Z]+|[0-9]+)', 1), lambda p: CASE WHEN regexp_matches(p, '^[0-9]') THEN CAST(CAST(p AS HUGEINT) AS VARCHAR) ELSE p END), '|') END AS formatted_parcel
FROM t""")
def identifier_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records")
    raw = I.parcel_raw(F.col("raw_apn"))
    return p.select("source_index", I.compact(F.col("tracking_raw")).alias("compact_id"), I.tracking_id(F.col("tracking_raw")).alias("tracking_id"), raw.alias("raw_parcel"), S.let(raw, I.parcel_formatted).alias("formatted_parcel"))


@query("""
WITH t AS (SELECT source_index, regexp_replace(upper(trim(coalesce(raw_apn, ''))), '[^A-Z0-9]', '', 'g') AS apn, try_cast(trim(latitude) AS DOUBLE) AS north, try_cast(trim(longitude) AS DOUBLE) AS east, upper(regexp_replace(tracking_raw, '\\s+', '', 'g')) AS cleaned FROM permit_records)
SELECT source_index, apn NOT IN ('', '0', 'NA', 'NONE', 'NULL', 'TBD', 'UNKNOWN', 'NOTAVAILABLE', 'NOTAPPLICABLE', 'UNASSIGNED') AND NOT regexp_full_match(apn, '[0-9]+E[0-9]+') AND NOT (regexp_full_match(apn, '[0-9]+') AND len(list_distinct(string_split(apn, ''))) = 1) AS has_parcel,
  coalesce(north BETWEEN 32.0 AND 42.1 AND east BETWEEN -125.0 AND -114.0, false) AS has_point,
  regexp_extract(cleaned, '^[A-Z]*') AS prefix, regexp_replace(cleaned, '[0-9]', '9', 'g') AS pattern
FROM t""")
def location_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records")
    shape = I.tracking_shape(F.col("tracking_raw"))
    return p.select("source_index", S.let(I.parcel_raw(F.col("raw_apn")), I.is_parcel).alias("has_parcel"), I.coordinates(F.col("latitude"), F.col("longitude")).isNotNull().alias("has_point"), shape["prefix"].alias("prefix"), shape["pattern"].alias("pattern"))


_UNIT = r"\b(UNIT|APT|APARTMENT|SUITE|STE|LOT|BLDG|BUILDING)\s*:?[# ]*([A-Z0-9-]+)"


@query(f"""
WITH t AS (SELECT source_index, upper(trim(coalesce(street_address, '') || ' ' || coalesce(standard_address, ''))) AS both_texts FROM permit_records),
m AS (SELECT source_index, list_zip(regexp_extract_all(both_texts, '{_UNIT}', 1), regexp_extract_all(both_texts, '{_UNIT}', 2)) AS pairs FROM t)
SELECT source_index, list_sort(list_distinct(list_transform(pairs, lambda p: CASE p[1] WHEN 'LOT' THEN 'LOT' WHEN 'BLDG' THEN 'BLDG' WHEN 'BUILDING' THEN 'BLDG' ELSE 'UNIT' END || ' ' || CASE WHEN ltrim(p[2], '0') = '' THEN '0' ELSE ltrim(p[2], '0') END))) AS units
FROM m WHERE len(pairs) > 0""")
def unit_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records")
    return p.select("source_index", I.units(F.col("street_address"), F.col("standard_address")).alias("units")).where("size(units) > 0")


_MAP = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in I.WORDS.items()) + "}"
_TOKENS = r"list_transform(regexp_extract_all(regexp_replace(split_part(split_part(replace(upper({s}), chr(13), chr(10)), chr(10), 1), ',', 1), '(\b(UNIT|APT|APARTMENT|SUITE|STE|LOT|BLDG|BUILDING)\b|#)(.|\n)*$', ''), '[A-Z0-9]+'), lambda t: coalesce({m}[t], t))".replace("{m}", _MAP).replace("{s}", _strip("coalesce(street_address, '')"))


@query(f"SELECT source_index, {_TOKENS} AS tokens FROM permit_records")
def address_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records")
    return p.select("source_index", I.street_tokens(F.col("street_address")).alias("tokens"))


@query(f"""
WITH t AS (SELECT source_index, {_TOKENS} AS tokens FROM permit_records),
c AS (SELECT source_index, tokens, len(tokens) >= 3 AND tokens[-2] IN ({", ".join(f"'{s}'" for s in I.SUFFIXES)}) AND regexp_full_match(tokens[-1], '[A-Z]|[0-9]{{1,4}}') AS tailed FROM t WHERE len(tokens) >= 2 AND regexp_matches(tokens[1], '[0-9]'))
SELECT source_index, tokens[1] AS house, array_to_string(CASE WHEN tailed THEN tokens[2:-2] ELSE tokens[2:] END, ' ') AS street FROM c""")
def address_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records")
    a = p.select("source_index", I.address(F.col("street_address"), F.array().cast("array<string>")).alias("a")).where("a is not null")
    return a.select("source_index", F.col("a.house").alias("house"), F.col("a.street").alias("street"))


@query("""
WITH t AS (SELECT source_index, jurisdiction_display AS place, formatted_apn, regexp_replace(upper(street_address), '[^A-Z0-9]+', ' ', 'g') AS street FROM permit_records WHERE formatted_apn <> '' AND street_address <> '')
SELECT a.source_index AS a, b.source_index AS b, CASE WHEN a.street = b.street THEN 0 ELSE 1 END AS edits
FROM t a JOIN t b ON a.place = b.place AND a.formatted_apn = b.formatted_apn AND a.source_index < b.source_index WHERE levenshtein(a.street, b.street) <= 1""")
def edit_distance_one_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "permit_records").where("formatted_apn <> '' AND street_address <> ''").select("source_index", F.col("jurisdiction_display").alias("place"), "formatted_apn", F.regexp_replace(F.upper("street_address"), "[^A-Z0-9]+", " ").alias("street"))
    on = (F.col("l.place") == F.col("r.place")) & (F.col("l.formatted_apn") == F.col("r.formatted_apn")) & (F.col("l.source_index") < F.col("r.source_index"))
    pairs = t.alias("l").join(t.alias("r"), on).where(I.one_edit(F.col("l.street"), F.col("r.street")))
    return pairs.select(F.col("l.source_index").alias("a"), F.col("r.source_index").alias("b"), F.when(F.col("l.street") == F.col("r.street"), 0).otherwise(1).alias("edits"))


_NUMBER = "CASE source_index % 8 WHEN 0 THEN ' ' || n || ' ' WHEN 1 THEN n || '.0' WHEN 2 THEN n || '.5' WHEN 3 THEN '-' || n WHEN 4 THEN n || 'e1' WHEN 5 THEN '1,' || lpad(n, 3, '0') WHEN 6 THEN n || ' units' ELSE '' END"


@query(f"""
WITH t AS (SELECT source_index, CAST(source_index % 97 AS VARCHAR) AS n FROM permit_records), s AS (SELECT source_index, {_NUMBER} AS written FROM t),
v AS (SELECT source_index, written, replace(trim(written), ',', '') AS plain FROM s)
SELECT source_index, written, CASE WHEN trim(written) = '' THEN 0 WHEN try_cast(plain AS DOUBLE) >= 0 AND try_cast(plain AS DOUBLE) = floor(try_cast(plain AS DOUBLE)) THEN CAST(try_cast(plain AS DOUBLE) AS BIGINT) END AS strict_count,
  CASE WHEN trim(written) = '' THEN 0 ELSE CAST(trunc(try_cast(plain AS DOUBLE)) AS BIGINT) END AS lenient_count FROM v""")
def strict_number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "permit_records").select("source_index", F.expr("CAST(source_index % 97 AS STRING)").alias("n")).select("source_index", F.expr(_NUMBER).alias("written"))
    plain = F.regexp_replace(S.strip(F.col("written")), ",", "")
    strict = F.when(S.blank(F.col("written")), F.lit(0)).when(S.is_count(F.col("written")), plain.try_cast("double")).cast("bigint")
    lenient = F.when(S.blank(F.col("written")), F.lit(0)).otherwise(plain.try_cast("double")).cast("bigint")
    return t.select("source_index", "written", strict.alias("strict_count"), lenient.alias("lenient_count"))


_DATED = "CASE source_index % 7 WHEN 0 THEN date_text_us WHEN 1 THEN date_text_iso WHEN 2 THEN date_text_short WHEN 3 THEN date_text_slash WHEN 4 THEN '02/30/2024' WHEN 5 THEN 'soon' ELSE ' ' || date_text_iso || ' ' END"


@query(f"""
WITH t AS (SELECT source_index, strftime(permit_date, '%m/%d/%Y') AS date_text_us, strftime(permit_date, '%Y-%m-%d') AS date_text_iso, strftime(permit_date, '%m/%d/%y') AS date_text_short, strftime(permit_date, '%Y/%m/%d') AS date_text_slash FROM permit_records WHERE permit_date IS NOT NULL),
s AS (SELECT source_index, {_DATED} AS written FROM t)
SELECT source_index, written, CAST(coalesce(try_strptime(trim(written), '%m/%d/%y'), try_strptime(trim(written), '%m/%d/%Y'), try_strptime(trim(written), '%Y-%m-%d'), try_strptime(trim(written), '%Y/%m/%d')) AS DATE) AS day FROM s""")
def multi_format_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").where("permit_date is not null")
    forms = {"us": "MM/dd/yyyy", "iso": "yyyy-MM-dd", "short": "MM/dd/yy", "slash": "yyyy/MM/dd"}
    t = p.select("source_index", *[F.date_format("permit_date", f).alias(f"date_text_{n}") for n, f in forms.items()]).select("source_index", F.expr(_DATED).alias("written"))
    return t.select("source_index", "written", S.calendar_day(F.col("written")).alias("day"))


@query("SELECT juris_key, juris_display AS display FROM jurisdictions")
def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "jurisdictions")
    return j.select("juris_key", I.display_name(F.col("juris_key")).alias("display"))


@query(f"SELECT DISTINCT regexp_replace({_strip('upper(strip_accents(jurisdiction))')}, '{_SPACE}+', ' ', 'g') AS folded FROM permit_records")
def accent_fold_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "permit_records").select(F.upper(S.squeeze(I.without_accents(F.col("jurisdiction")))).alias("folded")).distinct()


@query("""
SELECT label, count(*) AS n_rows, CAST(sum(total) AS BIGINT) AS units FROM (SELECT DISTINCT source_index, total, trim(label) AS label FROM (SELECT source_index, coalesce(reported_total, 0) AS total, unnest(string_split(upper(replace(project_raw, ' ', ',')), ',')) AS label FROM permit_records WHERE project_raw IS NOT NULL))
WHERE label NOT IN ('', 'NONE', 'NA', 'N/A', 'NO') GROUP BY label""")
def label_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").where("project_raw is not null")
    each = p.select("source_index", F.coalesce("reported_total", F.lit(0)).alias("total"), F.explode(I.labels(F.regexp_replace("project_raw", " ", ","))).alias("label"))
    return each.groupBy("label").agg(F.count("*").alias("n_rows"), F.sum("total").alias("units"))


@query("""
WITH t AS (SELECT j.juris_key, sum(coalesce(p.reported_total, 0)) AS credited, 5 * count(p.source_index) AS allocation, any_value(j.period_start) AS s, any_value(j.period_end) AS e FROM jurisdictions j LEFT JOIN permit_records p ON p.jurisdiction = j.juris_display GROUP BY 1),
d AS (SELECT *, date_diff('day', s, e) AS period_days, least(greatest(date_diff('day', s, DATE '2021-06-30'), 0), date_diff('day', s, e)) AS elapsed_days FROM t),
m AS (SELECT *, (allocation * elapsed_days + period_days - 1) // period_days AS due FROM d)
SELECT juris_key, CAST(credited AS BIGINT) AS credited, CAST(allocation AS BIGINT) AS allocation, CAST(elapsed_days AS BIGINT) AS elapsed_days, CAST(due AS BIGINT) AS minimum_units, CASE WHEN allocation = 0 THEN 'no_allocation' WHEN elapsed_days = 0 THEN 'not_started' WHEN credited >= due THEN 'on_pace' ELSE 'behind_pace' END AS status FROM m""")
def exact_pace(spark: SparkSession, sf_dir: str) -> DataFrame:
    j, p = table(spark, sf_dir, "jurisdictions"), table(spark, sf_dir, "permit_records")
    sums = p.groupBy(F.col("jurisdiction").alias("juris_display")).agg(F.sum(F.coalesce("reported_total", F.lit(0))).alias("credited"), (F.count("*") * 5).alias("allocation"))
    t = j.join(sums, "juris_display", "left").na.fill(0, ["credited", "allocation"])
    found = pace(F.col("credited"), F.col("allocation"), F.col("period_start"), F.col("period_end"), F.lit("2021-06-30").cast("date"))
    return t.select("juris_key", "credited", "allocation", found.alias("p")).select("juris_key", "credited", "allocation", "p.elapsed_days", "p.minimum_units", "p.status")


@query("SELECT source_index, acutely_low + extremely_low + very_low AS vli, low AS li, moderate AS mi, above_moderate AS ami, CASE WHEN reported_total = acutely_low + extremely_low + very_low + low + moderate + above_moderate THEN 'agrees' WHEN reported_total IS NULL THEN 'missing' ELSE 'differs' END AS total_status FROM permit_records")
def band_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vli = F.col("acutely_low") + F.col("extremely_low") + F.col("very_low")
    bands = vli + F.col("low") + F.col("moderate") + F.col("above_moderate")
    status = F.when(F.col("reported_total") == bands, "agrees").when(F.col("reported_total").isNull(), "missing").otherwise("differs")
    return table(spark, sf_dir, "permit_records").select("source_index", vli.alias("vli"), F.col("low").alias("li"), F.col("moderate").alias("mi"), F.col("above_moderate").alias("ami"), status.alias("total_status"))


@query(f"SELECT address_id, {_strip("coalesce(street_address, '')")} = {_strip("coalesce(standard_address, '')")} AS same_text FROM address_records")
def null_equal_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "address_records")
    text = [F.nullif(S.strip(F.col(c)), F.lit("")) for c in ("street_address", "standard_address")]
    return a.select("address_id", text[0].eqNullSafe(text[1]).alias("same_text"))


_URL = "concat('https://data.example/file/', doc_id, '?id=', doc_id, '&x-amz-date=', doc_id * 7, '&lang=', coalesce(lang, 'en'), '&x-amz-signature=', doc_id * 3)"


@query(f"WITH t AS (SELECT doc_id, {_URL} AS url FROM documents) SELECT doc_id, split_part(url, '?', 1) || '?' || array_to_string(list_filter(string_split(split_part(url, '?', 2), '&'), lambda p: NOT starts_with(p, 'x-amz-')), '&') AS unsigned_url FROM t")
def unsigned_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "documents").select("doc_id", F.expr(_URL).alias("url"))
    kept = F.filter(F.split(F.substring_index("url", "?", -1), "&"), lambda p: ~F.lower(p).startswith("x-amz-"))
    return t.select("doc_id", F.concat(F.substring_index("url", "?", 1), F.lit("?"), F.array_join(kept, "&")).alias("unsigned_url"))


@query("SELECT source_index, CAST(floor(100.0 * very_low / reported_total + 0.5) AS BIGINT) AS percent, CASE WHEN very_low * 100 >= 29 * reported_total THEN 'high' ELSE 'low' END AS class FROM permit_records WHERE reported_total > 0")
def guarded_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").where("reported_total > 0")
    return p.select("source_index", F.floor(F.lit(100.0) * F.col("very_low") / F.col("reported_total") + 0.5).alias("percent"), F.when(F.col("very_low") * 100 >= F.col("reported_total") * 29, "high").otherwise("low").alias("class"))


@query("SELECT doc_id, CAST(coalesce(try_strptime(doc_title, '%Y-%m-%d'), published_at, received_at) AS DATE) AS updated FROM documents")
def source_update_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.coalesce(F.when(F.col("doc_title").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("doc_title").try_cast("date")), F.to_date("published_at"), F.to_date("received_at")).alias("updated"))
