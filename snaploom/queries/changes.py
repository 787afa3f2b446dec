"""Queries of plans over both copies of the synced table, over whole rows and all their fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.functions.scalars import blank
from snaploom.operators import relational as R
from snaploom.plans import changes as C
from snaploom.plans import sync
from snaploom.queries.joins import BANDS
from snaploom.queries.plans import _ALL_CHANGES, _DESIRED, _EXPECTED, _copies
from snaploom.queries.registry import query
from snaploom.queries.scalars import _strip
from snaploom.storage import table

COUNTS = ("vli", "li", "mi", "ami", "permit_total", "undated_permits")
DAYS = ("rhna_start", "rhna_end", "last_updated")
TEXTS = ("jurisdiction", "project", "tracking", "data_status", "review_note")
UNITS = " + ".join(BANDS)

_PLAN = f"""
te AS (SELECT record_id, count(*) AS n FROM sync_expected GROUP BY 1), ts AS (SELECT record_id, count(*) AS n FROM sync_desired GROUP BY 1), e AS (SELECT * FROM {_EXPECTED} JOIN te USING (record_id)), d AS (SELECT * FROM {_DESIRED} JOIN ts USING (record_id)),
c AS (SELECT record_id, list(struct_pack(field_name := field_name, before := before, after := after) ORDER BY field_name) AS changes, bool_or(field_name IN {COUNTS} AND after IS NOT NULL AND NOT coalesce(regexp_full_match(replace(trim(after), ',', ''), '\\+?([0-9]+(\\.0*)?|\\.0+)'), false)) AS invalid FROM ({_ALL_CHANGES}) GROUP BY 1),
p AS (SELECT record_id, coalesce(c.changes, []) AS changes, list_filter([CASE WHEN e.n IS NULL THEN 'no target' END, CASE WHEN d.n IS NULL THEN 'no source' END, CASE WHEN e.n > 1 THEN 'ambiguous target' END, CASE WHEN d.n > 1 THEN 'ambiguous source' END, CASE WHEN invalid THEN 'invalid value' END], lambda x: x IS NOT NULL) AS blockers
  FROM e FULL JOIN d USING (record_id) LEFT JOIN c USING (record_id)),
plan AS (SELECT record_id, CASE WHEN len(blockers) > 0 THEN 'blocked' WHEN len(changes) > 0 THEN 'change' ELSE 'unchanged' END AS route, changes, blockers FROM p)"""


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, d = _copies(spark, sf_dir)
    n = [table(spark, sf_dir, f"sync_{x}").groupBy("record_id").agg(F.count("*").alias("n")) for x in ("expected", "desired")]
    return C.change_plan(e.join(n[0], "record_id"), d.join(n[1], "record_id"), "record_id", COUNTS)


@query(f"WITH {_PLAN} SELECT record_id, route, list_transform(changes, lambda c: c.field_name) AS changed, blockers FROM plan")
def change_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).select("record_id", "route", F.transform("changes", lambda c: c["field_name"]).alias("changed"), "blockers")


@query(f"WITH {_PLAN} SELECT record_id, x.field_name, x.before AS expected, x.after AS desired FROM (SELECT record_id, unnest(changes) AS x FROM plan WHERE route = 'change')")
def plan_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.updates(_plan(spark, sf_dir), "record_id")


@query(f"WITH {_PLAN} SELECT count(*) FILTER (route = 'blocked') AS blocked, count(*) FILTER (route = 'change') AS change, count(*) FILTER (route = 'unchanged') AS unchanged, count(*) FILTER (route = 'blocked') = 0 AS eligible, count(*) FILTER (route <> 'unchanged') = 0 AS complete FROM plan")
def plan_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.gates(_plan(spark, sf_dir))


_DIGEST = "SELECT CAST(coalesce(sum(CAST(('0x' || substr(md5(text), 1, 15)) AS HUGEINT)), 0) AS VARCHAR) AS digest, count(*) AS n FROM ({0})"
_TEXT = "concat_ws('|', record_id, route, array_to_string(list_transform(changes, lambda c: concat_ws('=', c.field_name, coalesce(c.before, chr(0)), coalesce(c.after, chr(0)))), ';'), array_to_string(blockers, ';')) AS text"


@query(f"WITH {_PLAN} {_DIGEST.format(f'SELECT {_TEXT} FROM plan')}")
def plan_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.plan_digest(_plan(spark, sf_dir), "record_id")


_COLUMNS = ("source_index", "csv_physical_line", "batch_no", "report_year", "jurisdiction", "jurisdiction_display", "permit_date", "tracking_raw", "project_raw", "raw_apn", "formatted_apn", "street_address", "standard_address", "latitude", "longitude", *BANDS, "reported_total", "unit_category", "tenure")
_ROW = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _COLUMNS) + ", {0})"


def _row_text():
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _COLUMNS], F.coalesce(F.unix_micros(F.col("received_at").cast("timestamp")).cast("string"), F.lit("")))


_MICROS = "coalesce(CAST(epoch_us(received_at) AS VARCHAR), '')"


@query(_DIGEST.format(f"SELECT {_ROW.format(_MICROS)} AS text FROM permit_records"))
def table_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all columns of the largest table, whatever its order."""
    return C.row_digest(table(spark, sf_dir, "permit_records").select(_row_text().alias("text")), "text")


@query(f"SELECT source_index, sha256({_ROW.format(_MICROS)}) AS row_sha256 FROM permit_records")
def whole_row_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "permit_records").select("source_index", F.sha2(_row_text(), 256).alias("row_sha256"))


@query(f"SELECT field_name, count(*) AS n_changes, sum(coalesce(try_cast(replace(trim(before), ',', '') AS DOUBLE), 0)) AS before, sum(coalesce(try_cast(replace(trim(after), ',', '') AS DOUBLE), 0)) AS after, sum(coalesce(try_cast(replace(trim(after), ',', '') AS DOUBLE), 0)) - sum(coalesce(try_cast(replace(trim(before), ',', '') AS DOUBLE), 0)) AS delta FROM ({_ALL_CHANGES}) WHERE field_name IN {COUNTS} GROUP BY 1")
def change_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the changed counts add up to before and after."""
    each = sync.map_changes(*_copies(spark, sf_dir), "record_id").where(F.col("field_name").isin(*COUNTS))
    sums = [F.sum(F.coalesce(F.regexp_replace(F.trim(c), ",", "").try_cast("double"), F.lit(0.0))) for c in ("before", "after")]
    return each.groupBy("field_name").agg(F.count("*").alias("n_changes"), sums[0].alias("before"), sums[1].alias("after"), (sums[1] - sums[0]).alias("delta"))


_DAY = "CAST(coalesce(try_strptime({0}, '%m/%d/%y'), try_strptime({0}, '%m/%d/%Y'), try_strptime({0}, '%Y-%m-%d'), try_strptime({0}, '%Y/%m/%d')) AS DATE)"
_CELL = f"nullif({_strip("fields['{0}']").replace("{", "{{").replace("}", "}}").replace("{{0}}", "{0}")}, '')"
_IS_COUNT = "regexp_full_match(replace({0}, ',', ''), '\\+?([0-9]+(\\.0*)?|\\.0+)')"
_TYPED = {f: f"CASE WHEN {_IS_COUNT.format(_CELL.format(f))} THEN CAST(CAST(replace({_CELL.format(f)}, ',', '') AS DOUBLE) AS BIGINT) END" for f in COUNTS} | {f: _DAY.format(_CELL.format(f)) for f in DAYS}


@query(f"""SELECT record_id, {", ".join(f"{v} AS {f}" for f, v in _TYPED.items())}, {", ".join(f"{_CELL.format(f)} AS {f}" for f in TEXTS)},
  list_filter([{", ".join(f"CASE WHEN {_CELL.format(f)} IS NOT NULL AND {v} IS NULL THEN '{f}' END" for f, v in _TYPED.items())}], lambda x: x IS NOT NULL) AS problems FROM {_DESIRED}""")
def snapshot_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest state of every record in typed columns."""
    return C.typed_cells(_copies(spark, sf_dir)[1], "record_id", "fields", COUNTS, DAYS, TEXTS)


@query(f"""SELECT record_id, list_sort(map_keys(e.fields)) = list_sort(map_keys(d.fields)) AND len(list_filter(map_keys(e.fields), lambda k: e.fields[k] IS DISTINCT FROM d.fields[k])) = 0 AS same_json FROM {_EXPECTED} e JOIN {_DESIRED} d USING (record_id)""")
def json_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the canonical texts of both copies are equal, whatever the order of their keys."""
    e, d = _copies(spark, sf_dir)

    def canonical(c: str):
        return F.to_json(F.transform(F.array_sort(F.map_entries(c)), lambda x: F.array(x["key"], x["value"])))

    both = e.select("record_id", canonical("fields").alias("a")).join(d.select("record_id", canonical("fields").alias("b")), "record_id")
    return both.select("record_id", (F.col("a") == F.col("b")).alias("same_json"))


@query("""SELECT name, count(*) AS n_rows, count(DISTINCT record_id) AS n_records, count(*) = count(DISTINCT record_id) AS is_unique, count(DISTINCT list_sort(map_keys(fields))) AS n_key_sets, max(synced_at) AS last_sync FROM (SELECT 'expected' AS name, record_id, expected_fields AS fields, synced_at FROM sync_expected UNION ALL SELECT 'desired', record_id, desired_fields, synced_at FROM sync_desired) GROUP BY 1""")
def export_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows, records and sets of keys each copy has, and whether its records are unique."""
    both = [table(spark, sf_dir, f"sync_{n}").select(F.lit(n).alias("name"), "record_id", F.col(f"{n}_fields").alias("fields"), "synced_at") for n in ("expected", "desired")]
    keys = F.array_join(F.array_sort(F.map_keys("fields")), ",")
    return both[0].unionAll(both[1]).groupBy("name").agg(F.count("*").alias("n_rows"), F.count_distinct("record_id").alias("n_records"), (F.count("*") == F.count_distinct("record_id")).alias("is_unique"), F.count_distinct(keys).alias("n_key_sets"), F.max("synced_at").alias("last_sync"))


@query("""SELECT address_id, CASE WHEN a = '' THEN nullif(b, '') WHEN b = '' OR upper(a) = upper(b) THEN a END AS value, CASE WHEN a = '' AND b = '' THEN 'none' WHEN a = '' THEN 'second' WHEN b = '' THEN 'first' WHEN upper(a) = upper(b) THEN 'both' ELSE 'ambiguous' END AS found_in FROM (SELECT address_id, trim(coalesce(street_address, '')) AS a, trim(coalesce(standard_address, '')) AS b FROM address_records)""")
def resolved_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value that two fields may give: the first before the second, none where they contradict each other."""
    a, b = F.col("a"), F.col("b")
    t = table(spark, sf_dir, "address_records").select("address_id", *[F.trim(F.coalesce(F.col(c), F.lit(""))).alias(n) for c, n in (("street_address", "a"), ("standard_address", "b"))])
    same = F.upper(a) == F.upper(b)
    found = F.when((a == "") & (b == ""), "none").when(a == "", "second").when(b == "", "first").when(same, "both").otherwise("ambiguous")
    return t.select("address_id", F.when(a == "", F.nullif(b, F.lit(""))).when((b == "") | same, a).alias("value"), found.alias("found_in"))


_IDENTITY = "CASE WHEN j.juris_key IS NOT NULL AND permit_date IS NOT NULL THEN j.juris_key || '/' || year(permit_date) || '/' || quarter(permit_date) END"
_CELLS = f"""
r AS (SELECT ledger_id, {_IDENTITY} AS identity, permit_date IS NULL AND {_strip("coalesce(project_raw, '')")} = '' AS blank FROM ledger_rows l LEFT JOIN jurisdictions j ON l.jurisdiction_display = j.juris_display),
w AS (SELECT DISTINCT {_IDENTITY} AS identity FROM permit_records p JOIN jurisdictions j ON p.jurisdiction = j.juris_display WHERE permit_date IS NOT NULL),
n AS (SELECT identity, count(*) AS n FROM r WHERE identity IS NOT NULL GROUP BY 1),
m AS (SELECT identity, row_number() OVER (ORDER BY identity) AS pos FROM w ANTI JOIN n USING (identity)), b AS (SELECT ledger_id, row_number() OVER (ORDER BY ledger_id) AS pos FROM r WHERE identity IS NULL AND blank)"""


@query(f"""WITH {_CELLS} SELECT r.identity, ledger_id, CASE WHEN n > 1 THEN 'repeated' WHEN w.identity IS NULL THEN 'orphan' ELSE 'matched' END AS route FROM r JOIN n USING (identity) LEFT JOIN w USING (identity)
UNION ALL SELECT identity, ledger_id, 'unidentified' FROM r WHERE identity IS NULL AND NOT blank UNION ALL SELECT m.identity, b.ledger_id, CASE WHEN m.identity IS NULL THEN 'spare' WHEN b.ledger_id IS NULL THEN 'create' ELSE 'reuse' END FROM m FULL JOIN b USING (pos)""")
def series_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters of places that permits give, against the ledger's rows as records."""
    j = table(spark, sf_dir, "jurisdictions").select("juris_key", F.col("juris_display").alias("name"))
    identity = F.when(F.col("juris_key").isNotNull() & F.col("permit_date").isNotNull(), F.concat_ws("/", "juris_key", F.year("permit_date").cast("string"), F.quarter("permit_date").cast("string")))
    ledger = table(spark, sf_dir, "ledger_rows").join(j, F.col("jurisdiction_display") == F.col("name"), "left")
    records = ledger.select("ledger_id", identity.alias("identity"), (F.col("permit_date").isNull() & blank(F.col("project_raw"))).alias("blank"))
    wanted = table(spark, sf_dir, "permit_records").where("permit_date is not null").join(j, F.col("jurisdiction") == F.col("name")).select(identity.alias("identity"))
    return C.routed_cells(records, wanted, "identity", "ledger_id")


_STATUS = "CASE length(county) % 3 WHEN 0 THEN 'In' WHEN 1 THEN 'Out' ELSE 'Pending' END"


@query(f"""
WITH s AS (SELECT juris_key, juris_display, {_STATUS} AS status FROM jurisdictions), t AS (SELECT jurisdiction_display AS juris_display, count(*) FILTER (report_year = 2025) AS n_current, max(tenure) FILTER (report_year = 2025) AS status FROM permit_records GROUP BY 1)
SELECT coalesce(s.juris_display, t.juris_display) AS place, CASE WHEN s.juris_key IS NULL THEN 'blocked: not in the source' WHEN t.juris_display IS NULL THEN 'blocked: not in the target' WHEN n_current = 0 THEN 'held: no current row' WHEN t.status IS DISTINCT FROM s.status THEN 'change' ELSE 'unchanged' END AS route,
  CASE WHEN n_current > 0 AND t.status IS DISTINCT FROM s.status THEN s.status END AS new_status, CASE WHEN s.juris_key IS NOT NULL AND n_current > 0 AND t.status IS DISTINCT FROM s.status THEN DATE '2026-01-31' END AS reviewed FROM s FULL JOIN t USING (juris_display)""")
def compliance_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status by place: blocked, held or changed; only a changed status gets a new review date."""
    s = table(spark, sf_dir, "jurisdictions").select("juris_key", F.col("juris_display").alias("place"), F.expr(_STATUS).alias("new"))
    now = F.col("report_year") == 2025
    t = table(spark, sf_dir, "permit_records").groupBy(F.col("jurisdiction_display").alias("at")).agg(F.count_if(now).alias("n_current"), F.max(F.when(now, F.col("tenure"))).alias("old"), F.lit(True).alias("there"))
    both = s.join(t, F.col("place") == F.col("at"), "full")
    changed = (F.col("n_current") > 0) & F.col("juris_key").isNotNull() & ~F.col("old").eqNullSafe(F.col("new"))
    route = F.when(F.col("juris_key").isNull(), "blocked: not in the source").when(F.col("there").isNull(), "blocked: not in the target").when(F.col("n_current") == 0, "held: no current row").when(changed, "change").otherwise("unchanged")
    return both.select(F.coalesce("place", "at").alias("place"), route.alias("route"), F.when(changed, F.col("new")).alias("new_status"), F.when(changed, F.lit("2026-01-31").cast("date")).alias("reviewed"))


@query(f"""SELECT j.juris_display || ',' || coalesce(sum({UNITS}), 0) || ',' || coalesce(sum({UNITS}) FILTER (permit_date IS NULL), 0) || ',' || CASE WHEN count(p.source_index) > 0 THEN 'reported' ELSE 'no_selected_rows' END AS line FROM jurisdictions j LEFT JOIN permit_records p ON p.jurisdiction = j.juris_display GROUP BY j.juris_display""")
def totals_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = F.expr(UNITS)
    j = table(spark, sf_dir, "jurisdictions").select(F.col("juris_display").alias("jurisdiction"))
    sums = {"units": units, "undated": F.when(F.col("permit_date").isNull(), units)}
    filled = R.zero_filled(j, table(spark, sf_dir, "permit_records"), "jurisdiction", sums)
    return filled.select(F.concat_ws(",", "jurisdiction", F.col("units").cast("string"), F.col("undated").cast("string"), "data_status").alias("line"))


@query("SELECT source_index AS node, unnest(list_distinct(retained_source_indices)) AS next, rule_name FROM dedup_audit")
def ledger_lines_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges read back from a ledger of one JSON document in a line."""
    lines = table(spark, sf_dir, "dedup_audit").select(F.to_json(F.struct("source_index", "rule_name", "retained_source_indices"), {"ignoreNullFields": "false"}).alias("line"))
    read = lines.select(F.from_json("line", "source_index bigint, rule_name string, retained_source_indices array<bigint>").alias("r")).select("r.*")
    return R.references(read, ["retained_source_indices"], ["source_index", "rule_name"]).select(F.col("source_index").alias("node"), F.col("ref").alias("next"), "rule_name")


_CHECKS = {"bands are no less than zero": " OR ".join(f"{b} < 0" for b in BANDS), "totals are their bands": f"permit_total <> {UNITS}", "undated are within totals": "undated > permit_total", "places without rows have no units": "n_rows = 0 AND permit_total > 0"}
_TOTALS = f"SELECT j.juris_key, {', '.join(f'coalesce(sum({b}), 0) AS {b}' for b in BANDS)}, coalesce(sum(reported_total), 0) AS permit_total, coalesce(sum(reported_total) FILTER (permit_date IS NULL), 0) AS undated, count(source_index) AS n_rows FROM jurisdictions j LEFT JOIN permit_records p ON p.jurisdiction = j.juris_display GROUP BY 1"


@query(" UNION ALL ".join(f"SELECT '{n}' AS \"check\", count(*) AS objects_checked, count(*) FILTER ({c}) AS failures FROM ({_TOTALS})" for n, c in _CHECKS.items()))
def totals_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "permit_records").withColumnRenamed("jurisdiction", "juris_display")
    sums = {b: F.col(b) for b in BANDS} | {"permit_total": F.col("reported_total"), "undated": F.when(F.col("permit_date").isNull(), F.col("reported_total"))}
    rows = R.zero_filled(table(spark, sf_dir, "jurisdictions").select("juris_display"), p, "juris_display", sums)
    counts = rows.agg(F.count("*").alias("objects_checked"), *[F.count_if(F.expr(c)).alias(f"f{i}") for i, c in enumerate(_CHECKS.values())])
    each = F.array(*[F.struct(F.lit(n).alias("check"), F.col("objects_checked"), F.col(f"f{i}").alias("failures")) for i, n in enumerate(_CHECKS)])
    return counts.select(F.explode(each).alias("x")).select("x.*")


@query("""
SELECT audit_id, len(flat) AS n_flat, list_sort(m) = list_sort(r) AS same_bag, list_sort(list_distinct(m)) = list_sort(list_distinct(r)) AS same_set, flat[1] AS first, round(len(r) / len(flat), 4) AS share FROM (SELECT audit_id, coalesce(matched_source_indices, []) AS m, coalesce(retained_source_indices, []) AS r, flatten([coalesce(matched_source_indices, []), coalesce(retained_source_indices, [])]) AS flat FROM dedup_audit) WHERE len(flat) > 0""")
def audit_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattening, equality as bags and as sets, the first value, and a rounded ratio of lists."""
    m, r = (F.coalesce(F.col(c), F.array().cast("array<bigint>")) for c in ("matched_source_indices", "retained_source_indices"))
    t = table(spark, sf_dir, "dedup_audit").select("audit_id", m.alias("m"), r.alias("r"), F.flatten(F.array(m, r)).alias("flat")).where("size(flat) > 0")
    return t.select("audit_id", F.size("flat").cast("bigint").alias("n_flat"), (F.array_sort("m") == F.array_sort("r")).alias("same_bag"), (F.array_sort(F.array_distinct("m")) == F.array_sort(F.array_distinct("r"))).alias("same_set"), F.col("flat")[0].alias("first"), F.round(F.size("r") / F.size("flat"), 4).alias("share"))


@query("""
WITH n AS (SELECT juris_key AS name FROM jurisdictions UNION SELECT juris_display FROM jurisdictions) SELECT count(*) AS n_rows, count(jurisdiction) AS n_typed, count(*) FILTER (n.name IS NOT NULL) AS n_matched, count(*) FILTER (jurisdiction IS NOT NULL AND n.name IS NULL) AS n_unmatched FROM permit_records LEFT JOIN n ON jurisdiction = n.name""")
def selection_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where all rows go that the queries by listed place see: typed as listed, typed otherwise, or not at all."""
    names = table(spark, sf_dir, "jurisdictions").select(F.explode(F.array("juris_key", "juris_display")).alias("name")).distinct()
    p = table(spark, sf_dir, "permit_records").select("jurisdiction").join(names, F.col("jurisdiction") == F.col("name"), "left")
    return p.agg(F.count("*").alias("n_rows"), F.count("jurisdiction").alias("n_typed"), F.count("name").alias("n_matched"), F.count_if(F.col("jurisdiction").isNotNull() & F.col("name").isNull()).alias("n_unmatched"))
