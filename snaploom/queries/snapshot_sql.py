"""SQL of the snapshot rules, one common table expression for each step, over whole tables.

Components under vetoes are grown by a recursion over each block's edges in
their order, the state being a list of nodes with their components.
"""

from __future__ import annotations

from snaploom.functions import identifiers as I
from snaploom.plans.snapshots import RULES
from snaploom.queries.scalars import _COMPACT, _EMPTY_IDS, _EMPTY_PARCELS, _SPACE, _TOKENS, _UNIT, _strip


def _unpadded(c: str) -> str:
    return f"CASE WHEN ltrim({c}, '0') = '' THEN '0' ELSE ltrim({c}, '0') END"


def _key(c: str) -> str:
    return f"""regexp_replace({_strip(f"upper(coalesce({c}, ''))")}, '{_SPACE}+', ' ', 'g')"""


def _address(t: str) -> str:
    tail = f"coalesce(len({t}) >= 3 AND {t}[-2] IN ({', '.join(map(repr, I.SUFFIXES))}) AND regexp_full_match({t}[-1], '[A-Z]|[0-9]{{1,4}}'), false)"
    units = f"list_sort(list_distinct(list_concat(u, CASE WHEN {tail} THEN ['UNIT ' || {_unpadded(f'{t}[-1]')}] ELSE CAST([] AS VARCHAR[]) END)))"
    return f"CASE WHEN len({t}) >= 2 AND regexp_matches({t}[1], '[0-9]') THEN struct_pack(house := {t}[1], street := array_to_string(CASE WHEN {tail} THEN {t}[2:-2] ELSE {t}[2:] END, ' '), units := {units}) END"


def _solid(x: str) -> str:
    return f"replace({x}.street, ' ', '')"


def _near(least: int) -> str:
    a, b = _solid("x"), _solid("y")
    return f"(least(length({a}), length({b})) >= {least} AND levenshtein({a}, {b}) <= 1)"


_KIND = f"CASE WHEN x.house = y.house AND x.units = y.units THEN CASE WHEN {_solid('x')} = {_solid('y')} THEN 0 WHEN {_near(4)} THEN 1 END END"
MATCH = f"list_filter(flatten(list_transform(a.addrs, lambda x: list_transform(b.addrs, lambda y: {_KIND}))), lambda k: k IS NOT NULL)[1]"
STREET = f"list_bool_or(flatten(list_transform(a.addrs, lambda x: list_transform(b.addrs, lambda y: {_solid('x')} = {_solid('y')} OR {_near(5)}))))"
HOUSE = "list_has_any(list_transform(a.addrs, lambda x: x.house), list_transform(b.addrs, lambda x: x.house))"
_UNITS = "list_sort(list_distinct(flatten(list_transform({0}.addrs, lambda x: x.units))))"
CONFLICT = f"(len({_UNITS.format('a')}) > 0 AND len({_UNITS.format('b')}) > 0 AND {_UNITS.format('a')} <> {_UNITS.format('b')})"
BOTH = "(len(a.addrs) > 0 AND len(b.addrs) > 0)"
_PRINTED = ("acutely_low", "above_moderate", "extremely_low", "jurisdiction", "latitude", "longitude", "low", "moderate", "permit_date", "project_raw", "raw_apn", "reported_total", "standard_address", "street_address", "tenure", "tracking_raw", "unit_category", "very_low")
_PLAIN = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def _degrees(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '{_PLAIN}') THEN try_cast(trim({c}) AS DOUBLE) END"


PREPARED = f"""
t AS (SELECT *, {_TOKENS} AS t1, {_TOKENS.replace("street_address", "standard_address")} AS t2, upper(trim(coalesce(street_address, '') || ' ' || coalesce(standard_address, ''))) AS both_texts,
  {_COMPACT.format("tracking_raw")} AS compact_id, {_COMPACT.format("raw_apn")} AS apn, {_degrees("latitude")} AS north, {_degrees("longitude")} AS east FROM permit_records),
u AS (SELECT *, list_sort(list_distinct(list_transform(list_zip(regexp_extract_all(both_texts, '{_UNIT}', 1), regexp_extract_all(both_texts, '{_UNIT}', 2)), lambda p: CASE p[1] WHEN 'LOT' THEN 'LOT' WHEN 'BLDG' THEN 'BLDG' WHEN 'BUILDING' THEN 'BLDG' ELSE 'UNIT' END || ' ' || {_unpadded("p[2]")}))) AS u FROM t),
prep AS (SELECT source_index, {_key("jurisdiction")} AS place, permit_date AS day, report_year AS year, CASE WHEN length(compact_id) < 3 OR compact_id IN ({_EMPTY_IDS}) THEN '' ELSE compact_id END AS id,
  trim(coalesce(tracking_raw, '')) AS tracking, {_COMPACT.format("project_raw")} AS project, CASE WHEN apn IN ({_EMPTY_PARCELS}) THEN '' ELSE apn END AS raw,
  CASE WHEN apn IN ({_EMPTY_PARCELS}) THEN '' ELSE array_to_string(list_transform(regexp_extract_all(apn, '([A-Z]+|[0-9]+)', 1), lambda p: CASE WHEN regexp_matches(p, '^[0-9]') THEN {_unpadded("p")} ELSE p END), '|') END AS formatted,
  apn NOT IN ({_EMPTY_PARCELS}) AND NOT regexp_full_match(apn, '[0-9]+E[0-9]+') AND NOT (regexp_full_match(apn, '[0-9]+') AND len(list_distinct(string_split(apn, ''))) = 1) AS has_parcel,
  list_sort(list_distinct(list_filter([{_address("t1")}, {_address("t2")}], lambda x: x IS NOT NULL))) AS addrs, [t1, t2] AS streets,
  CASE WHEN north BETWEEN 32.0 AND 42.1 AND east BETWEEN -125.0 AND -114.0 THEN struct_pack(n := north, e := east) END AS point,
  [coalesce(acutely_low, 0), coalesce(extremely_low, 0), coalesce(very_low, 0), coalesce(low, 0), coalesce(moderate, 0), coalesce(above_moderate, 0)] AS bands, coalesce(reported_total, 0) AS total, {_key("unit_category")} AS unit_category, {_key("tenure")} AS tenure,
  concat_ws(chr(31), {", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _PRINTED)}) AS print FROM u),
strong AS (SELECT * FROM prep WHERE day IS NOT NULL AND id <> ''), weak AS (SELECT * FROM prep WHERE day IS NOT NULL AND id = '')"""


def grown(name: str, rows: str, block: tuple[str, ...], edges: str, vetoed: bool = True) -> str:
    """``name`` (source_index, year, block, component) of the rows of blocks that have an edge."""
    keys = ", ".join(block)
    on = " AND ".join(f"a.{k} = b.{k}" for k in block)

    def of(n: str) -> str:
        return f"list_filter(st, lambda s: s.n = {n})[1].c"

    against = f"SELECT {', '.join(f'a.{k}' for k in block)}, list(struct_pack(x := a.source_index, y := b.source_index)) AS vs FROM {rows} a JOIN {rows} b ON {on} AND a.source_index < b.source_index WHERE {BOTH} AND {MATCH} IS NULL GROUP BY ALL"
    if not vetoed:
        against = f"SELECT {keys}, CAST([] AS STRUCT(x BIGINT, y BIGINT)[]) AS vs FROM {rows} WHERE false"
    pairs = f"list_transform(coalesce(vs, []), lambda v: [{of('v.x')}, {of('v.y')}])"
    return f"""
{name}_v AS ({against}),
{name}_b AS (SELECT {keys}, list(struct_pack(a := a, b := b) ORDER BY kind, a, b) AS es, list_transform(list_distinct(flatten(list([a, b]))), lambda n: struct_pack(n := n, c := n)) AS st FROM {edges} GROUP BY ALL),
{name}_g AS (SELECT {keys}, es, vs, 1 AS i, st FROM {name}_b LEFT JOIN {name}_v USING ({keys}) UNION ALL
  SELECT {keys}, es, vs, i + 1, CASE WHEN ca = cb OR list_has_any(vetoes, [[ca, cb], [cb, ca]]) THEN st ELSE list_transform(st, lambda s: struct_pack(n := s.n, c := CASE WHEN s.c = greatest(ca, cb) THEN least(ca, cb) ELSE s.c END)) END
  FROM (SELECT *, {of("es[i].a")} AS ca, {of("es[i].b")} AS cb, {pairs} AS vetoes FROM {name}_g WHERE i <= len(es))),
{name}_c AS (SELECT unnest(st, recursive := true) FROM {name}_g WHERE i > len(es)),
{name} AS (SELECT r.source_index, r.year, {", ".join(f"r.{k}" for k in block)}, coalesce(c.c, r.source_index) AS component FROM {rows} r SEMI JOIN {name}_b USING ({keys}) LEFT JOIN {name}_c c ON c.n = r.source_index)"""


def later(name: str, members: str, group: str, guarded: bool) -> str:
    """``name`` (source_index, latest_year, refs, size) of the earlier rows of groups with several years."""
    return f"""
{name}_y AS (SELECT {group}, year, count(*) AS n, list(source_index ORDER BY source_index) AS members FROM {members} GROUP BY ALL),
{name}_s AS (SELECT {group}, count(*) AS years, sum(n) AS size, max(n) AS most, max(year) AS latest_year, arg_max(n, year) AS latest_n, arg_max(members, year) AS refs FROM {name}_y GROUP BY ALL HAVING count(*) > 1{" AND arg_max(n, year) >= max(n)" if guarded else ""}),
{name} AS (SELECT m.source_index, latest_year, refs, size FROM {members} m JOIN {name}_s USING ({group}) WHERE year < latest_year)"""


_STRONG = ("place", "day", "id")
_ON = "a.place = b.place AND a.day = b.day AND a.id = b.id"
EDGES = f"""{PREPARED},
within_blocks AS (SELECT * FROM strong SEMI JOIN (SELECT place, day, id FROM strong GROUP BY ALL HAVING count(DISTINCT year) > 1) USING (place, day, id)),
edges AS (SELECT * FROM (SELECT a.place, a.day, a.id, a.source_index AS a, b.source_index AS b, CASE WHEN {BOTH} THEN {MATCH} WHEN a.raw <> '' AND a.raw = b.raw THEN 2 WHEN a.formatted <> '' AND a.formatted = b.formatted THEN 3 END AS kind
  FROM within_blocks a JOIN within_blocks b ON {_ON} AND a.source_index < b.source_index AND a.year <> b.year) WHERE kind IS NOT NULL)"""
COLLISIONS = f"""collisions AS (SELECT DISTINCT a.place, a.id FROM strong a JOIN strong b ON {_ON} AND a.year = b.year AND a.source_index < b.source_index
  WHERE CASE WHEN {BOTH} THEN {MATCH} IS NULL ELSE a.formatted <> '' AND b.formatted <> '' AND a.formatted <> b.formatted END)"""
COMPONENTS = f"{EDGES}, {grown('comps', 'within_blocks', _STRONG, 'edges')}"
BLOCKS = f"""{COMPONENTS}, {COLLISIONS},
years AS (SELECT place, day, id, year, count(*) AS n FROM strong GROUP BY ALL),
shape AS (SELECT place, day, id, count(*) AS years, max(n) AS most, max(year) AS latest_year, arg_max(n, year) AS latest_n, sum(n) AS size FROM years GROUP BY ALL HAVING count(*) > 1),
parts AS (SELECT place, day, id, max(CAST(low < high AS INT)) AS matched, count(*) AS parts FROM (SELECT place, day, id, component, min(year) AS low, max(year) AS high FROM comps GROUP BY ALL) GROUP BY ALL),
days AS (SELECT place, id, count(DISTINCT day) AS days FROM strong GROUP BY ALL),
blocks AS (SELECT place, day, id, years, CAST(size AS BIGINT) AS size, most, days, latest_year, latest_n, c.id IS NOT NULL AS collides, CASE WHEN coalesce(matched, 0) = 0 THEN 'unresolved' WHEN parts > 1 THEN 'split' ELSE 'settled' END AS state
  FROM shape LEFT JOIN parts USING (place, day, id) JOIN days USING (place, id) LEFT JOIN collisions c USING (place, id))"""

_PROJECTS = ", ".join(map(repr, I.EMPTY_PROJECTS))
_SIGNALS = f"""list_filter([CASE WHEN a.has_parcel AND b.has_parcel AND a.formatted = b.formatted THEN 'exact_valid_apn' END, CASE WHEN a.point = b.point THEN 'exact_valid_coordinates' END, CASE WHEN a.project NOT IN ({_PROJECTS}) AND a.project = b.project THEN 'substantive_project' END,
  CASE WHEN {STREET} THEN 'street' END, CASE WHEN {HOUSE} THEN 'house_number' END], lambda s: s IS NOT NULL)"""
_EXACT = "list_has_any(found, ['exact_valid_apn', 'exact_valid_coordinates'])"


def _toward(active: str, blocks: str, select: str) -> str:
    return f"SELECT {select} FROM {active} a JOIN {blocks} k ON a.place = k.place AND a.day = k.day AND a.id = k.id AND a.year < k.latest_year JOIN {active} b ON {_ON} AND b.year = k.latest_year"


_SITE = f"a.has_parcel AND b.has_parcel AND a.formatted = b.formatted AND coalesce(a.point = b.point, false) AND NOT {CONFLICT}"
_WEAK = ("place", "day", "project")
_ALIKE = "a.place = b.place AND a.day = b.day AND a.project = b.project AND a.bands = b.bands AND a.total = b.total AND a.unit_category = b.unit_category AND a.tenure = b.tenure"
_PARCEL = "(a.has_parcel AND b.has_parcel AND (a.raw = b.raw OR a.formatted = b.formatted))"


def _weak_edges(name: str, rows: str, on: str) -> str:
    return f"{name} AS (SELECT a.place, a.day, a.project, 0 AS kind, a.source_index AS a, b.source_index AS b FROM {rows} a JOIN {rows} b ON {_ALIKE} AND a.source_index < b.source_index AND a.year <> b.year WHERE {on})"


REMOVALS = f"""{BLOCKS},
{later("linked", "comps", "component", False)},
{later("literal", "weak", "print", True)},
r12 AS (SELECT source_index, '{RULES[0]}' AS rule, refs, CAST(size AS VARCHAR) AS evidence FROM linked UNION ALL SELECT source_index, '{RULES[1]}', refs, 'identical' FROM literal),
active AS (SELECT * FROM strong ANTI JOIN r12 USING (source_index)),
fit AS (SELECT * FROM blocks WHERE state IN ('unresolved', 'split') AND days = 1 AND NOT collides AND latest_n >= most),
residual AS (SELECT *, row_number() OVER (PARTITION BY source_index ORDER BY len(found) DESC, found, ref) AS r FROM (
  SELECT * FROM ({_toward("active", "fit", f"a.source_index, b.source_index AS ref, k.place, k.day, k.id, k.state, {CONFLICT} AS conflict, {_SIGNALS} AS found")}) WHERE NOT conflict AND ({_EXACT} OR len(found) >= 2))),
r34 AS (SELECT source_index, CASE WHEN state = 'unresolved' THEN '{RULES[2]}' ELSE '{RULES[3]}' END AS rule, [ref] AS refs, array_to_string(found, ',') AS evidence FROM residual WHERE r = 1),
rest AS (SELECT * FROM blocks WHERE state = 'unresolved' AND (place, day, id) NOT IN (SELECT (place, day, id) FROM residual)),
left_strong AS (SELECT * FROM active ANTI JOIN r34 USING (source_index)),
facing AS ({_toward("left_strong", "rest", f"k.place, k.day, k.id, k.years, k.days, k.size, a.source_index AS early, a.bands AS early_bands, b.source_index AS late, b.bands AS late_bands, coalesce({STREET}, false) AS street, {_SITE} AS site")}),
chosen AS (SELECT place, day, id, CASE WHEN max(days) = 1 AND max(years) = 2 AND count(DISTINCT early) = 1 AND count(DISTINCT late) > 1 AND [{", ".join(f"sum(late_bands[{i}])" for i in range(1, 7))}] = max(early_bands) AND bool_and(street) THEN '{RULES[4]}'
  WHEN max(days) > 1 AND max(size) = max(years) AND bool_or(site) THEN '{RULES[5]}' END AS rule FROM facing GROUP BY ALL),
r56 AS (SELECT e.source_index, c.rule, (SELECT list(l.source_index ORDER BY l.source_index) FROM left_strong l WHERE l.place = e.place AND l.day = e.day AND l.id = e.id AND l.year = k.latest_year) AS refs,
  CASE WHEN c.rule = '{RULES[4]}' THEN 'category_aggregate,single_permit_date,street_family' ELSE 'reused_tracking_id,exact_valid_apn,exact_valid_coordinates' END AS evidence
  FROM left_strong e JOIN rest k USING (place, day, id) JOIN chosen c USING (place, day, id) WHERE c.rule IS NOT NULL AND e.year < k.latest_year),
left_weak AS (SELECT * FROM weak ANTI JOIN r12 USING (source_index)), projects AS (SELECT * FROM left_weak WHERE project NOT IN ({_PROJECTS})),
{_weak_edges("project_edges", "projects", f"CASE WHEN {BOTH} THEN {MATCH} IS NOT NULL ELSE {_PARCEL} END")}, {grown("project_comps", "projects", _WEAK, "project_edges")}, {later("by_project", "project_comps", "component", True)},
{_weak_edges("dual_edges", "left_weak", f"a.has_parcel AND b.has_parcel AND a.raw = b.raw AND {BOTH} AND {MATCH} IS NOT NULL")}, {grown("dual_comps", "left_weak", _WEAK, "dual_edges")}, {later("by_both", "dual_comps", "component", True)},
r789 AS (SELECT source_index, CASE WHEN d.source_index IS NULL THEN '{RULES[6]}' WHEN p.source_index IS NULL THEN '{RULES[7]}' ELSE '{RULES[8]}' END AS rule, list_sort(list_distinct(list_concat(coalesce(p.refs, []), coalesce(d.refs, [])))) AS refs FROM by_project p FULL JOIN by_both d USING (source_index)),
left_projects AS (SELECT * FROM projects ANTI JOIN r789 USING (source_index)),
single AS (SELECT place, day, project, bands, total, unit_category, tenure, max(year) AS latest_year FROM left_projects GROUP BY ALL HAVING count(*) > 1 AND count(*) = count(DISTINCT year)),
r10 AS (SELECT a.source_index, '{RULES[9]}' AS rule, [b.source_index] AS refs, 'house_number_moved_from_apn' AS evidence FROM left_projects a JOIN left_projects b ON {_ALIKE} JOIN single s ON a.place = s.place AND a.day = s.day AND a.project = s.project AND a.bands = s.bands AND a.total = s.total AND a.unit_category = s.unit_category AND a.tenure = s.tenure
  WHERE a.year < s.latest_year AND b.year = s.latest_year AND len(a.addrs) = 0 AND regexp_full_match(a.raw, '[0-9]{{1,6}}') AND b.has_parcel AND a.raw <> b.raw
  AND len(list_filter(b.streets, lambda s: len(s) >= 2 AND {_unpadded("s[1]")} = {_unpadded("a.raw")} AND list_contains(list_filter(a.streets, lambda o: len(o) > 0), s[2:]))) > 0),
removals AS (SELECT * FROM r12 UNION ALL SELECT * FROM r34 UNION ALL SELECT * FROM r56 UNION ALL SELECT source_index, rule, refs, rule FROM r789 UNION ALL SELECT * FROM r10)"""

DECISIONS = f"""WITH RECURSIVE {REMOVALS},
links AS (SELECT source_index AS node, unnest(refs) AS next FROM removals), reach AS (SELECT node, next AS final FROM links UNION SELECT r.node, l.next FROM reach r JOIN links l ON r.final = l.node),
lineage AS (SELECT node AS source_index, list(final ORDER BY final) AS retained, max(year) AS retained_report_year FROM reach JOIN prep ON final = source_index WHERE final NOT IN (SELECT source_index FROM removals) GROUP BY 1)
SELECT source_index, CASE WHEN rule IS NULL THEN 'retained' ELSE 'removed' END AS decision, rule, year AS report_year, retained_report_year, refs AS matched, retained, evidence FROM prep LEFT JOIN removals USING (source_index) LEFT JOIN lineage USING (source_index)"""

_CARRIED = ("place", "day", "bands", "total")
CARRIED = f"""WITH RECURSIVE {PREPARED},
dated AS (SELECT * FROM prep WHERE day IS NOT NULL), several AS (SELECT * FROM dated SEMI JOIN (SELECT place, day, bands, total FROM dated GROUP BY ALL HAVING count(DISTINCT year) > 1) USING (place, day, bands, total)),
carried_edges AS (SELECT DISTINCT a.place, a.day, a.bands, a.total, 0 AS kind, a.source_index AS a, b.source_index AS b FROM several a JOIN several b ON a.place = b.place AND a.day = b.day AND a.bands = b.bands AND a.total = b.total AND a.source_index < b.source_index AND a.year <> b.year
  WHERE {_PARCEL} OR ({BOTH} AND {MATCH} IS NOT NULL)),
{grown("carried_comps", "several", _CARRIED, "carried_edges", vetoed=False)}, {later("carried", "carried_comps", "component", True)},
direct AS (SELECT c.source_index, {_PARCEL} AS parcel, coalesce({BOTH} AND {MATCH} IS NOT NULL, false) AS matched, {BOTH} AS addressed, a.tracking <> '' AND b.tracking <> '' AND a.tracking <> b.tracking
  AND regexp_extract(upper(regexp_replace(a.tracking, '\\s+', '', 'g')), '^[A-Z]*') = regexp_extract(upper(regexp_replace(b.tracking, '\\s+', '', 'g')), '^[A-Z]*') AND regexp_replace(upper(regexp_replace(a.tracking, '\\s+', '', 'g')), '[0-9]', '9', 'g') = regexp_replace(upper(regexp_replace(b.tracking, '\\s+', '', 'g')), '[0-9]', '9', 'g') AS series
  FROM (SELECT source_index, unnest(refs) AS ref FROM carried WHERE len(refs) > 1) c JOIN several a ON c.source_index = a.source_index JOIN several b ON c.ref = b.source_index),
siblings AS (SELECT source_index FROM direct WHERE parcel OR matched GROUP BY 1 HAVING bool_and(addressed AND NOT matched AND series))
SELECT source_index, latest_year, refs FROM carried ANTI JOIN siblings USING (source_index)"""
