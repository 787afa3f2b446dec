"""Identifiers, parcel numbers, units and addresses of permit rows, as column expressions.

These keep the narrow notation of the snapshot rules: only ASCII letters and
digits count, and what follows a unit word is its value.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaploom.functions.scalars import let, squeeze, strip

# fixed values: identifiers, parcels and projects that say nothing
EMPTY_IDS = ("", "0", "ADU", "MULTIPLE", "NA", "NONE", "NULL", "SFR", "TBD", "UNKNOWN", "VARIOUS")
EMPTY_PARCELS = ("", "0", "NA", "NONE", "NULL", "TBD", "UNKNOWN", "NOTAVAILABLE", "NOTAPPLICABLE", "UNASSIGNED")
EMPTY_PROJECTS = (*EMPTY_IDS, "SINGLEFAMILY", "SINGLEFAMILYRESIDENCE")
# fixed values: words of addresses and what they are written as
WORDS = {
    "NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W", "NORTHEAST": "NE", "NORTHWEST": "NW", "SOUTHEAST": "SE", "SOUTHWEST": "SW",
    "STREET": "ST", "STR": "ST", "AVENUE": "AVE", "AV": "AVE", "ROAD": "RD", "DRIVE": "DR", "DRV": "DR", "LANE": "LN", "COURT": "CT", "PLACE": "PL", "BOULEVARD": "BLVD",
    "HIGHWAY": "HWY", "PARKWAY": "PKWY", "TERRACE": "TER", "CIRCLE": "CIR", "TRAIL": "TRL", "PLAZA": "PLZ", "WY": "WAY", "SQUARE": "SQ",
}
SUFFIXES = ("ST", "AVE", "RD", "DR", "LN", "CT", "PL", "BLVD", "HWY", "PKWY", "TER", "CIR", "TRL", "PLZ", "WAY", "SQ", "LOOP")
UNIT_WORDS = {"UNIT": "UNIT", "APT": "UNIT", "APARTMENT": "UNIT", "SUITE": "UNIT", "STE": "UNIT", "LOT": "LOT", "BLDG": "BLDG", "BUILDING": "BLDG"}
# fixed values: how a unit is written
UNIT_VALUE = r"\b(UNIT|APT|APARTMENT|SUITE|STE|LOT|BLDG|BUILDING)\s*:?[# ]*([A-Z0-9-]+)"
UNIT_MARK = r"(\b(UNIT|APT|APARTMENT|SUITE|STE|LOT|BLDG|BUILDING)\b|#)"


def without_accents(c: Column) -> Column:
    """Latin letters without their marks, in the JVM; the table follows from Unicode's own decompositions."""
    marked = [(chr(p), unicodedata.normalize("NFD", chr(p))[0]) for p in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if len(unicodedata.normalize("NFD", chr(p))) > 1]
    loose = "".join(chr(p) for p in range(0x300, 0x370))  # marks that stand by themselves go
    return F.translate(c, "".join(m for m, _ in marked) + loose, "".join(b for _, b in marked))


def capitals(c: Column) -> Column:
    return F.upper(strip(F.coalesce(c, F.lit(""))))


def key(c: Column) -> Column:
    """Capitals with runs of white space as one space."""
    return F.upper(squeeze(F.coalesce(c, F.lit(""))))


def compact(c: Column) -> Column:
    return F.regexp_replace(capitals(c), "[^A-Z0-9]", "")


def tracking_id(c: Column) -> Column:
    """A usable number, or empty."""
    return let(compact(c), lambda t: F.when((F.length(t) < 3) | t.isin(*EMPTY_IDS), F.lit("")).otherwise(t))


def project_key(c: Column) -> Column:
    return compact(c)


def is_project(c: Column) -> Column:
    return ~c.isin(*EMPTY_PROJECTS)


def unpadded(c: Column) -> Column:
    """Without zeros in front; nothing but zeros is one zero."""
    return F.regexp_replace(c, r"^0+(?=.)", "")


def parcel_raw(c: Column) -> Column:
    return let(compact(c), lambda t: F.when(t.isin(*EMPTY_PARCELS), F.lit("")).otherwise(t))


def parcel_formatted(raw: Column) -> Column:
    """Runs of letters and of digits joined by bars, digits without zeros in front."""
    parts = F.regexp_extract_all(raw, F.lit("([A-Z]+|[0-9]+)"), 1)
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[0-9]"), F.regexp_replace(p, "^0+(?=[0-9])", "")).otherwise(p)), "|")


def is_parcel(raw: Column) -> Column:
    """Neither empty, nor a number in exponent notation, nor one digit over and over."""
    return (raw != "") & ~raw.rlike(r"^[0-9]+E[+-]?[0-9]+$") & ~raw.rlike(r"^([0-9])\1*$")


def coordinates(latitude: Column, longitude: Column) -> Column:
    """(north, east) within the region, or null; only plain decimal numbers count."""
    plain = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    number = [F.when(strip(c).rlike(plain), strip(c).try_cast("double")) for c in (latitude, longitude)]
    return let(F.struct(number[0].alias("north"), number[1].alias("east")), lambda p: F.when(p["north"].between(32.0, 42.1) & p["east"].between(-125.0, -114.0), p))


def units(street: Column, standard: Column) -> Column:
    """Sorted ``TYPE value`` of the unit words in both addresses, read as one text."""
    both = capitals(F.concat_ws(" ", F.coalesce(street, F.lit("")), F.coalesce(standard, F.lit(""))))
    kinds = F.create_map(*[F.lit(x) for pair in UNIT_WORDS.items() for x in pair])

    def pairs(text: Column) -> Column:
        words, values = (F.regexp_extract_all(text, F.lit(UNIT_VALUE), i) for i in (1, 2))
        return F.array_sort(F.array_distinct(F.zip_with(words, values, lambda w, v: F.concat_ws(" ", kinds[w], unpadded(v)))))

    return let(both, pairs)


def street_tokens(c: Column) -> Column:
    """Tokens of the first line up to a comma or a unit word, in short notation."""
    words = F.create_map(*[F.lit(x) for pair in WORDS.items() for x in pair])
    line = F.substring_index(F.substring_index(F.regexp_replace(capitals(c), "\r", "\n"), "\n", 1), ",", 1)
    head = F.regexp_replace(line, f"(?s){UNIT_MARK}.*$", "")
    return F.transform(F.regexp_extract_all(head, F.lit("([A-Z0-9]+)"), 1), lambda t: F.coalesce(words[t], t))


def address(c: Column, base_units: Column) -> Column:
    """(house, street, units) or null. A last letter or short number after a suffix is a unit."""

    def build(t: Column) -> Column:
        n = F.size(t)
        tail = (n >= 3) & F.coalesce(F.try_element_at(t, F.lit(-2)).isin(*SUFFIXES), F.lit(False)) & F.coalesce(F.try_element_at(t, F.lit(-1)).rlike(r"^([A-Z]|[0-9]{1,4})$"), F.lit(False))
        own = F.when(tail, F.array(F.concat(F.lit("UNIT "), unpadded(F.try_element_at(t, F.lit(-1)))))).otherwise(F.array().cast("array<string>"))
        street = F.when(tail, F.slice(t, 2, F.greatest(n - 2, F.lit(0)))).otherwise(F.slice(t, 2, F.greatest(n - 1, F.lit(0))))
        usable = (n >= 2) & F.coalesce(F.try_element_at(t, F.lit(1)).rlike("[0-9]"), F.lit(False))
        return F.when(usable, F.struct(F.try_element_at(t, F.lit(1)).alias("house"), F.array_join(street, " ").alias("street"), F.array_sort(F.array_union(base_units, own)).alias("units")))

    return let(street_tokens(c), build)


def addresses(street: Column, standard: Column) -> Column:
    """Distinct addresses of both fields, sorted."""
    return let(units(street, standard), lambda u: F.array_sort(F.array_distinct(F.filter(F.array(address(street, u), address(standard, u)), lambda a: a.isNotNull()))))


def one_edit(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) >= 0


def _solid(a: Column) -> Column:
    return F.regexp_replace(a["street"], " ", "")


def address_match(left: Column, right: Column) -> Column:
    """0 for the same address, 1 for one edit in the street, null for none; the first hit counts."""

    def kind(x: Column, y: Column) -> Column:
        a, b = _solid(x), _solid(y)
        near = (F.least(F.length(a), F.length(b)) >= 4) & one_edit(a, b)
        return F.when((x["house"] == y["house"]) & (x["units"] == y["units"]), F.when(a == b, F.lit(0)).when(near, F.lit(1)))

    kinds = F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: kind(x, y))))
    return F.try_element_at(F.filter(kinds, lambda k: k.isNotNull()), F.lit(1))


def street_evidence(left: Column, right: Column) -> Column:
    def alike(x: Column, y: Column) -> Column:
        a, b = _solid(x), _solid(y)
        return (a == b) | ((F.least(F.length(a), F.length(b)) >= 5) & one_edit(a, b))

    return F.exists(left, lambda x: F.exists(right, lambda y: alike(x, y)))


def house_evidence(left: Column, right: Column) -> Column:
    return F.arrays_overlap(F.transform(left, lambda x: x["house"]), F.transform(right, lambda x: x["house"]))


def unit_conflict(left: Column, right: Column) -> Column:
    def every(a: Column) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.transform(a, lambda x: x["units"]))))

    return (F.size(every(left)) > 0) & (F.size(every(right)) > 0) & (every(left) != every(right))


def link_kind(left: Column, right: Column, left_raw: Column, right_raw: Column, left_formatted: Column, right_formatted: Column) -> Column:
    """Addresses decide where both rows have some; else equal parcels, as written (2) or without zeros (3)."""
    both = (F.size(left) > 0) & (F.size(right) > 0)
    return F.when(both, address_match(left, right)).when((left_raw != "") & (left_raw == right_raw), F.lit(2)).when((left_formatted != "") & (left_formatted == right_formatted), F.lit(3))


def tracking_shape(c: Column) -> Column:
    """Letters in front, and the whole with every digit as 9."""
    cleaned = F.upper(F.regexp_replace(c, r"\s+", ""))
    return F.struct(F.regexp_extract(cleaned, "^([A-Z]*)", 1).alias("prefix"), F.regexp_replace(cleaned, "[0-9]", "9").alias("pattern"))


def display_name(c: Column) -> Column:
    """Title case for names in capitals; a county's territory in brackets."""
    bare = squeeze(F.regexp_replace(c, r"(?i)\s*\(unincorporated[^)]*\)", ""))
    title = F.array_join(F.transform(F.regexp_extract_all(bare, F.lit("([A-Za-z]+|[^A-Za-z]+)"), 1), lambda p: F.initcap(p)), "")
    cased = F.when(bare == F.upper(bare), title).otherwise(bare)
    return F.regexp_replace(cased, r"(?i)\s+county$", " County (Unincorporated)")


def bare_key(c: Column) -> Column:
    """A displayed name without accents and without the ending that marks a county's territory, in capitals."""
    bare = F.regexp_replace(c, r"(?i)\s*([-(]\s*unincorporated\s*\)?)\s*$", "")
    return key(without_accents(bare))


def labels(c: Column, none: tuple[str, ...] = ("", "NONE", "NA", "N/A", "NO")) -> Column:
    """Distinct labels of a text separated by commas or semicolons, sorted; those that mean none left out."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), "[;,]"), key)
    return F.array_sort(F.array_distinct(F.filter(parts, lambda p: ~p.isin(*none))))
