"""Deciding which address records denote the same location.

Records are read into parts once, and those read alike become one form. Forms
are sorted in four component orders: by number, unit and street; by number,
unit and street from its end; by parcel, number and unit; by number, unit and
street without a letter near its start, its end, or both. Within a window of
neighbours whose keys begin alike, forms are compared: number, unit and
jurisdiction strictly, the street with a few letters wrong, missing, doubled or
swapped, direction and type unless one of them is missing. A window holds every
neighbour that shares the beginning, so its size drops no pair; a window's
forms are distinct spellings at one number and unit, however many records
repeat them. Streets alike that share neither their first nor their last two
letters have an error at each end, or one at both in a short street; without
the letters in error they are equal, so the fourth order misses none. It takes
no street for another's misspelling that has other digits, or fewer than two
letters in common with it, as A and B, or 101 and 111, are streets of their own.

A form without direction or type may fit several places that contradict each
other. Its parcel then decides; without that it stays apart from all of them.
Links are consolidated into locations, and records without any address take the
location of their parcel, if that parcel has one location only.

Defined results: records with neither address nor parcel denote no location; a
null jurisdiction is one of its own; stand-ins (``TBD`` and the like) are no
address and no parcel; of records with the same id and content one counts; an
empty table gives no pairs; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaploom.llm import addresses
from snaploom.llm.canonical import edits
from snaploom.llm.components import components
from snaploom.storage import saved

PARTS = "address_id bigint, place string, house string, unit string, direction string, kind string, streets array<string>, parcel string"
#: Letters that the streets of one location may differ by: two records may each have one error.
MOST_EDITS = 2
#: An error that changes the first (or last) two letters of a street is among so many, in either spelling.
ENDS = 3
UNKNOWN = "?"


def read_parts(records: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, place, street, standard, parcel in zip(*(c.to_pylist() for c in batch.columns)):
                where = " ".join(addresses.place_tokens(place or ""))
                first, second = addresses.parse(street, place), addresses.parse(standard, place)
                if first is None or (second is not None and (first.house, first.unit) != (second.house, second.unit) and first.house is None):
                    first, second = second, first
                one = first or addresses.Address(None, None, "", None, None)
                two = second if second is not None and second.house == one.house else one
                streets = sorted({s for s in (one.street, two.street) if s})
                rows.append((key, where, one.house, one.unit or two.unit, one.direction or two.direction, one.kind or two.kind, streets, addresses.parcel(parcel)))
            cols = list(zip(*rows)) if rows else [[]] * 8
            types = [pa.int64(), *[pa.string()] * 5, pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in PARTS.split(", ")])

    kept = records.select(F.col("address_id").cast("bigint"), "jurisdiction_display", "street_address", "standard_address", "formatted_apn")
    return kept.mapInArrow(read, PARTS)


def _compatible(a: str | None, b: str | None) -> bool:
    return a is None or b is None or a == b


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between forms of a window, the rows being sorted by window and street."""
    window, held = None, []
    for batch in batches:
        out: list[tuple[int, int]] = []
        for at, _, street, form, direction, kind in zip(*(c.to_pylist() for c in batch.columns)):
            if at != window:
                window, held = at, []
            for other, form2, direction2, kind2 in held:
                if form != form2 and _compatible(direction, direction2) and _compatible(kind, kind2):
                    most = MOST_EDITS if min(len(street), len(other)) > 5 else 1
                    if street == other or edits(street, other, most) <= most:
                        out.append((min(form, form2), max(form, form2)))
            held.append((street, form, direction, kind))
        cols = list(zip(*out)) if out else [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])


def shortened(street: Column) -> Column:
    """The street, and without one of its first letters, one of its last ones, and one of both; what keeps two letters or more."""
    size = F.length(street)

    def without(i: int, j: int) -> Column:
        """Without the ``i``-th letter and the ``j``-th from the end, 0 being none; two only if two errors are allowed."""
        head = F.substring(street, 1, max(i - 1, 0))
        middle = F.substring(street, F.lit(i + 1), size - i - j)
        tail = F.right(street, F.lit(max(j - 1, 0)))
        return F.when(size > 5 if i and j else size >= max(i, j), F.concat(head, middle, tail))

    every = F.array(*[without(i, j) for i in range(ENDS + 1) for j in range(ENDS + 1)])
    return F.array_distinct(F.filter(every, lambda x: F.length(x) >= 2))


def links(forms: DataFrame) -> DataFrame:
    """(a, b): pairs of forms that the passes find alike."""
    street, sep = F.col("street"), F.lit("\x1f")
    number = [F.coalesce(F.col(c), F.lit("")) for c in ("place", "house", "unit")]
    back = F.reverse(street)
    passes = F.array(
        F.struct(F.concat_ws("\x1f", F.lit("1"), *number, F.substring(street, 1, 2)).alias("window"), street.alias("rest")),
        F.struct(F.concat_ws("\x1f", F.lit("2"), *number, F.substring(back, 1, 2)).alias("window"), back.alias("rest")),
        F.struct(F.when(F.col("parcel").isNotNull(), F.concat_ws("\x1f", F.lit("3"), number[0], F.concat(F.col("parcel"), sep), number[1], number[2])).alias("window"), street.alias("rest")),
    )
    each = forms.select("form", "direction", "kind", F.explode("streets").alias("street"), "place", "house", "unit", "parcel")
    near = F.transform(shortened(street), lambda x: F.struct(F.concat_ws("\x1f", F.lit("4"), *number, F.regexp_replace(street, "[^0-9]", ""), x).alias("window"), street.alias("rest")))
    keyed = each.select(F.explode(F.concat(passes, near)).alias("p"), "street", "form", "direction", "kind").select("p.window", "p.rest", "street", "form", "direction", "kind").where("window is not null")
    return keyed.repartitionByRange("window").sortWithinPartitions("window", "rest", "form").mapInArrow(_windows, "a bigint, b bigint").distinct()


def _effective(part: str) -> Column:
    """What a form's missing direction or type must be: that of all it is linked to, or of those on its parcel."""
    one = F.col(f"min_{part}") == F.col(f"max_{part}")
    one_here = F.col(f"min_{part}_here") == F.col(f"max_{part}_here")
    return F.coalesce(F.col(part), F.when(one, F.col(f"min_{part}")).when(one_here, F.col(f"min_{part}_here")).when(F.col(f"min_{part}").isNotNull(), F.lit(UNKNOWN)))


def consistent(pairs: DataFrame, forms: DataFrame) -> DataFrame:
    """The links whose ends don't take different directions or types from the rest of their links."""
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("form"), F.col("b").alias("other")), F.struct(F.col("b").alias("form"), F.col("a").alias("other")))).alias("e")).select("e.form", "e.other")
    about = forms.select(F.col("form").alias("other"), *[F.col(c).alias(f"other_{c}") for c in ("direction", "kind", "parcel")])
    own = forms.select("form", "direction", "kind", "parcel")
    here = F.col("parcel") == F.col("other_parcel")
    sums = [f(F.when(F.lit(True) if not suffix else here, F.col(f"other_{part}"))).alias(f"{name}_{part}{suffix}") for part in ("direction", "kind") for suffix in ("", "_here") for name, f in (("min", F.min), ("max", F.max))]
    seen = ends.join(about, "other").join(own, "form").groupBy("form", "direction", "kind").agg(*sums)
    settled = seen.select("form", _effective("direction").alias("direction"), _effective("kind").alias("kind"))
    a, b = (settled.select(F.col("form").alias(x), F.col("direction").alias(f"direction_{x}"), F.col("kind").alias(f"kind_{x}")) for x in "ab")
    fits = [F.col(f"{p}_a").isNull() | F.col(f"{p}_b").isNull() | (F.col(f"{p}_a") == F.col(f"{p}_b")) for p in ("direction", "kind")]
    return pairs.join(a, "a").join(b, "b").where(fits[0] & fits[1]).select("a", "b")


def locations(records: DataFrame) -> DataFrame:
    """(address_id, location): the location of every record that denotes one."""
    parts = saved(read_parts(records), "addresses")
    alike = ["place", "house", "unit", "direction", "kind", "streets", "parcel"]
    forms = saved(parts.where("size(streets) > 0").groupBy(*alike).agg(F.min("address_id").alias("form")), "forms")
    pairs = saved(links(forms), "links")
    linked = components(consistent(pairs, forms)).toDF("linked", "group_id")
    placed = forms.join(linked, F.col("form") == F.col("linked"), "left").select("form", *alike, F.coalesce("group_id", "form").alias("location"))
    placed = saved(placed, "placed")
    by_form = parts.alias("p").join(placed.alias("f"), [F.col(f"p.{c}").eqNullSafe(F.col(f"f.{c}")) for c in alike]).select("p.address_id", F.col("location").cast("string"))
    only = placed.where("parcel is not null").groupBy("place", "parcel").agg(F.min("location").alias("low"), F.max("location").alias("high"))
    bare = parts.where("size(streets) = 0 and parcel is not null").join(only, ["place", "parcel"], "left")
    by_parcel = bare.select("address_id", F.when(F.col("low") == F.col("high"), F.col("low").cast("string")).otherwise(F.concat_ws("\x1f", "place", "parcel")).alias("location"))
    return by_form.unionAll(by_parcel).distinct()


def same_location(records: DataFrame) -> DataFrame:
    """(address_id_a, address_id_b): every pair of records that denote one location."""
    at = saved(locations(records), "locations")
    a, b = at.select(F.col("address_id").alias("address_id_a"), "location"), at.select(F.col("address_id").alias("address_id_b"), "location")
    return a.join(b, "location").where("address_id_a < address_id_b").select("address_id_a", "address_id_b")
