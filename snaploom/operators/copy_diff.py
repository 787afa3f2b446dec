"""Differences between two copies of a keyed table of maps, field by field.

Each copy is first reduced to the newest row of a key, with partial aggregation
before the shuffle, so that a key with a third of all rows costs one row. The
reduced copies are range-partitioned together: one sampling gives both the same
split points. Within a partition the rows are sorted by key and side, and one
pass over the two interleaved streams merges them, emitting keys that one side
lacks and the fields that differ.

Defined results: null keys form one record, as any other key; a null map has no
values; of rows with equal newest time the one with the greatest normalised
content counts, and a null time is older than any other; an empty copy makes
all keys of the other ones missing; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaploom.functions.scalars import calendar_day, plain_number, squeeze, strip

# fixed values: how the fields of the two copies compare
COUNTS = ("vli", "li", "mi", "ami", "permit_total", "undated_permits")
DAYS = ("rhna_start", "rhna_end", "last_updated")


def normalised(fields: Column, counts: tuple[str, ...] = COUNTS, days: tuple[str, ...] = DAYS) -> Column:
    """JSON text of the map's filled values in comparable notation, in key order."""

    def value(k: Column, v: Column) -> Column:
        kept = F.when(k.isin(*counts), F.coalesce(plain_number(v), squeeze(v))).when(k.isin(*days), F.coalesce(calendar_day(v).cast("string"), squeeze(v))).otherwise(squeeze(v))
        return F.when(v.isNotNull() & (strip(v) != ""), kept)

    filled = F.filter(F.map_entries(F.transform_values(fields, value)), lambda e: e["value"].isNotNull())
    pairs = F.transform(F.array_sort(filled), lambda e: F.array(e["key"], e["value"]))
    return F.coalesce(F.to_json(pairs), F.lit("[]"))


def _newest(rows: DataFrame, key: str, fields: str, at: str, side: int) -> DataFrame:
    as_of = F.struct(F.col(at).isNotNull().alias("known"), F.col(at).alias("at"), normalised(F.col(fields)).alias("content"))
    return rows.groupBy(F.col(key).alias("key")).agg(F.max(as_of)["content"].alias("content")).select("key", F.lit(side).alias("side"), "content")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two-pointer merge of the sides, each sorted by key; rows come interleaved in key order."""
    names = ("expected", "desired")
    waiting: tuple | None = None  # the expected row whose counterpart hasn't come yet
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [[], [], []]
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["record_id", "field_name", "found_as"])
        out.clear()
        return batch

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            key, side, content = row
            if side == 0:
                if waiting:
                    out.append((waiting[0], "", "only_expected"))
                waiting = row
            elif waiting and waiting[0] == key:
                if waiting[2] != content:
                    a, b = dict(json.loads(waiting[2])), dict(json.loads(content))
                    out.extend((key, f, "differs") for f in sorted(a.keys() | b.keys()) if a.get(f) != b.get(f))
                waiting = None
            else:
                if waiting:
                    out.append((waiting[0], "", "only_expected"))
                    waiting = None
                out.append((key, "", f"only_{names[side]}"))
        yield flush()
    if waiting:
        out.append((waiting[0], "", "only_expected"))
    yield flush()


def differences(expected: DataFrame, desired: DataFrame, key: str = "record_id", at: str = "synced_at", expected_fields: str = "expected_fields", desired_fields: str = "desired_fields") -> DataFrame:
    """(record_id, field_name, found_as) of all differences between the newest rows of both copies."""
    both = _newest(expected, key, expected_fields, at, 0).unionAll(_newest(desired, key, desired_fields, at, 1))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("record_id", "field_name", "found_as")])
    # AQE never splits or merges partitions of a repartition by range with sorting inside in a way that parts equal keys
    ordered = both.repartitionByRange("key").sortWithinPartitions("key", "side")
    return ordered.mapInArrow(_merge, schema)
