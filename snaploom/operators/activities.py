"""Several activities of one wide record, selected in one pass over the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaploom.functions.scalars import calendar_day, is_count, let, strip


@dataclass(frozen=True)
class Activity:
    """Where an activity's day, total and band counts are among a record's fields (from 1)."""

    name: str
    day: int
    total: int
    bands: tuple[int, ...]


# fixed values: the three activities in the 69 columns of a Table A2 file
A2_ACTIVITIES = (
    Activity("entitlement", 22, 23, tuple(range(11, 22))),
    Activity("permit", 35, 36, tuple(range(24, 35))),
    Activity("completion", 48, 49, tuple(range(37, 48))),
)


def count_or_zero(c: Column) -> Column:
    """A strict count: blank is 0, and what isn't a count is null."""
    return let(strip(c), lambda t: F.when(t == "", F.lit(0)).when(is_count(t), F.regexp_replace(t, ",", "").try_cast("double")).cast("bigint"))


def activities(rows: DataFrame, key: str, values: str, specs: tuple[Activity, ...] = A2_ACTIVITIES) -> DataFrame:
    """(key, activity, day, total, band_units): one row for each record and activity, the records being read once."""
    v = F.col(values)

    def one(a: Activity) -> Column:
        units = F.aggregate(F.array(*[count_or_zero(v[i - 1]) for i in a.bands]), F.lit(0).cast("bigint"), lambda s, x: s + x)
        return F.struct(F.lit(a.name).alias("activity"), calendar_day(v[a.day - 1]).alias("day"), count_or_zero(v[a.total - 1]).alias("total"), units.alias("band_units"))

    return rows.select(key, F.explode(F.array(*[one(a) for a in specs])).alias("a")).select(key, "a.*")
