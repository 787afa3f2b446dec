"""Exact pace arithmetic on whole numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pace(credited: Column, allocation: Column, start: Column, end: Column, through: Column) -> Column:
    """(elapsed_days, period_days, minimum_units, status): the units due by a day in proportion to the elapsed days.

    Elapsed days are held between none and the whole period, and the units are
    rounded up on integers, so that no fraction decides. A period without days
    gives null; without an allocation or a started period there is no judgment.
    """
    period = F.datediff(end, start).cast("bigint")
    elapsed = F.least(F.greatest(F.datediff(through, start), F.lit(0)), F.datediff(end, start)).cast("bigint")
    due = -F.floor(F.try_divide((-allocation * elapsed).cast("decimal(38,0)"), period.cast("decimal(18,0)"))).cast("bigint")
    status = F.when(allocation == 0, "no_allocation").when(elapsed == 0, "not_started").when(credited >= due, "on_pace").otherwise("behind_pace")
    return F.when(period > 0, F.struct(elapsed.alias("elapsed_days"), period.alias("period_days"), due.alias("minimum_units"), status.alias("status")))
