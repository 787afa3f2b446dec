"""Planning periods and the policy of cycles: read strictly, corrected, overridden, counted.

What is wrong with a row is a column of reasons, so that one pass finds all of
it; ``required`` turns any reason into an error of the query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaploom.functions.scalars import calendar_day, is_count, let, strip

#: The first year that a cutoff may have.
FIRST_CUTOFF = 2018


def planning_period(c: Column) -> Column:
    """(start, end) of ``day-day`` text; null unless it has two parts, both days, in order. Days with dashes don't fit this form."""

    def read(parts: Column) -> Column:
        days = [calendar_day(F.try_element_at(parts, F.lit(i))) for i in (1, 2)]
        return F.when((F.size(parts) == 2) & (days[0] <= days[1]), F.struct(days[0].alias("start"), days[1].alias("end")))

    return let(F.split(strip(c), "-"), read)


def flag(c: Column) -> Column:
    """TRUE or FALSE, in any case; else null."""
    return let(F.upper(strip(c)), lambda t: F.when(t == "TRUE", F.lit(True)).when(t == "FALSE", F.lit(False)))


def cutoff_day(year: int) -> Column:
    if year < FIRST_CUTOFF:
        raise ValueError(f"a cutoff before {FIRST_CUTOFF}")
    return F.make_date(F.lit(year), F.lit(12), F.lit(31))


def periods(rows: DataFrame, key: str, period: str, started: str, counts: Sequence[str] = (), corrections: DataFrame | None = None) -> DataFrame:
    """(key, start, end, started, counts…, problems): every row, with what is wrong with it.

    ``corrections`` has (key, old, new) periods as text: such a key may come with
    either and gets the new one; any other period is a problem.
    """
    repeated = rows.groupBy(F.col(key).alias("repeated_key")).agg(F.count("*").alias("n"))
    told = rows.join(repeated, F.col(key).eqNullSafe(F.col("repeated_key")), "left")
    parsed = told.withColumn("read", planning_period(F.col(period)))
    if corrections is not None:
        told_new = corrections.select(F.col("key").alias("corrected_key"), planning_period(F.col("old")).alias("was"), planning_period(F.col("new")).alias("now"))
        parsed = parsed.join(told_new, F.col(key) == F.col("corrected_key"), "left")
        uncorrectable = F.col("now").isNotNull() & F.col("read").isNotNull() & (F.col("read") != F.col("was")) & (F.col("read") != F.col("now"))
        parsed = parsed.withColumn("uncorrectable", uncorrectable).withColumn("read", F.coalesce("now", "read"))
    else:
        parsed = parsed.withColumn("uncorrectable", F.lit(False))
    bad_counts = [F.when(~(is_count(F.col(c)) | (strip(F.coalesce(F.col(c), F.lit(""))) == "")), F.lit(f"not a count: {c}")) for c in counts]
    reasons = [
        F.when(F.coalesce(strip(F.col(key)), F.lit("")) == "", F.lit("no key")), F.when(F.col("n") > 1, F.lit("repeated key")), F.when(planning_period(F.col(period)).isNull(), F.lit("no period")),
        F.when(F.col("uncorrectable"), F.lit("neither the old nor the new period")), F.when(flag(F.col(started)).isNull(), F.lit("no flag")), *bad_counts,
    ]
    values = [F.regexp_replace(strip(F.col(c)), ",", "").try_cast("double").cast("bigint").alias(c) for c in counts]
    return parsed.select(F.col(key).alias("key"), F.col("read.start").alias("start"), F.col("read.end").alias("end"), flag(F.col(started)).alias("started"), *values, F.array_compact(F.array(*reasons)).alias("problems"))


def required(rows: DataFrame) -> DataFrame:
    """The rows without their problems; a row that has some is an error."""
    wrong = F.raise_error(F.concat(F.coalesce(F.col("key"), F.lit("?")), F.lit(": "), F.array_join("problems", ", ")))
    return rows.where(F.when(F.size("problems") > 0, wrong.cast("boolean")).otherwise(F.lit(True))).drop("problems")


def with_policy(dated: DataFrame, overrides: DataFrame) -> DataFrame:
    """(key, cycle, start, end, problem): periods by the policy, which overrides some of them and names their cycles.

    An override of a key that isn't there, or a second one of a key, is a problem of its own row.
    """
    n = overrides.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("cycle", "start", "end")).alias("new"))
    both = dated.select("key", F.struct("start", "end").alias("own")).join(n, "key", "full")
    problem = F.when(F.col("own").isNull(), "override of an unknown key").when(F.col("n") > 1, "several overrides of one key")
    return both.select("key", F.coalesce("new.cycle", F.lit(6)).alias("cycle"), F.coalesce("new.start", "own.start").alias("start"), F.coalesce("new.end", "own.end").alias("end"), problem.alias("problem"))


def cycle_counts(placed: DataFrame, expected: DataFrame) -> DataFrame:
    """(cycle, expected, actual) where the number of places of a cycle isn't the policy's."""
    actual = placed.where("problem is null").groupBy("cycle").agg(F.count("*").alias("actual"))
    both = expected.select("cycle", "expected").join(actual, "cycle", "full").na.fill(0, ["expected", "actual"])
    return both.select("cycle", F.col("expected").cast("bigint").alias("expected"), "actual", (F.col("expected") == F.col("actual")).alias("agrees"))
