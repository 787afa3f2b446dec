"""Rows of a compliance list: a fixed header, a folded unique name, a status of a known set, a cycle in words, a time as a day.

Every filled line gives a row, with what is wrong with it; lines of blanks and
separators only are skipped, and the header is one of the lines. The number of
rows is checked by ``within``, which is an error of the query if it is off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaploom.functions import identifiers as I
from snaploom.functions.scalars import calendar_day, let, strip
from snaploom.operators.strict_load import FIELD, _unquoted

# fixed values: the columns of the list, and how cycles are written
HEADER = ("Jurisdiction", "Cycle", "Status", "Updated")
CYCLE = r"(?i)^([5-7])(st|nd|rd|th)?( cycle)?$"


def compliance_rows(lines: DataFrame, line: str, statuses: dict[str, str], header: tuple[str, ...] = HEADER) -> DataFrame:
    """(key, cycle, status, updated, problems) of the lines but for the header; ``statuses`` maps what is written to what is meant."""
    whole = F.concat(F.lit(","), F.col(line))
    cells = F.transform(F.regexp_extract_all(whole, F.lit(f"({FIELD})"), 1), lambda x: strip(_unquoted(x)))
    filled = lines.where(F.regexp_replace(F.col(line), r"[\s,]", "") != "").select(cells.alias("c")).where(F.col("c") != F.array(*map(F.lit, header)))

    def cell(n: int) -> Column:
        return F.coalesce(F.try_element_at("c", F.lit(n)), F.lit(""))

    known = F.create_map(*[F.lit(x) for pair in statuses.items() for x in pair])
    day = let(cell(4), lambda t: calendar_day(F.regexp_extract(t, r"^(\S*)", 1)))
    rows = filled.select(I.bare_key(cell(1)).alias("key"), F.regexp_extract(cell(2), CYCLE, 1).try_cast("int").alias("cycle"), known[I.key(cell(3))].alias("status"), day.alias("updated"), F.size("c").alias("width"), cell(4).alias("written"))
    twice = rows.groupBy("key").agg(F.count("*").alias("n"))
    reasons = [F.when(F.col("width") != len(header), F.lit("columns")), F.when(F.col("key") == "", F.lit("no name")), F.when(F.col("n") > 1, F.lit("repeated name")), F.when(F.col("cycle").isNull(), F.lit("cycle")), F.when(F.col("status").isNull(), F.lit("status")), F.when((F.col("written") != "") & F.col("updated").isNull(), F.lit("updated"))]
    return rows.join(twice, "key").select("key", "cycle", "status", "updated", F.array_compact(F.array(*reasons)).alias("problems"))


def within(rows: DataFrame, least: int, most: int) -> DataFrame:
    """The rows, or an error if there are too few or too many."""
    n = rows.agg(F.count("*").alias("n"), F.lit(1).alias("one"))
    ok = F.when(F.col("n").between(least, most), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unlikely number of rows: "), F.col("n").cast("string"))).cast("boolean"))
    return rows.withColumn("one", F.lit(1)).join(n, "one").where(ok).drop("one", "n")
