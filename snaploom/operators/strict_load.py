"""Rows that fail to parse: a strict load, and what it leaves behind.

The load keeps only records that conform in full. Subtracting their offsets
from all offsets gives the remainder, and only the remainder is diagnosed. The
record grammar is one regular expression with possessive repeats, which the JVM
matches in a loop: neither long fields nor many quotes can exhaust its stack.

Defined results: a null record counts as an empty one (one empty field); a null
offset is kept as its own key; records repeated under one offset are judged one
by one; an empty table gives empty results; other columns are ignored and may
have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaploom.functions.scalars import calendar_day, is_count, let, strip

#: One field with its leading comma: quoted with doubled quotes inside, or bare and not starting with a quote.
FIELD = r',(?:"[^"]*+(?:""[^"]*+)*+"|[^",][^,]*+|)'


@dataclass(frozen=True)
class RecordShape:
    """What a conforming record has: its number of fields, and the positions (from 1) of typed ones."""

    fields: int
    date_at: int
    count_at: int


def _field(line: Column, at: int) -> Column:
    """The value of field ``at``, unquoted; ``line`` starts with a comma."""
    return let(F.regexp_extract(line, rf"\A(?:{FIELD}){{{at - 1}}}+({FIELD})", 1), _unquoted)


def _unquoted(x: Column) -> Column:
    """The value of a field that still has its leading comma."""
    inner = F.regexp_replace(F.regexp_replace(x, r'\A,"|"\z', ""), '""', '"')
    return F.when(x.startswith(',"'), inner).otherwise(F.substring(x, 2, 2**31 - 1))


def _checks(line: Column, shape: RecordShape) -> tuple[Column, Column, Column, Column]:
    quotes = line.rlike(rf"\A(?:{FIELD})++\z")
    width = line.rlike(rf"\A(?:{FIELD}){{{shape.fields}}}+\z")
    day = let(strip(_field(line, shape.date_at)), lambda v: (v == "") | calendar_day(v).isNotNull())
    count = let(strip(_field(line, shape.count_at)), lambda v: (v == "") | is_count(v))
    return quotes, width, day, count


def _lines(rows: DataFrame, offset: str, record: str) -> DataFrame:
    line = F.concat(F.lit(","), F.coalesce(F.col(record), F.lit("")))
    return rows.select(F.col(offset).alias("offset"), line.alias("line")).withColumn("print", F.xxhash64("line"))


def conforming(rows: DataFrame, shape: RecordShape, offset: str = "source_index", record: str = "raw_line") -> DataFrame:
    """(offset, line, print) of the records that a strict load accepts."""
    lines = _lines(rows, offset, record)
    _, width, day, count = _checks(F.col("line"), shape)
    return lines.where(F.when(width, day & count).otherwise(F.lit(False)))


def load(rows: DataFrame, shape: RecordShape, offset: str = "source_index", record: str = "raw_line") -> DataFrame:
    """(offset, raw_values, permit_date, reported_total) of the conforming records."""
    good, line = conforming(rows, shape, offset, record), F.col("line")
    values = F.transform(F.regexp_extract_all(line, F.lit(f"({FIELD})"), 1), _unquoted)
    total = F.regexp_replace(strip(_field(line, shape.count_at)), ",", "")
    return good.select(
        F.col("offset").alias(offset),
        values.alias("raw_values"),
        calendar_day(_field(line, shape.date_at)).alias("permit_date"),
        F.coalesce(total.try_cast("decimal(38,6)"), total.try_cast("double")).try_cast("bigint").alias("reported_total"),
    )


def rejected(rows: DataFrame, shape: RecordShape, offset: str = "source_index", record: str = "raw_line") -> DataFrame:
    """(offset, reason): one row for each failing record and reason.

    Offsets of the strict load are subtracted from all offsets, without the
    records' text; the text is fetched again only for what remains.
    """
    lines, key = _lines(rows, offset, record), ["offset", "print"]
    good = conforming(rows, shape, offset, record).select(*[F.col(k).alias(f"good_{k}") for k in key])
    same = F.col("offset").eqNullSafe(F.col("good_offset")) & (F.col("print") == F.col("good_print"))
    rest = lines.select(*key).join(good, same, "left_anti").select(*[F.col(k).alias(f"rest_{k}") for k in key]).distinct()
    again = F.col("offset").eqNullSafe(F.col("rest_offset")) & (F.col("print") == F.col("rest_print"))
    bad = lines.join(rest, again, "left_semi")
    quotes, width, day, count = _checks(F.col("line"), shape)
    reasons = F.when(~quotes, F.array(F.lit("quoting"))).when(~width, F.array(F.lit("column_count"))).otherwise(
        F.filter(F.array(F.when(~day, F.lit("permit_date")), F.when(~count, F.lit("reported_total"))), lambda x: x.isNotNull())
    )
    return bad.select(F.col("offset").alias(offset), F.explode(reasons).alias("reason"))
