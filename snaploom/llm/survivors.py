"""Best representative of each duplicate group, field by field.

Every row offers a candidate for each field it fills in. Candidates are ranked
by window ordering: rows of the group's retained report year first, then the
latest report year, the latest load, and the smallest id. As only rank 1 is
kept, the engine limits each group on the map side before its shuffle, so a
group with a third of all rows sends one row per task and field.

Defined results: a null group is a group of its own; null years and times rank
last; null bands count as zero; fields filled in nowhere give no row; exact
copies of a row give one row; an empty table gives an empty result; only the
columns named in this module are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# fixed values: the six income bands, and texts that only say that a value is missing
BANDS = ("acutely_low", "extremely_low", "very_low", "low", "moderate", "above_moderate")
STAND_INS = (
    "N/A", "NA", "NONE", "NULL", "NIL", "NAN", "TBD", "TBA", "UNKNOWN", "UNK", "UNAVAILABLE", "MISSING", "BLANK", "EMPTY", "PENDING", "UNDEFINED", "UNSPECIFIED",
    "NOT AVAILABLE", "NOT APPLICABLE", "NOT KNOWN", "NOT PROVIDED", "NOT REPORTED", "NOT GIVEN", "NOT STATED", "NOT SPECIFIED", "NOT LISTED", "NO DATA", "NO VALUE", "TO BE DETERMINED", "SEE NOTES",
)
TEXTS = ("project_raw", "street_address", "tenure")
FIELDS = ("project_raw", "street_address", "permit_date", "tenure", "reported_total")


def filled_text(c: Column) -> Column:
    words = F.upper(F.regexp_replace(F.regexp_replace(c, r"(?U)[^\p{L}\p{N}/]+", " "), r"\A[ /]+|[ /]+\z", ""))
    return c.isNotNull() & c.rlike(r"[\p{L}\p{N}]") & ~words.isin(*STAND_INS)


def filled(field: str) -> Column:
    c = F.col(field)
    if field in TEXTS:
        return filled_text(c)
    if field == "permit_date":
        return c.isNotNull() & F.year(c).between(2000, 2030)
    bands = sum((F.coalesce(F.col(b), F.lit(0)) for b in BANDS), F.lit(0).cast("bigint"))
    return c.isNotNull() & (c == bands)


def choices(rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(dup_group, field_name, ledger_id): the row that supplies each field of each group."""
    offered = F.filter(F.array(*[F.when(F.coalesce(filled(f), F.lit(False)), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    offers = rows.select("dup_group", "ledger_id", "report_year", "loaded_at", F.explode(offered).alias("field_name"))
    retained = rows.groupBy(F.col("dup_group").alias("of_group")).agg(F.max("retained_report_year").alias("retained"))
    # first the best row of each report year, which needs no retained year; then the best year of the few that are left
    latest = [F.col("loaded_at").desc_nulls_last(), F.col("ledger_id").asc_nulls_last()]
    by_year = W.partitionBy("dup_group", "field_name", "report_year").orderBy(*latest)
    yearly = offers.withColumn("rank", F.row_number().over(by_year)).where("rank = 1").drop("rank")
    judged = yearly.join(retained, F.col("dup_group").eqNullSafe(F.col("of_group")), "left")
    trusted = F.coalesce(F.col("report_year") == F.col("retained"), F.lit(False))
    order = W.partitionBy("dup_group", "field_name").orderBy(trusted.desc(), F.col("report_year").desc_nulls_last(), *latest)
    return judged.withColumn("rank", F.row_number().over(order)).where("rank = 1").select("dup_group", "field_name", "ledger_id")


def survivors(rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One surviving record per group, each field from the row that ``choices`` names."""
    values = rows.select("ledger_id", F.col("dup_group").alias("of_group"), *fields).distinct()
    taken = choices(rows, fields).join(values.withColumnRenamed("ledger_id", "of_id"), (F.col("ledger_id") == F.col("of_id")) & F.col("dup_group").eqNullSafe(F.col("of_group")))
    aggs = [F.max(F.when(F.col("field_name") == f, F.col(f))).alias(f) for f in fields]
    groups = rows.select(F.col("dup_group").alias("any_group")).distinct()
    built = taken.groupBy("dup_group").agg(*aggs)
    return groups.join(built, F.col("any_group").eqNullSafe(F.col("dup_group")), "left").drop("dup_group").withColumnRenamed("any_group", "dup_group").select("dup_group", *fields)
