"""Records of CSV files with line breaks inside quotes, read in splits of the files like any other text.

A line continues a record if an odd number of quotes comes before it. Each split
counts its quotes, the counts of the splits before it say whether it starts
inside a record, and a running sum within it does the rest; only one row for
each split is brought together. The pieces of a record, in one split or several,
then meet by the line it starts on.

Defined results: a last line without an end is a line; blank lines outside
quotes are records of one empty field; an open quote takes in all that follows
in its file, which ``strict_load`` then reports as one record with broken
quoting; an empty folder gives no records; line ends of two characters keep
their first one inside a record and lose it at its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, physical_line, raw_line): each record, the line of its file that it starts on (from 1), and its text."""
    meta = F.col("_metadata")
    lines = spark.read.text(path, lineSep="\n").select(meta["file_path"].alias("file"), meta["file_block_start"].alias("at"), F.monotonically_increasing_id().alias("nth"), "value")
    lines = lines.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    split = ["file", "at"]
    sums = lines.groupBy(*split).agg(F.sum("quotes").alias("quotes"), F.count("*").alias("n"))
    earlier = W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    begins = sums.select(*split, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("quotes", "n")])
    inside = W.partitionBy(*split).orderBy("nth")
    so_far = F.coalesce(F.sum("quotes").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(begins, split)
    placed = placed.withColumn("line", F.col("n_before") + F.row_number().over(inside)).withColumn("starts", (F.col("quotes_before") + so_far) % 2 == 0)
    placed = placed.withColumn("start", F.max(F.when(F.col("starts"), F.col("line"))).over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)))
    # where a split starts inside a record, the record started in the last split before it that starts any
    last = placed.groupBy(*split).agg(F.max("start").alias("last"))
    carried = last.select(*split, F.max("last").over(earlier).alias("carried"))
    whole = placed.join(carried, split).select("file", F.coalesce("start", "carried").alias("physical_line"), "line", "value")
    parts = whole.groupBy("file", "physical_line").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    return parts.select("file", "physical_line", F.regexp_replace(text, r"\r\z", "").alias("raw_line"))
