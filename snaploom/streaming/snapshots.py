"""Snapshots that arrive as a stream: repeats dropped within a watermark, counts by window, and the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snaploom.operators.relational import best_match
from snaploom.storage import remove


def without_repeats(stream: DataFrame, keys: Sequence[str], at: str, late: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark; state of older keys is let go."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys))


def window_counts(stream: DataFrame, at: str, keys: Sequence[str], length: str = "1 hour", slide: str | None = None, late: str = "1 hour", sums: dict[str, Column] | None = None) -> DataFrame:
    """Counts and sums by window and key; a row that comes later than ``late`` behind the newest one may be left out once its window is given away."""
    w = F.window(at, length, slide) if slide else F.window(at, length)
    added = [F.sum(c).alias(n) for n, c in (sums or {}).items()]
    counts = stream.withWatermark(at, late).groupBy(w, *keys).agg(F.count("*").alias("n"), *added)
    return counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n", *(sums or {}))


def newest_rows(stream: DataFrame, path: str, checkpoint: str, key: str, at: str, tie: str) -> StreamingQuery:
    """Keeps the newest row of each key under ``path``, one version for each batch; running a batch again gives the same version.

    Only keys of the batch move from the previous version; the others are carried over as they are. The version before
    the previous one goes, as no batch that may be run again needs it.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        order = [F.col(at).desc_nulls_last(), F.col(tie).desc()]
        rows = batch
        if number > 0:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/version={number - 1}"))
        best_match(rows, key, order).write.mode("overwrite").parquet(f"{path}/version={number}")
        if number > 1:
            remove(spark, f"{path}/version={number - 2}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def last_version(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the whole result of an aggregation after each batch, the last one staying under ``path``."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
