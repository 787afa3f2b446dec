"""Queries that run as streams over the tables, until all that is there has been taken in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.queries.registry import query
from snaploom.storage import is_folder, new_path, table
from snaploom.streaming import snapshots


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    reader = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    # a file source watches a folder: the table's own, or the one that its single file is in
    own = is_folder(spark, f"{sf_dir}/events.parquet")
    rows = reader.parquet(f"{sf_dir}/events.parquet") if own else reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    # the tables' times have no zone; event time needs one
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events WHERE ts IS NOT NULL GROUP BY ALL""")
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    counts = snapshots.window_counts(_events(spark, sf_dir).where("ts is not null"), "ts", ["event_type"], sums={"cents": cents})
    out = new_path(spark, "windows")
    flat = counts.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", "cents")
    snapshots.last_version(flat, out, new_path(spark, "progress")).awaitTermination()
    return spark.read.schema(flat.schema).parquet(out)


@query("""
SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""")
def stream_newest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "newest")
    events = _events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    q = snapshots.newest_rows(events, out, new_path(spark, "progress"), "user_id", "ts", "event_id")
    q.awaitTermination()
    last = q.lastProgress["batchId"] if q.lastProgress and q.lastProgress["numInputRows"] else 0
    return spark.read.schema(events.schema).parquet(f"{out}/version={last}").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""
SELECT DISTINCT user_id, event_type FROM events""")
def stream_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "distinct")
    once = snapshots.without_repeats(_events(spark, sf_dir), ["user_id", "event_type"], "ts", late="400 days").select("user_id", "event_type")
    once.writeStream.format("parquet").option("path", out).option("checkpointLocation", new_path(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(once.schema).parquet(out)
