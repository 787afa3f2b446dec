"""Audit checks with one result schema: (domain, check, status, severity, objects_checked, failures, evidence).

A check is a table of objects with a condition that marks the failures. Counting
is one aggregate; the evidence is the first labels in order, which the planner
takes from each partition before the shuffle, so no failing rows are gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVIDENCE = 25


def check(objects: DataFrame, failed: str, label: str, domain: str, name: str, severity: str = "error") -> DataFrame:
    """One row: how many objects there are and fail, and the labels of the first failures."""
    marked = objects.selectExpr(f"coalesce({failed}, false) as failed", f"cast({label} as string) as label")
    counts = marked.agg(F.count("*").alias("objects_checked"), F.count_if("failed").alias("failures"))
    first = marked.where("failed and label is not null").select("label").distinct().orderBy("label").limit(EVIDENCE).agg(F.array_sort(F.collect_list("label")).alias("evidence"))
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    both = counts.withColumn("one", F.lit(1)).join(first.withColumn("one", F.lit(1)), "one")
    return both.select(F.lit(domain).alias("domain"), F.lit(name).alias("check"), status.alias("status"), F.lit(severity).alias("severity"), "objects_checked", "failures", "evidence")


def check_sql(objects: str, failed: str, label: str, domain: str, name: str, severity: str = "error") -> str:
    return f"""WITH o AS ({objects}), m AS (SELECT coalesce({failed}, false) AS failed, CAST({label} AS VARCHAR) AS label FROM o)
SELECT '{domain}' AS domain, '{name}' AS "check", CASE WHEN count(*) FILTER (failed) = 0 THEN 'pass' ELSE 'fail' END AS status, '{severity}' AS severity, count(*) AS objects_checked, count(*) FILTER (failed) AS failures,
  coalesce((SELECT list(label ORDER BY label) FROM (SELECT DISTINCT label FROM m WHERE failed AND label IS NOT NULL ORDER BY label LIMIT {EVIDENCE})), []) AS evidence FROM m"""


def report(checks: list[DataFrame]) -> DataFrame:
    """All checks in one table."""
    return reduce(DataFrame.unionByName, checks)


def summary(checks: DataFrame) -> DataFrame:
    """How many checks passed and failed, by severity."""
    return checks.groupBy("status", "severity").agg(F.count("*").alias("checks"), F.sum("failures").alias("failures"))
