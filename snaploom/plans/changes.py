"""Plans of changes: routes, blockers, changed fields, gates, digests, and reuse of blank records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaploom.functions.scalars import calendar_day, is_count, strip
from snaploom.operators.relational import numbered
from snaploom.plans.sync import _changed_keys


def change_plan(target: DataFrame, source: DataFrame, key: str, counts: Sequence[str] = ()) -> DataFrame:
    """(key, route, changes, blockers): for every key of either side whether it may be written, and what.

    Both sides have (key, fields, n), ``n`` being how many rows stand for the key. A key that one side lacks or has
    several times is blocked, and so is one whose new counts aren't counts.
    """
    t, s = (df.select(key, F.struct("fields", "n").alias(x)) for df, x in ((target, "t"), (source, "s")))
    both = t.join(s, key, "full")
    before, after = F.col("t.fields"), F.col("s.fields")
    changed = F.array_sort(_changed_keys(before, after))
    changes = F.transform(changed, lambda k: F.struct(k.alias("field_name"), F.try_element_at(before, k).alias("before"), F.try_element_at(after, k).alias("after")))
    bad = [F.array_contains(changed, c) & ~F.coalesce(is_count(F.try_element_at(after, F.lit(c))), F.lit(True)) for c in counts]
    invalid = F.lit(False)
    for b in bad:
        invalid = invalid | b
    reasons = {"no target": F.col("t").isNull(), "no source": F.col("s").isNull(), "ambiguous target": F.col("t.n") > 1, "ambiguous source": F.col("s.n") > 1, "invalid value": invalid & F.col("t").isNotNull() & F.col("s").isNotNull()}
    blockers = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in reasons.items()]))
    there = F.col("t").isNotNull() & F.col("s").isNotNull()
    plan = both.select(key, F.when(there, changes).otherwise(F.array().cast("array<struct<field_name:string,before:string,after:string>>")).alias("changes"), blockers.alias("blockers"))
    route = F.when(F.size("blockers") > 0, "blocked").when(F.size("changes") > 0, "change").otherwise("unchanged")
    return plan.select(key, route.alias("route"), "changes", "blockers")


def updates(plan: DataFrame, key: str) -> DataFrame:
    """(key, field_name, expected, desired) of the records that may be written."""
    return plan.where("route = 'change'").select(key, F.explode("changes").alias("c")).select(key, "c.field_name", F.col("c.before").alias("expected"), F.col("c.after").alias("desired"))


def gates(plan: DataFrame) -> DataFrame:
    """One row: how many keys take each route, whether the plan may be applied, and whether it is complete without being."""
    n = {r: F.count_if(F.col("route") == r) for r in ("blocked", "change", "unchanged")}
    return plan.agg(*[c.alias(r) for r, c in n.items()], (n["blocked"] == 0).alias("eligible"), (n["blocked"] + n["change"] == 0).alias("complete"))


def plan_digest(plan: DataFrame, key: str) -> DataFrame:
    """(digest, n): a sum over the plan's rows, so that their order doesn't matter and no row is gathered."""
    each = F.array_join(F.transform("changes", lambda c: F.concat_ws("=", c["field_name"], F.coalesce(c["before"], F.lit("\x00")), F.coalesce(c["after"], F.lit("\x00")))), ";")
    return row_digest(plan.select(F.concat_ws("|", key, "route", each, F.array_join("blockers", ";")).alias("text")), "text")


def row_digest(rows: DataFrame, text: str) -> DataFrame:
    """(digest, n): the sum of the first 60 bits of the MD5 of each row's text."""
    number = F.conv(F.substring(F.md5(F.col(text)), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("digest"), F.count("*").alias("n"))


def verified(plan: DataFrame, key: str, digest: str) -> DataFrame:
    """The plan, or an error if it isn't the one that had this digest."""
    now = plan_digest(plan, key).select(F.col("digest").alias("now"), F.lit(1).alias("one"))
    same = F.when(F.col("now") == digest, F.lit(True)).otherwise(F.raise_error(F.lit("the plan has changed")).cast("boolean"))
    return plan.withColumn("one", F.lit(1)).join(now, "one").where(same).drop("one", "now")


def routed_cells(records: DataFrame, cells: DataFrame, identity: str, record: str) -> DataFrame:
    """(identity, record, route) of records and wanted cells.

    ``records`` has (record, identity, blank). A cell takes the record of its identity; missing cells reuse the blank
    records in order, and what is left is created. Records of no wanted cell are orphans, those of an identity that
    several have are repeated, and filled ones without an identity are unidentified.
    """
    named = records.where(F.col(identity).isNotNull())
    n = named.groupBy(identity).agg(F.count("*").alias("n"))
    wanted = cells.select(identity).distinct().withColumn("wanted", F.lit(True))
    held = named.join(n, identity).join(wanted, identity, "left")
    known = held.select(identity, record, F.when(F.col("n") > 1, "repeated").when(F.col("wanted").isNull(), "orphan").otherwise("matched").alias("route"))
    unknown = records.where(F.col(identity).isNull() & ~F.col("blank")).select(identity, record, F.lit("unidentified").alias("route"))
    missing = numbered(wanted.join(n, identity, "left_anti").select(identity), [identity])
    blanks = numbered(records.where(F.col(identity).isNull() & F.col("blank")).select(record), [record])
    fresh = missing.join(blanks, "position", "full").select(identity, record, F.when(F.col(identity).isNull(), "spare").when(F.col(record).isNull(), "create").otherwise("reuse").alias("route"))
    return known.unionByName(unknown).unionByName(fresh)


def typed_cells(rows: DataFrame, key: str, fields: str, counts: Sequence[str], days: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """A column of its type for each field of a map, and the names of those whose text isn't of the type."""

    def cell(f: str) -> Column:
        return F.nullif(strip(F.try_element_at(F.col(fields), F.lit(f))), F.lit(""))

    values = {f: F.when(is_count(cell(f)), F.regexp_replace(cell(f), ",", "").try_cast("double").cast("bigint")) for f in counts} | {f: calendar_day(cell(f)) for f in days}
    wrong = F.array_compact(F.array(*[F.when(cell(f).isNotNull() & v.isNull(), F.lit(f)) for f, v in values.items()]))
    return rows.select(key, *[v.alias(f) for f, v in values.items()], *[cell(f).alias(f) for f in texts], wrong.alias("problems"))
