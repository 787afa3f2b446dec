"""Queries of the training-data problems, over whole tables and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snaploom.llm import canonical, components, encoding, mixing, repeats, same_address, splitting, survivors
from snaploom.storage import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.typed_values(table(spark, sf_dir, "permit_records"), table(spark, sf_dir, "jurisdictions"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_address.same_location(table(spark, sf_dir, "address_records"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.choices(table(spark, sf_dir, "ledger_rows"))


def p4_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.survivors(table(spark, sf_dir, "ledger_rows"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.found_repeats(table(spark, sf_dir, "permit_records"), table(spark, sf_dir, "jurisdictions"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.audit_groups(table(spark, sf_dir, "dedup_audit"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.token_ids(table(spark, sf_dir, "documents"))


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of what each document's ids stand for, which is that of its text."""
    return encoding.texts_of(p8_ids(spark, sf_dir)).select("doc_id", F.md5("bytes").alias("digest"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each target: its different texts, the share due to it, and whether the mixture keeps the repeats and the share.

    The share is kept to a hundredth, or to its longest text where that is more, as texts are used whole.
    """
    shares = p9_shares(spark, sf_dir)
    whole = shares.agg(F.sum("mixed_tokens").alias("whole"), F.lit(1).alias("one"))
    shares = shares.where("target_share is not null").withColumn("one", F.lit(1)).join(whole, "one")
    off = F.abs(F.col("actual_share") - F.col("due_share"))
    on_target = (off <= 0.01) | (off * F.col("whole") <= F.col("longest_text"))
    return shares.select("source", "available_texts", F.round("due_share", 6).alias("due_share"), (F.col("most_uses") <= F.col("max_repeats")).alias("within_repeats"), on_target.alias("on_target"))


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.pieces(table(spark, sf_dir, "documents"), table(spark, sf_dir, "split_limits"))


def p10_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of each document's pieces put together without their overlaps, and how many exceed the limit.

    Of documents that have more words between blanks than their limit, and so more tokens.
    """
    limits = table(spark, sf_dir, "split_limits").select(F.col("source_name").alias("source"), "max_tokens")
    words = F.size(F.regexp_extract_all("text", F.lit("[^ ]+"), 0))
    long = table(spark, sf_dir, "documents").join(limits, "source").where(words > F.col("max_tokens")).select("doc_id", "max_tokens")
    each = p10_pieces(spark, sf_dir).join(long, "doc_id")
    before = F.lag("end_char", 1, 0).over(W.partitionBy("doc_id").orderBy("piece_no"))
    new = each.withColumn("new", F.substr("piece", before - F.col("start_char") + 1)).withColumn("over", (F.col("end_token") - F.col("start_token") > F.col("max_tokens")).cast("int"))
    return new.groupBy("doc_id").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "new"))), lambda p: p["new"]), "")).alias("digest"), F.sum("over").alias("over_limit"))


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p4_survivors": p4_survivors, "p6_found": p6_found, "p7_found": p7_found, "p8_ids": p8_ids, "p8_round_trip": p8_round_trip, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p9_checks": p9_checks, "p10_pieces": p10_pieces, "p10_rebuilt": p10_rebuilt}

_STAND_INS = ", ".join(f"'{x}'" for x in survivors.STAND_INS)
_BANDS = " + ".join(f"coalesce({b}, 0)" for b in survivors.BANDS)
_FILLED = {f: f"regexp_matches({f}, '[\\p{{L}}\\p{{N}}]') AND upper(regexp_replace(regexp_replace({f}, '[^\\p{{L}}\\p{{N}}/]+', ' ', 'g'), '^[ /]+|[ /]+$', '', 'g')) NOT IN ({_STAND_INS})" for f in survivors.TEXTS}
_FILLED |= {"permit_date": "year(permit_date) BETWEEN 2000 AND 2030", "reported_total": f"reported_total = {_BANDS}"}

_OFFERS = f"""r AS (SELECT *, max(retained_report_year) OVER (PARTITION BY dup_group) AS retained FROM ledger_rows), o AS ({" UNION ALL ".join(f"SELECT dup_group, '{f}' AS field_name, ledger_id, report_year, loaded_at, coalesce(report_year = retained, false) AS trusted FROM r WHERE {c}" for f, c in _FILLED.items())}),
c AS (SELECT dup_group, field_name, ledger_id FROM o QUALIFY row_number() OVER (PARTITION BY dup_group, field_name ORDER BY trusted DESC, report_year DESC NULLS LAST, loaded_at DESC NULLS LAST, ledger_id) = 1)"""

SQL: dict[str, str] = {
    "p4_survivors": f"""
WITH {_OFFERS}
SELECT g.dup_group, {", ".join(f"max(l.{f}) FILTER (c.field_name = '{f}') AS {f}" for f in survivors.FIELDS)} FROM (SELECT DISTINCT dup_group FROM ledger_rows) g LEFT JOIN c ON c.dup_group = g.dup_group LEFT JOIN ledger_rows l ON l.ledger_id = c.ledger_id GROUP BY 1""",
    "p4_found": f"WITH {_OFFERS} SELECT dup_group, field_name, ledger_id FROM c",
    "p8_round_trip": "SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents",
    "p9_checks": """
WITH t AS (SELECT source_name AS source, target_share, max_repeats FROM mix_targets), n AS (SELECT source, count(DISTINCT text) AS available_texts FROM documents WHERE text <> '' GROUP BY 1),
d AS (SELECT source, coalesce(available_texts, 0) AS available_texts, CASE WHEN available_texts > 0 AND max_repeats > 0 THEN target_share ELSE 0 END AS due FROM t LEFT JOIN n USING (source))
SELECT source, available_texts, round(due / sum(due) OVER (), 6) AS due_share, true AS within_repeats, true AS on_target FROM d""",
    "p10_rebuilt": """
SELECT doc_id, md5(text) AS digest, CAST(0 AS BIGINT) AS over_limit FROM documents JOIN split_limits ON source = source_name WHERE len(regexp_extract_all(text, '[^ ]+')) > max_tokens""",
    "p7_found": """
WITH RECURSIVE e AS (SELECT source_index AS a, unnest(list_concat(list_concat([source_index], coalesce(matched_source_indices, [])), coalesce(retained_source_indices, []))) AS b FROM dedup_audit),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS node, b AS reached FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.reached = u.a)
SELECT node AS source_index, min(reached) AS group_id FROM r GROUP BY 1""",
}
