"""Mixing sources to target shares of all tokens.

The largest mixture is built in which every source can have its share, no text
being used more often than its source allows. It is cut into blocks of equal
tokens, and the blocks go to the sources by Sainte-Lague's highest quotients.
Each source is spread over shards by a seeded hash, one for ``SHARD_TOKENS`` of
its tokens however many that makes, so that a source with a third of all texts is no single task.
Its blocks, cut small enough for shards, go to its shards by the highest
quotients of the tokens that each holds; what a shard can't hold goes to the others, to the token. A shard then takes
whole texts in seeded order up to its quota; no prefix sum over texts spans more than a
shard. Only totals by source reach the driver.

Defined results: a text that a source repeats counts as one text, represented
by its smallest doc_id, and is never used more than ``max_repeats`` times; null
and empty texts have no tokens and aren't used; sources without a target, or
with a share or max_repeats that is null or not above zero, aren't used; targets
without texts get nothing, and the others share in proportion; repeated targets
of one source count once; an empty table gives an empty mixture.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snaploom.llm.encoding import TOKENIZERS, token_counts
from snaploom.storage import saved

BLOCKS = 10_000
SHARD_TOKENS = 5_000_000
#: Blocks that a shard is cut into at least.
SHARD_BLOCKS = 1000
MOST_TARGETS = 10_000
SEED = 20_251


def highest_quotients(weights: list[float], seats: int, caps: list[int] | None = None) -> list[int]:
    """Seats of each weight by Sainte-Lague's method; ties go to the earlier weight; no more than its cap to any.

    Most seats follow from the proportions, less a few for each weight; only the rest is handed out one by one.
    """
    caps = caps if caps is not None else [seats] * len(weights)
    whole = sum(w for w, c in zip(weights, caps) if c > 0)
    given = [0] * len(weights)
    if whole <= 0:
        return given
    if all(c >= seats * w / whole + 1 for w, c in zip(weights, caps) if w > 0):
        # a weight gets at least its proportion less one half of the number of weights, as the divisor is off by no more
        spare = len(weights) / 2 + 1
        given = [max(0, int(seats * w / whole - spare)) for w in weights]
    queue = [(-(w / (2 * g + 1)), i) for i, (w, g) in enumerate(zip(weights, given)) if w > 0 and g < caps[i]]
    heapq.heapify(queue)
    for _ in range(seats - sum(given)):
        if not queue:
            break
        _, i = heapq.heappop(queue)
        given[i] += 1
        if given[i] < caps[i]:
            heapq.heappush(queue, (-(weights[i] / (2 * given[i] + 1)), i))
    return given


def distinct_texts(documents: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, source, n_tokens) of each different text of each source, the smallest doc_id standing for all."""
    with_print = documents.select("doc_id", "source", F.sha2("text", 256).alias("print"), "text").where("source is not null and text is not null and text <> ''")
    counted = token_counts(with_print, ["doc_id", "source", "print"], tokenizers=tokenizers)
    return counted.groupBy("source", "print").agg(F.min("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens")).select("doc_id", "source", "n_tokens")


def shard_quotas(totals: DataFrame, rests: DataFrame) -> DataFrame:
    """(of_source, of_shard, rounds, quota): each source's rest of tokens, apportioned to its shards.

    ``totals`` has (source, shard, held); ``rests`` has (of_source, rounds, rest, block), a rest being at most what
    the source holds. Every shard gets the blocks that its proportion gives for certain, and the highest next quotients
    get one more each; tokens that would exceed a shard's own go to the others.
    """
    of = W.partitionBy("source")
    seats = F.floor(F.col("rest") / F.col("block"))
    each = totals.join(rests, F.col("source") == F.col("of_source"))
    each = each.withColumn("sure", F.least(F.expr("cast(rest div block as decimal(19, 0)) * cast(held as decimal(19, 0)) div sum(held) over (partition by source)"), F.expr("held div block")))
    each = each.withColumn("open", seats - F.sum("sure").over(of)).withColumn("fits", F.expr("(sure + 1) * block <= held"))
    next_quotient = F.col("held") / (2 * F.col("sure") + 1)
    turn = F.row_number().over(of.orderBy(F.col("fits").desc(), next_quotient.desc(), "shard"))
    each = each.withColumn("turn", turn).withColumn("whole", F.expr("(sure + int(fits and turn <= open)) * block"))
    each = each.withColumn("short", F.col("rest") - F.sum("whole").over(of)).withColumn("spare", F.col("held") - F.col("whole"))
    before = F.coalesce(F.sum("spare").over(of.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    quota = F.col("whole") + F.least(F.col("spare"), F.greatest(F.lit(0), F.col("short") - before))
    return each.select("of_source", F.col("shard").alias("of_shard"), "rounds", quota.cast("bigint").alias("quota"))


def mixture(documents: DataFrame, targets: DataFrame, blocks: int = BLOCKS, seed: int = SEED, tokenizers: str = TOKENIZERS, shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, DataFrame]:
    """The mixture (doc_id, source, n_tokens, uses), and the report of shares by source."""
    spark = documents.sparkSession
    texts = saved(distinct_texts(documents, tokenizers), "texts")
    wanted = targets.where("source_name is not null").groupBy("source_name").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("repeats")).limit(MOST_TARGETS + 1).collect()
    if len(wanted) > MOST_TARGETS:
        raise ValueError(f"over {MOST_TARGETS} targets")
    wanted = {r[0]: (r[1], r[2]) for r in wanted if (r[1] or 0) > 0 and (r[2] or 0) > 0}
    used = texts.where(F.col("source").isin(*sorted(wanted)) if wanted else F.lit(False))
    have = {r[0]: r[1] for r in used.groupBy("source").agg(F.sum("n_tokens")).collect() if r[1]}
    names = sorted(have)
    rests = []
    if names:
        share = {s: wanted[s][0] / sum(wanted[x][0] for x in names) for s in names}
        total = min(have[s] * wanted[s][1] / share[s] for s in names)
        block = max(1, int(total // blocks))
        seats = highest_quotients([share[s] for s in names], int(total // block), [have[s] * wanted[s][1] // block for s in names])
        for s, n in zip(names, seats):
            rounds, rest = divmod(n * block, have[s])
            if rounds >= wanted[s][1]:
                rounds, rest = wanted[s][1], 0
            rests.append((s, max(1, have[s] // shard_tokens), int(rounds), int(rest), max(1, min(block, shard_tokens // SHARD_BLOCKS))))
    rests = spark.createDataFrame(rests, "of_source string, shards bigint, rounds int, rest bigint, block bigint")
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("shards"))
    used = used.join(rests, F.col("source") == F.col("of_source")).select("doc_id", "source", "n_tokens", place.alias("shard"))
    quota = shard_quotas(used.groupBy("source", "shard").agg(F.sum("n_tokens").alias("held")), rests.drop("shards"))
    order = W.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = used.join(quota, (F.col("source") == F.col("of_source")) & (F.col("shard") == F.col("of_shard"))).withColumn("reach", F.sum("n_tokens").over(order))
    # whole texts while they fit; then the one other text that comes nearest to what is left of the quota
    shard = W.partitionBy("source", "shard")
    fits = F.col("reach") <= F.col("quota")
    left = F.col("quota") - F.coalesce(F.max(F.when(fits, F.col("reach"))).over(shard), F.lit(0))
    off = F.abs(F.col("n_tokens") - F.col("left"))
    placed = placed.withColumn("fits", fits).withColumn("left", left)
    placed = placed.withColumn("nearest", F.row_number().over(shard.orderBy(F.col("fits"), off, F.col("doc_id"))) == 1)
    taken = (F.col("fits") | (F.col("nearest") & (off < F.col("left")))).cast("int")
    mixed = placed.select("doc_id", "source", "n_tokens", (F.col("rounds") + taken).alias("uses")).where("uses > 0")
    return mixed, _report(mixed, texts, targets)


def _report(mixed: DataFrame, texts: DataFrame, targets: DataFrame) -> DataFrame:
    """What each source should and does contribute; ``due_share`` is its target among the sources that have texts."""
    goal = targets.where("source_name is not null").groupBy(F.col("source_name").alias("source")).agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    there = texts.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"), F.count("*").alias("available_texts"), F.max("n_tokens").alias("longest_text"))
    got = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("mixed_tokens"), F.max("uses").alias("most_uses"))
    joined = goal.join(there, "source", "full").join(got, "source", "left").na.fill(0, ["available_tokens", "available_texts", "longest_text", "mixed_tokens", "most_uses"])
    # one row for each source, so this is small
    every = W.partitionBy()
    due = F.when((F.col("target_share") > 0) & (F.col("max_repeats") > 0) & (F.col("available_tokens") > 0), F.col("target_share")).otherwise(0.0)
    shares = [F.coalesce(F.try_divide(c, F.sum(c).over(every)), F.lit(0.0)) for c in (F.col("due"), F.col("mixed_tokens"))]
    return joined.withColumn("due", due).withColumn("due_share", shares[0]).withColumn("actual_share", shares[1]).drop("due")
