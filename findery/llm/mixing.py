"""Mixing sources to target weights by Sainte-Laguë apportionment (DataFrame and SQL functions only).

Sources get targets by weight (a source never more than ``cap`` times its size, the excess goes to
the others by weight), the targets become integer numbers of equal-token blocks by highest
quotients, each source's blocks become quotas of its shards the same way, and every shard takes
its quota from its documents in a seeded order, laid end to end and repeated.

Defined results: a null or empty text has size 0 and nothing is taken from it; a null source is a
source of its own, after all others; null and repeated ids are told apart, and spread over shards, by
the hash of the text (or by size, where ``mix`` is given no text); rows equal in both are
interchangeable and share a shard; an empty table gives an empty result. Columns of the input beside
those named here are kept, but source_size, target and taken are replaced and names starting with
``_mix_`` dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from findery.scratch import materialize

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
CAP = 2
BLOCK = 64
SHARD_DOCS = 4096
SEED = 17


def n_words(text: Column) -> Column:
    """Number of runs of anything but space and \\t..\\r."""
    ended = F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "w")
    return F.coalesce(F.length(ended) - F.length(F.translate(ended, "w", "")), F.lit(0)).cast("long")


def seeded(doc_id: Column, other: Column, seed: int = SEED) -> Column:
    """A row's place in the order that reruns repeat: by its id and what else tells it from rows with the same id."""
    known = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    return F.md5(F.concat(F.lit(f"{seed}:"), known(doc_id), F.lit(":"), known(other)))


def shard_of(order: Column, shards: Column) -> Column:
    return F.conv(F.substring(order, 1, 8), 16, 10).cast("long") % shards


def fill_targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """``source, source_size`` -> also ``_mix_rank, _mix_weight, target``; one row per source, so the unpartitioned windows hold sources, never documents."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_mix_rank") - 1) % len(weights) + 1).cast("int"))
    everything = W.partitionBy()
    upward = W.orderBy("_mix_ratio", "_mix_rank")
    ranked = (
        sources.withColumn("_mix_rank", F.row_number().over(by_name))
        .withColumn("_mix_weight", weight.cast("long"))
        .withColumn("_mix_ratio", F.col("source_size") * cap / F.col("_mix_weight"))
        .withColumn("_mix_budget", F.sum("source_size").over(everything) * share[0] / share[1])
    )
    before = upward.rowsBetween(W.unboundedPreceding, -1)
    capped = F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))
    # Not a sum up to the end, for which Spark would go over all rows after each row.
    rest = F.sum("_mix_weight").over(everything) - F.coalesce(F.sum("_mix_weight").over(before), F.lit(0))
    level = ranked.withColumn("_mix_level", (F.col("_mix_budget") - capped) / rest)
    chosen = F.max(F.when(F.col("_mix_ratio") >= F.col("_mix_level"), F.col("_mix_level"))).over(everything)
    full = (F.col("source_size") * cap).cast("double")
    return level.withColumn("target", F.least(full, F.coalesce(chosen * F.col("_mix_weight"), full))).drop("_mix_ratio", "_mix_level")


def apportion(parties: DataFrame, group: list[str], party: list[str], votes: str, seats: str, out: str) -> DataFrame:
    """Sainte-Laguë: ``seats`` (equal within a group) by highest quotients votes / (2n - 1), ties to the smaller party.

    Rounding by the mean divisor is itself an apportionment of a near number of seats, so that
    only the seats by which it differs are given or taken by quotient. Rounding errs by half a seat for
    each of n parties at most, so the divisor has to change by n / 2 seats' share at most, and a party
    with x seats gains or loses no more than x * n / (2 * seats) of them and one: together 1.5 n.
    """
    w = W.partitionBy(*group)
    exact = F.when(F.sum(votes).over(w) > 0, F.col(votes) * F.col(seats) / F.sum(votes).over(w)).otherwise(F.lit(0.0))
    base = parties.withColumn("_mix_base", F.floor(exact + 0.5)).withColumn("_mix_any", F.sum(votes).over(w) > 0)
    base = base.withColumn("_mix_most", F.when(F.col(seats) > 0, F.floor(exact * F.count(F.lit(1)).over(w) / (2 * F.col(seats)))).otherwise(F.lit(0)) + 2)
    base = base.withColumn("_mix_gap", F.when(F.col("_mix_any"), F.col(seats) - F.sum("_mix_base").over(w)).otherwise(F.lit(0)))
    more, fewer = F.col("_mix_gap") > 0, F.col("_mix_gap") < 0
    steps = F.sequence(F.lit(1).cast("long"), F.least(F.abs("_mix_gap"), F.col("_mix_most")))
    one = base.filter(more | fewer).select("*", F.explode(steps).alias("_mix_step"))
    nth = F.when(more, F.col("_mix_base") + F.col("_mix_step")).otherwise(F.col("_mix_base") - F.col("_mix_step") + 1)
    one = one.withColumn("_mix_nth", nth).filter("_mix_nth >= 1").withColumn("_mix_quotient", F.col(votes) / (2 * F.col("_mix_nth") - 1))
    first = F.when(more, -F.col("_mix_quotient")).otherwise(F.col("_mix_quotient"))
    place = F.row_number().over(W.partitionBy(*group).orderBy(first, *party, "_mix_step"))
    keys = group + party
    moved = (
        one.withColumn("_mix_place", place)
        .filter(F.col("_mix_place") <= F.abs("_mix_gap"))
        .groupBy(*keys)
        .agg(F.sum(F.signum("_mix_gap")).cast("long").alias("_mix_moved"))
    )
    same = None
    for k in keys:
        c = base[k].eqNullSafe(moved[k])
        same = c if same is None else same & c
    joined = base.join(moved, same, "left").select(base["*"], moved["_mix_moved"])
    return joined.withColumn(out, F.col("_mix_base") + F.coalesce("_mix_moved", F.lit(0))).drop("_mix_base", "_mix_any", "_mix_most", "_mix_gap", "_mix_moved")


def quotas(sized: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP, block=BLOCK, shard_docs=SHARD_DOCS) -> DataFrame:
    """One row per shard: ``source, source_size, target, _mix_shards, _mix_shard, _mix_shard_size, _mix_take`` (tokens that the shard takes)."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_mix_docs"))
    targets = fill_targets(per_source, weights, share, cap).withColumn("_mix_seats", F.floor(F.col("_mix_budget") / block + 0.5))
    targets = targets.withColumn("_mix_all", F.lit(0))
    targets = apportion(targets, ["_mix_all"], ["_mix_rank"], "target", "_mix_seats", "_mix_blocks")
    targets = targets.withColumn("_mix_shards", F.ceil(F.col("_mix_docs") / shard_docs))
    targets = targets.select(F.col("source").alias("_mix_source"), "source_size", "target", "_mix_rank", "_mix_blocks", "_mix_shards")
    dealt = sized.join(targets, sized["source"].eqNullSafe(targets["_mix_source"])).withColumn("_mix_shard", shard_of(F.col("_mix_order"), F.col("_mix_shards")))
    shards = dealt.groupBy("_mix_rank", "_mix_shard").agg(
        F.sum("size").alias("_mix_shard_size"), *(F.first(c).alias(c) for c in ("_mix_source", "source_size", "target", "_mix_blocks", "_mix_shards"))
    )
    shards = apportion(shards, ["_mix_rank"], ["_mix_shard"], "_mix_shard_size", "_mix_blocks", "_mix_quota")
    return shards.withColumn("_mix_take", F.least(F.col("_mix_quota") * block, F.col("_mix_shard_size") * cap))


def mix(sized: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP, block=BLOCK, shard_docs=SHARD_DOCS, seed=SEED) -> DataFrame:
    """``sized`` holds ``doc_id, source, size`` and any other columns (``text`` or its MD5 as ``text_md5`` among them, if rows may share an id); adds ``source_size, target, taken``.

    A shard is a hash part of a source with about ``shard_docs`` documents, so that a source with a
    third of all rows is many windows. Within its shard, a document is taken ``taken / size`` times.
    """
    sized = sized.drop("source_size", "target", "taken")
    other = F.col("text_md5") if "text_md5" in sized.columns else F.md5("text") if "text" in sized.columns else F.col("size")
    ordered = sized.withColumn("_mix_order", seeded(F.col("doc_id"), other, seed))
    plan = quotas(ordered.select("source", "size", "_mix_order"), weights, share, cap, block, shard_docs)
    plan = materialize(plan.select("_mix_source", "source_size", "target", "_mix_shards", F.col("_mix_shard").alias("_mix_part"), "_mix_shard_size", "_mix_take"), "mix-quotas", exchanged=True)
    counts = plan.groupBy("_mix_source").agg(F.first("_mix_shards").alias("_mix_shards"))
    dealt = ordered.join(counts, ordered["source"].eqNullSafe(counts["_mix_source"])).drop("_mix_source")
    dealt = dealt.withColumn("_mix_shard", shard_of(F.col("_mix_order"), F.col("_mix_shards"))).drop("_mix_shards")
    same = dealt["source"].eqNullSafe(plan["_mix_source"]) & (dealt["_mix_shard"] == plan["_mix_part"])
    joined = dealt.join(plan.drop("_mix_shards"), same)
    before = W.partitionBy("_mix_source", "_mix_shard").orderBy("_mix_order", "size").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0))
    total, take = F.col("_mix_shard_size"), F.col("_mix_take")
    rounds = F.when(total > 0, F.floor(take / total)).otherwise(F.lit(0))
    left = take - F.col("_mix_rounds") * total
    out = joined.withColumn("_mix_start", start).withColumn("_mix_rounds", rounds)
    taken = F.col("_mix_rounds") * F.col("size") + F.least(F.greatest(left - F.col("_mix_start"), F.lit(0)), F.col("size"))
    out = out.withColumn("taken", taken.cast("long"))
    return out.drop(*(c for c in out.columns if c.startswith("_mix_")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.md5("text").alias("text_md5")), "mix-sizes")
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')) AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk, sum(source_size) OVER ()::DOUBLE * {SHARE[0]} / {SHARE[1]} AS budget FROM s),
w AS (SELECT *, ([{", ".join(map(str, WEIGHTS))}])[(rk - 1) % {len(WEIGHTS)} + 1]::BIGINT AS weight FROM r),
l AS (SELECT *, source_size * {CAP}::DOUBLE / weight AS ratio FROM w),
m AS (SELECT *, (budget - coalesce(sum(source_size * {CAP}) OVER (ORDER BY ratio, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY ratio, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM l),
t AS (SELECT *, least(source_size * {CAP}::DOUBLE, coalesce(max(CASE WHEN ratio >= lvl THEN lvl END) OVER () * weight, source_size * {CAP}::DOUBLE)) AS target,
         floor(budget / {BLOCK} + 0.5)::BIGINT AS seats FROM m),
q AS (SELECT *, CASE WHEN sum(target) OVER () > 0 THEN floor(target * seats / sum(target) OVER () + 0.5)::BIGINT ELSE 0 END AS base FROM t),
-- highest quotients over all seats near the rounded number
n AS (SELECT rk, base, seats, target, unnest(generate_series(greatest(base - 40, 0) + 1, base + 40)) AS nth FROM q),
a AS (SELECT rk, row_number() OVER (ORDER BY target / (2 * nth - 1) DESC, rk) AS place, seats - sum0 AS room
      FROM n, (SELECT sum(greatest(base - 40, 0)) AS sum0 FROM q)),
blocks AS (SELECT q.*, greatest(q.base - 40, 0) + coalesce(g.c, 0) AS blocks, ceil(docs / {SHARD_DOCS}.0)::BIGINT AS shards
      FROM q LEFT JOIN (SELECT rk, count(*) AS c FROM a WHERE place <= room GROUP BY rk) g USING (rk)),
ds AS (SELECT d.*, b.rk, b.source_size, b.target, b.blocks, ('0x' || substr(h, 1, 8))::BIGINT % b.shards AS shard
      FROM d JOIN blocks b ON d.source IS NOT DISTINCT FROM b.source),
sh AS (SELECT rk, shard, sum(size)::BIGINT AS shard_size, any_value(blocks) AS blocks FROM ds GROUP BY rk, shard),
sq AS (SELECT *, sum(shard_size) OVER (PARTITION BY rk) AS votes FROM sh),
sb AS (SELECT *, CASE WHEN votes > 0 THEN floor(shard_size::DOUBLE * blocks / votes + 0.5)::BIGINT ELSE 0 END AS base FROM sq),
sn AS (SELECT rk, shard, shard_size, unnest(generate_series(greatest(base - 40, 0) + 1, base + 40)) AS nth FROM sb),
so AS (SELECT rk, sum(greatest(base - 40, 0)) AS sum0 FROM sb GROUP BY rk),
sa AS (SELECT sn.rk, sn.shard, row_number() OVER (PARTITION BY sn.rk ORDER BY sn.shard_size::DOUBLE / (2 * nth - 1) DESC, sn.shard) AS place FROM sn),
sc AS (SELECT sa.rk, sa.shard, count(*) AS c FROM sa JOIN so USING (rk)
       JOIN (SELECT rk, any_value(blocks) AS blocks FROM sb GROUP BY rk) USING (rk) WHERE place <= blocks - sum0 GROUP BY sa.rk, sa.shard),
sf AS (SELECT sb.*, least((greatest(base - 40, 0) + coalesce(c, 0)) * {BLOCK}, shard_size * {CAP}) AS take FROM sb LEFT JOIN sc USING (rk, shard)),
p AS (SELECT ds.*, shard_size, take, coalesce(sum(size) OVER (PARTITION BY ds.rk, ds.shard ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM ds JOIN sf USING (rk, shard))
SELECT doc_id, size, source_size, target,
       (CASE WHEN shard_size > 0 THEN (take // shard_size) * size + least(greatest(take - (take // shard_size) * shard_size - start, 0), size) ELSE 0 END)::BIGINT AS taken
FROM p
"""
