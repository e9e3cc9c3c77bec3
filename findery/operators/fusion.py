"""Reciprocal-rank fusion, backfill from the documents of the first results, reranking, selection.

Defined results: a row with a null or empty ``chunk_id`` holds its rank in its list but is fused with
nothing; a chunk that one list has twice counts with both ranks; rows with a null ``question_id`` are
one question's; chunks without a document give no seed, those without a fact type fill nothing and
have no points; an unknown type of question needs no facts; empty lists and no questions give no rows.
Columns beside those named are kept by ``rerank`` and ``select_contexts`` and ignored elsewhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from findery.functions.taxonomy import POINT, metadata_priority, needed, safe_budget
from findery.functions.text import or_else

RRF_K = 60
SEED_ROWS, SEED_DOCS, PER_DOC = 10, 5, 2
MAX_CONTEXTS, MOST_CONTEXTS = 5, 8


def rrf(lists: list[DataFrame], k: int = RRF_K) -> DataFrame:
    """Lists of ``question_id, ord, chunk_id, rank, retriever`` -> ``question_id, ord, chunk_id, rrf_score, retrievers, rrf_rank``.

    One grouping by question and chunk; contributions are added in the order of the lists, so that a
    score doesn't depend on how rows are spread. Ties go by first list, then rank in it. Rows
    without a chunk id count in their list's ranks but not here.
    """
    every = reduce(DataFrame.unionByName, (x.select("question_id", "ord", "chunk_id", "rank", "retriever", F.lit(n).alias("list")) for n, x in enumerate(lists)))
    own = every.filter("chunk_id <> ''").groupBy("question_id", "chunk_id")
    part = F.struct("list", "rank", "ord")
    fused = own.agg(F.sort_array(F.collect_list(part)).alias("parts"), F.array_join(F.sort_array(F.collect_set("retriever")), ",").alias("retrievers"))
    score = F.aggregate("parts", F.lit(0.0), lambda s, p: s + 1 / (p["rank"] + k))
    fused = fused.withColumn("rrf_score", score).withColumn("ord", F.get("parts", F.lit(0))["ord"])
    order = W.partitionBy("question_id").orderBy(F.desc("rrf_score"), F.get("parts", F.lit(0))["list"], F.get("parts", F.lit(0))["rank"])
    return fused.withColumn("rrf_rank", F.row_number().over(order)).select("question_id", "ord", "chunk_id", "rrf_score", "retrievers", "rrf_rank")


def document_of(canonical: Column, plain: Column) -> Column:
    return or_else(canonical, plain)


def seeds(fused: DataFrame, facts: DataFrame) -> DataFrame:
    """``question_id, doc, seed``: the first documents of the first fused rows. ``facts`` has ``ord, doc``."""
    first = fused.filter(F.col("rrf_rank") <= SEED_ROWS).join(facts.select("ord", "doc"), "ord").filter("doc IS NOT NULL")
    docs = first.groupBy("question_id", "doc").agg(F.min("rrf_rank").alias("at"))
    return docs.withColumn("seed", F.row_number().over(W.partitionBy("question_id").orderBy("at"))).filter(F.col("seed") <= SEED_DOCS).drop("at")


def backfill(fused: DataFrame, questions: DataFrame, facts: DataFrame, per_doc: int = PER_DOC) -> DataFrame:
    """Of each seed document the first ``per_doc`` chunks with a fact that the question needs, in corpus order.

    ``questions``: ``question_id, qtype, issuers``; ``facts``: ``ord, chunk_id, issuer, doc, fact_type``, which no text comes with.
    """
    wanted = seeds(fused, facts).join(questions.select("question_id", "qtype", "issuers"), "question_id")
    found = facts.filter("doc IS NOT NULL AND fact_type IS NOT NULL").join(wanted, "doc")
    found = found.filter(F.array_contains("issuers", F.col("issuer")) & needed(F.col("qtype"), F.col("fact_type")))
    nth = F.row_number().over(W.partitionBy("question_id", "doc").orderBy("ord"))
    kept = found.withColumn("nth", nth).filter(F.col("nth") <= per_doc)
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("question_id").orderBy("ord")))
    return kept.select("question_id", "ord", "chunk_id", "rank", F.lit("ngram_doc_backfill").alias("retriever"))


def rerank(fused: DataFrame, questions: DataFrame, facts: DataFrame) -> DataFrame:
    """Adds ``metadata_priority, final_score, final_rank`` and the facts; ties keep the fused order."""
    rows = fused.join(questions.select("question_id", "qtype"), "question_id").join(facts.drop("chunk_id"), "ord")
    points = metadata_priority(F.col("qtype"), F.col("fact_type"), F.col("answer_policy"), F.col("budget_answer_enabled"))
    rows = rows.withColumn("metadata_priority", points).withColumn("final_score", F.col("rrf_score") + F.col("metadata_priority") * POINT)
    order = W.partitionBy("question_id").orderBy(F.desc("final_score"), "rrf_rank")
    return rows.withColumn("final_rank", F.row_number().over(order))


def context_limit(asked: Column) -> Column:
    """Null and 0 mean the default."""
    return F.greatest(F.lit(1), F.least(F.coalesce(F.nullif(asked, F.lit(0)), F.lit(MAX_CONTEXTS)), F.lit(MOST_CONTEXTS)))


def select_contexts(ranked: DataFrame, questions: DataFrame) -> DataFrame:
    """The first rows of each question up to its limit; of budget questions that have a safe row, safe rows alone. Adds ``safe, context_rank``."""
    rows = ranked.withColumn("safe", safe_budget(F.col("fact_type"), F.col("budget_answer_enabled")))
    own = W.partitionBy("question_id")
    rows = rows.withColumn("any_safe", F.max("safe").over(own)).filter((F.col("qtype") != "budget") | ~F.col("any_safe") | F.col("safe"))
    rows = rows.withColumn("context_rank", F.row_number().over(own.orderBy("final_rank")))
    limits = questions.select("question_id", context_limit(F.col("max_contexts")).alias("limit"))
    return rows.join(limits, "question_id").filter("context_rank <= limit").drop("limit", "any_safe")
