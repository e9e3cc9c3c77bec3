"""From questions to retrieved, reranked and selected chunks, and to answers, as plans over tables.

``chunks``: ``ord, chunk_id, text, metadata`` (map), the hot metadata columns and ``embedding``;
``questions``: ``question_id, question, issuers, max_contexts, vector``.

Defined results: a question without a visible character, or without an issuer, is refused, as a form
would tell before sending it: it is searched for nothing and answered by its refusal, and the
questions beside it are answered; one that nothing is found for has an answer that says so; a null or 0
``max_contexts`` means the default; a null text is empty, null metadata has no facts; a dense search
that fails finds nothing (a warning and each answer's ``dense_error`` tell why), and the sparse one goes on alone, or,
asked not to (``alone``), the whole fails; no questions give no rows; other columns are ignored.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findery.functions.taxonomy import plainly_safe_budget
from findery.functions.text import question_type, strip
from findery.operators import answers, filters, fusion, neighbours, postings, retrieval
from findery.scratch import materialize
from findery.settings import Settings


#: As many ``ord`` as are sent to every task: 8 MB.
MOST_SENT = 1 << 20


@dataclass
class Retrieved:
    questions: DataFrame
    facts: DataFrame
    dense: DataFrame
    sparse: DataFrame
    initial: DataFrame
    backfill: DataFrame
    merged: DataFrame
    dense_error: str | None = None


def prepare(questions: DataFrame) -> DataFrame:
    """Cleans the issuers and adds ``qtype``; an error where a question has no issuer."""
    return questions.withColumn("issuers", filters.clean(F.col("issuers"))).withColumn("qtype", question_type(F.col("question")))


def accepted(questions: DataFrame) -> DataFrame:
    """The questions that can be asked, prepared. (Without ``clean``, whose error a filter that Spark moves could meet first.)"""
    own = judged(questions).filter("refusal IS NULL").drop("refusal")
    return own.withColumn("issuers", filters.cleaned(F.col("issuers"))).withColumn("qtype", question_type(F.col("question")))


def judged(questions: DataFrame) -> DataFrame:
    """Adds ``refusal``: why a question can't be asked, null where it can."""
    blank = F.length(strip(F.coalesce("question", F.lit("")))) == 0
    nobody = F.coalesce(F.size(filters.cleaned(F.col("issuers"))), F.lit(0)) < 1
    return questions.withColumn("refusal", F.when(blank, "a question is required").when(nobody, "an issuer is required"))


def facts_of(chunks: DataFrame) -> DataFrame:
    """What fusing and reranking need of a chunk, without its text."""
    doc = fusion.document_of(F.col("canonical_doc_id"), F.col("doc_id"))
    return chunks.select("ord", "chunk_id", "issuer", doc.alias("doc"), "fact_type", "answer_policy", "budget_answer_enabled")


def _reason(e: Exception) -> str:
    """The beginning and the end of what an error says, without the frames between."""
    lines = "\n".join(x.strip() for x in str(e).splitlines() if x.strip() and not x.lstrip().startswith(("at ", "File ", "...")))
    return lines if len(lines) <= 600 else f"{lines[:200]} ... {lines[-400:]}"


def dense_or_none(chunks: DataFrame, asked: DataFrame, k: int, cells: neighbours.Cells | None = None, alone: bool = True) -> tuple[DataFrame, str | None]:
    """The dense results, written; where the search fails, an empty list and what went wrong, or, without ``alone``, the error itself."""
    try:
        return materialize(retrieval.dense_search(chunks, asked, k, cells), "dense", exchanged=True), None
    except (PySparkException, Py4JError) as e:
        if not alone:
            raise
        reason = _reason(e)
        warnings.warn(f"the dense search failed and is left out: {reason}", stacklevel=2)
        return materialize(retrieval.dense_search(chunks, asked.limit(0), k), "dense", exchanged=True), reason


def retrieve(chunks: DataFrame, questions: DataFrame, dense_k: int = retrieval.DENSE_K, sparse_k: int = retrieval.SPARSE_K, index: DataFrame | postings.Index | None = None, cells: neighbours.Cells | None = None, alone: bool = True) -> Retrieved:
    """Both searches, fused; documents of the first results filled in; fused again.

    The two result lists, k rows a question, and what is filled in are written once, as more than one
    step reads them. Questions that are refused (``judged``) are left out. ``index``:
    a version of ``postings`` or a written ``retrieval.sparse_index`` of the chunks, where there is one;
    ``cells``: of ``neighbours``. ``alone``: whether the sparse search goes on alone where the dense one
    fails, which ``dense_error`` then tells; callers whose rows have no place for that pass False, and fail.
    """
    asked = accepted(questions)
    facts = facts_of(chunks)
    dense, dense_error = dense_or_none(chunks, asked, dense_k, cells, alone)
    sparse = materialize(retrieval.sparse_search(chunks, asked, sparse_k, index), "sparse", exchanged=True)
    initial = fusion.rrf([dense, sparse])
    fills = materialize(fusion.backfill(initial, asked, facts), "fills", exchanged=True)
    return Retrieved(asked, facts, dense, sparse, initial, fills, fusion.rrf([dense, sparse, fills]), dense_error)


def select(chunks: DataFrame, found: Retrieved) -> tuple[DataFrame, DataFrame]:
    """(reranked rows, selected rows)."""
    merged = found.merged = materialize(found.merged, "merged", exchanged=True)
    ranked = materialize(fusion.rerank(merged, found.questions, only(found.facts, merged)), "ranked", exchanged=True)
    return ranked, fusion.select_contexts(ranked, found.questions)


def only(chunks: DataFrame, rows: DataFrame, most: int = MOST_SENT) -> DataFrame:
    """The chunks whose ``ord`` the written ``rows`` have.

    Up to ``most`` different ones (8 bytes each) are sent to every task, so that the corpus is filtered
    where it is read and nothing of it moves but what is asked for; more of them are joined (before which
    Spark filters the scan of a large corpus by a Bloom filter of its own).
    """
    wanted = rows.select("ord").distinct()
    few = wanted.limit(most + 1).count() <= most
    return chunks.join(F.broadcast(wanted) if few else wanted, "ord", "left_semi")


def with_texts(selected: DataFrame, chunks: DataFrame) -> DataFrame:
    """Selected rows with their texts and metadata; texts of other chunks stay where they are (``only``)."""
    rows = materialize(selected, "picked", exchanged=True)
    return rows.join(only(chunks.select("ord", "text", "metadata"), rows), "ord")


def response(selected: DataFrame) -> DataFrame:
    """What a caller gets of each context: ``question_id, rank, chunk_id, retriever, score, filename, metadata, text``."""
    return selected.select(
        "question_id", F.col("context_rank").alias("rank"), "chunk_id", F.col("retrievers").alias("retriever"),
        F.col("final_score").alias("score"), F.col("metadata")["source_file"].alias("filename"), "metadata", "text",
    )


def notice_rows(chunks: DataFrame) -> DataFrame:
    """``ord, issuer, project_name, source_file, numbers``: what lookups need of each record, without its text. To be kept (``versions``) where records are asked about more than once."""
    numbers = answers.notice_numbers(answers.candidate_text(F.col("chunk_id"), F.col("text"), F.col("metadata")))
    return chunks.select("ord", "issuer", "project_name", "source_file", numbers.alias("numbers"))


def lookups(chunks: DataFrame, found: Retrieved, ranked: DataFrame, selected: DataFrame, notices: DataFrame | None = None) -> DataFrame:
    """Notice numbers for budget questions without a safe row: from their results, else from all records of their issuers. With the hints' texts.

    ``notices``: of ``notice_rows``; without them every text of the issuers asked for is searched.
    """
    budget = found.questions.filter("qtype = 'budget'").select("question_id", "issuers")
    safe = selected.filter(plainly_safe_budget(F.col("fact_type"), F.col("budget_answer_enabled"))).select("question_id").distinct()
    need = budget.join(safe, "question_id", "left_anti")
    fields = ("issuer", "project_name", "source_file")
    kept = chunks if notices is None else notices
    told = notice_rows if notices is None else (lambda rows: rows.select("ord", *fields, "numbers"))
    first = selected.select("question_id", "ord", F.col("context_rank").alias("at")).unionByName(ranked.select("question_id", "ord", (F.col("final_rank") + fusion.MOST_CONTEXTS).alias("at")))
    first = materialize(first.join(need.select("question_id"), "question_id"), "looked-up", exchanged=True)
    own = first.join(told(only(kept, first)), "ord")
    head = F.min_by(F.struct(*(F.coalesce(c, F.lit("")).alias(c) for c in fields)), "at").alias("head")
    flat = lambda rows: rows.select("question_id", "head.*")
    by_results = answers.notices(own, "at")
    # All records of an issuer: what is kept of each issuer is its first record and its first numbers, however many questions ask for it.
    rest = need.join(by_results.select("question_id").distinct(), "question_id", "left_anti").select("question_id", F.explode("issuers").alias("issuer"))
    records = told(kept.join(rest.select("issuer").distinct(), "issuer", "left_semi")).withColumnRenamed("ord", "at")
    by_issuer = answers.notices(records, "at", "issuer").drop("n")
    by_records = answers.first_notices(rest.join(by_issuer, "issuer"))
    heads = records.groupBy("issuer").agg(head, F.min("at").alias("at")).withColumnRenamed("issuer", "own_issuer")
    heads = rest.join(heads, F.col("issuer") == F.col("own_issuer")).groupBy("question_id").agg(F.min_by("head", "at").alias("head"))
    hints = answers.lookup_contexts(by_results.drop("first"), flat(own.groupBy("question_id").agg(head)))
    return hints.unionByName(answers.lookup_contexts(by_records.drop("first"), flat(heads)))


COUNTED = ("dense", "sparse", "backfill", "merged")


def counts(found: Retrieved) -> DataFrame:
    """``question_id`` and how many rows each list has for it: one grouping of all lists."""
    each = None
    for n, name in enumerate(COUNTED):
        rows = getattr(found, name).select("question_id", F.lit(n).alias("list"))
        each = rows if each is None else each.unionByName(rows)
    return each.groupBy("question_id").agg(*(F.count_if(F.col("list") == n).alias(f"{name}_count") for n, name in enumerate(COUNTED)))


def ask(chunks: DataFrame, questions: DataFrame, client: Callable | None = None, settings: Settings | None = None, index: DataFrame | postings.Index | None = None, cells: neighbours.Cells | None = None, ledger: str | None = None, notices: DataFrame | None = None, embedder: Callable | None = None, alone: bool = True) -> DataFrame:
    """``question_id, answer, issuers, question_type, route, contexts, lookups``, the counts of every step, ``generator_error``, ``dense_error``, ``status`` (answered or refused) and ``refusal``.

    Without a ``client``, as where it fails, answers are made of the contexts themselves. ``ledger``:
    a folder in which what the client says is kept (``answers.generate``). ``index, cells, notices``: of
    ``postings``, ``neighbours`` and ``notice_rows``, kept beside the chunks. ``embedder``: makes the
    questions' vectors (``answers.embed``), in place of those they come with; where it fails, so does
    the dense search. ``alone``: as of ``retrieve``.
    """
    limits = settings or Settings.of(chunks.sparkSession)
    asked = judged(questions).withColumn("max_contexts", F.coalesce(F.nullif("max_contexts", F.lit(0)), F.lit(limits.max_contexts)))
    good = asked.filter("refusal IS NULL").drop("refusal")
    told = _answers(chunks, answers.embed(good, embedder) if embedder else good, client, limits, index, cells, ledger, notices, alone).withColumns({"status": F.lit("answered"), "refusal": F.lit(None).cast("string")})
    known = {"question_id": F.col("question_id"), "issuers": F.coalesce(filters.cleaned(F.col("issuers")), F.array().cast("array<string>")), "route": F.array(F.lit("refused")), "answer": F.col("refusal"), "status": F.lit("refused"), "refusal": F.col("refusal")}
    zero = lambda f: F.lit(0 if f.name.endswith("_count") else None)
    refused = asked.filter("refusal IS NOT NULL").select(*(known.get(f.name, zero(f)).cast(f.dataType).alias(f.name) for f in told.schema))
    return told.unionByName(refused)


def _answers(chunks: DataFrame, asked: DataFrame, client: Callable | None, limits: Settings, index, cells, ledger: str | None, notices: DataFrame | None, alone: bool) -> DataFrame:
    found = retrieve(chunks, asked, limits.dense_k, limits.sparse_k, index, cells, alone)
    ranked, picked = select(chunks, found)
    rows = materialize(with_texts(picked, chunks), "selected")
    hints = materialize(lookups(chunks, found, ranked, rows, notices), "lookups", exchanged=True)
    plain = answers.fallback(found.questions, rows).withColumnRenamed("answer", "plain")
    context = answers.contexts(rows)
    prompts = found.questions.join(context, "question_id").select("question_id", F.format_string(answers.PROMPT, "question", "context").alias("prompt"))
    said = answers.generate(prompts, client, limits.answer_tokens, ledger) if client else prompts.select("question_id", F.lit(None).cast("string").alias("generated"), F.lit("RuntimeError: no generator").alias("error"))
    parts = F.struct("context_rank", "chunk_id", "retrievers", "final_score", F.col("metadata")["source_file"].alias("filename"), "metadata", "text")
    given = rows.groupBy("question_id").agg(F.array_sort(F.collect_list(parts), lambda a, b: a["context_rank"] - b["context_rank"]).alias("contexts"), F.count(F.lit(1)).alias("selected_count"))
    noted = hints.groupBy("question_id").agg(F.sort_array(F.collect_list(F.struct("n", "notice_number", "issuer", "project_name", "source_file", "g2b_url", "text"))).alias("lookups"))
    out = found.questions.join(plain, "question_id").join(said, "question_id", "left").join(given, "question_id", "left").join(noted, "question_id", "left")
    out = out.join(counts(found), "question_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    numbers = F.transform(F.col("lookups"), lambda x: x["notice_number"])
    steps = F.array(
        F.lit("issuer_filter"), F.lit("hybrid_dense_sparse"), F.when(F.col("backfill_count") > 0, "ngram_backfill"), F.lit("metadata_rerank"),
        F.when(F.col("qtype") == "budget", "budget_strict_selection").otherwise("context_selection"), F.when(F.size("lookups") > 0, "g2b_manual_lookup"),
        F.when(F.col("selected_count").isNull(), "no_context").when(F.col("generated").isNull(), "llm_fallback").otherwise("llm_answer"),
    )
    return out.select(
        "question_id", answers.with_lookup(F.coalesce("generated", "plain"), numbers).alias("answer"), "issuers", F.col("qtype").alias("question_type"),
        F.array_compact(steps).alias("route"), "contexts", "lookups", *map(zero, ("dense_count", "sparse_count", "backfill_count", "merged_count", "selected_count")),
        F.coalesce(F.size("lookups"), F.lit(0)).alias("lookup_count"), F.when(F.col("selected_count").isNotNull(), F.col("error")).alias("generator_error"),
        F.lit(found.dense_error).cast("string").alias("dense_error"),
    )
