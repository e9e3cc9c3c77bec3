"""The registered queries over the stand-in tables, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.functions import text as text_functions
from findery.functions.taxonomy import NEEDED, POINTS, metadata_priority
from findery.functions.text import norm_text, token_numbers
from findery.operators import answers, filters, fusion, neighbours, postings, retrieval
from findery.plans import hybrid, standins
from findery.scratch import spread
from findery.sources import eav, versions

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def eav_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = eav.records(*standins.eav(spark, sf_dir))
    return rows.select("ord", "chunk_id", F.md5("text").alias("text_md5"), "issuer", "canonical_doc_id", "doc_id", "fact_type", "answer_policy", "budget_answer_enabled", "source_file", F.size("metadata").alias("n_keys"))


def issuers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eav.issuers(standins.eav(spark, sf_dir)[1])


def issuer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that each question's issuers allow, by the sparse side's rule and by the dense side's aliases."""
    asked = hybrid.prepare(standins.questions(spark, sf_dir))
    per = standins.chunks(spark, sf_dir).groupBy("issuer").agg(F.count(F.lit(1)).alias("n"))
    count = lambda form, name: asked.select("question_id", F.explode(form).alias("issuer")).join(per, "issuer").groupBy("question_id").agg(F.sum("n").alias(name))
    return count(F.col("issuers"), "sparse_chunks").join(count(filters.aliases(F.col("issuers")), "dense_chunks"), "question_id")


def normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.md5(norm_text(F.col("text"))).alias("norm_md5"))


def _numbers(batches):
    """One text after another: a batch's tokens are some hundred times its text."""
    for b in batches:
        n, distinct = zip(*(token_numbers(t.as_py()) for t in b["text"]), strict=True) if len(b) else ((), ())
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n, pa.int64()), pa.array(distinct, pa.int64())], names=["doc_id", "n_tokens", "n_distinct"])


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_documents(spark, sf_dir).select("doc_id", "text")).mapInArrow(_numbers, "doc_id long, n_tokens long, n_distinct long")


def mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hangul put before every text, broken and repaired; and every text as it is, which nothing may change."""
    t = F.concat(F.lit("한국 "), F.coalesce("text", F.lit("")))
    rows = _documents(spark, sf_dir).select("doc_id", t.alias("t"), F.coalesce("text", F.lit("")).alias("own"))
    repaired = text_functions.repair_mojibake(text_functions.mojibake_alias(F.col("t")))
    return rows.select("doc_id", F.md5(repaired).alias("repaired_md5"), F.md5(text_functions.repair_mojibake(F.col("own"))).alias("own_md5"))


def question_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = hybrid.prepare(standins.questions(spark, sf_dir))
    return asked.select("question_id", "qtype", fusion.context_limit(F.col("max_contexts")).alias("contexts"))


def metadata_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of every chunk for every type of question."""
    types = F.explode(F.array(*(F.lit(t) for t in NEEDED))).alias("qtype")
    rows = standins.chunks(spark, sf_dir).select("ord", "fact_type", "answer_policy", "budget_answer_enabled", types)
    return rows.select("ord", "qtype", metadata_priority(F.col("qtype"), F.col("fact_type"), F.col("answer_policy"), F.col("budget_answer_enabled")).alias("points"))


def sparse_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = hybrid.prepare(standins.questions(spark, sf_dir))
    return retrieval.sparse_search(standins.chunks(spark, sf_dir), asked).drop("ord", "retriever")


def dense_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = hybrid.prepare(standins.questions(spark, sf_dir))
    return retrieval.dense_search(standins.chunks(spark, sf_dir), asked).select("question_id", "chunk_id", "similarity", "rank")


def sparse_search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sparse search off inverted postings."""
    chunks, asked = standins.chunks(spark, sf_dir), hybrid.prepare(standins.questions(spark, sf_dir))
    return retrieval.sparse_search(chunks, asked, index=postings.build(chunks)).drop("ord", "retriever")


def dense_search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense search over the cells that can matter."""
    chunks, asked = standins.chunks(spark, sf_dir), hybrid.prepare(standins.questions(spark, sf_dir))
    return retrieval.dense_search(chunks, asked, index=neighbours.build(chunks)).select("question_id", "chunk_id", "similarity", "rank")


def hybrid_retrieve_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid retrieval off both indexes, half of the postings in a second version."""
    chunks = standins.chunks(spark, sf_dir)
    late = F.col("ord") % 2 == 1
    index = postings.update(postings.build(chunks.filter(~late)), chunks.filter(late).select("ord", "chunk_id", "issuer", "text", F.lit(False).alias("gone")))
    found = hybrid.retrieve(chunks, standins.questions(spark, sf_dir), index=index, cells=neighbours.build(chunks), alone=False)
    return found.merged.select("question_id", "chunk_id", "rrf_score", "retrievers", "rrf_rank")


def _found(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, hybrid.Retrieved]:
    """Where a search fails, so does the query: its rows can't tell."""
    chunks = standins.chunks(spark, sf_dir)
    return chunks, hybrid.retrieve(chunks, standins.questions(spark, sf_dir), alone=False)


def rrf_two_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir)[1].initial.select("question_id", "chunk_id", "rrf_score", "retrievers", "rrf_rank")


def seed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _found(spark, sf_dir)[1]
    return fusion.seeds(found.initial, found.facts)


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir)[1].backfill.select("question_id", "chunk_id", "rank")


def hybrid_retrieve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir)[1].merged.select("question_id", "chunk_id", "rrf_score", "retrievers", "rrf_rank")


def rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks, found = _found(spark, sf_dir)
    return hybrid.select(chunks, found)[0].select("question_id", "chunk_id", "metadata_priority", "final_score", "final_rank")


def select_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks, found = _found(spark, sf_dir)
    rows = hybrid.response(hybrid.with_texts(hybrid.select(chunks, found)[1], chunks))
    return rows.select("question_id", "rank", "chunk_id", "retriever", "score", "filename", F.md5("text").alias("text_md5"))


def context_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks, found = _found(spark, sf_dir)
    rows = hybrid.with_texts(hybrid.select(chunks, found)[1], chunks)
    return answers.contexts(rows).select("question_id", F.length("context").alias("n_chars"), F.md5("context").alias("context_md5"))


def notice_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's distinct notice numbers."""
    rows = standins.chunks(spark, sf_dir).select("ord", answers.candidate_text(F.col("chunk_id"), F.col("text"), F.col("metadata")).alias("candidate"))
    found = F.sort_array(F.array_distinct(answers.notice_numbers(F.col("candidate"))))
    return rows.select("ord", F.size(found).alias("n"), F.array_join(found, ",").alias("numbers"))


def notice_lookups(spark: SparkSession, sf_dir: str, notices: DataFrame | None = None) -> DataFrame:
    """Lookup hints of budget questions to one issuer each, with short result lists."""
    chunks, asked = standins.chunks(spark, sf_dir), standins.questions(spark, sf_dir)
    asked = asked.withColumn("question", F.concat(F.lit("예산 "), "question")).withColumn("issuers", F.slice("issuers", 1, 1))
    found = hybrid.retrieve(chunks, asked, 5, 5, alone=False)
    ranked, picked = hybrid.select(chunks, found)
    return hybrid.lookups(chunks, found, ranked, picked, notices).select("question_id", "n", "notice_number", "issuer", "project_name", "source_file")


def notice_lookups_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same off notice numbers that are kept beside the records: half of them, then the other half as changes."""
    rows = hybrid.notice_rows(standins.chunks(spark, sf_dir))
    late = F.col("ord") % 2 == 1
    kept = versions.apply(versions.create(rows.filter(~late), by="issuer"), rows.filter(late).withColumn("gone", F.lit(False)))
    return notice_lookups(spark, sf_dir, kept.read())


def fallback_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks, found = _found(spark, sf_dir)
    rows = hybrid.with_texts(hybrid.select(chunks, found)[1], chunks)
    return answers.fallback(found.questions, rows).select("question_id", F.md5("answer").alias("answer_md5"))


def ask(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hybrid.ask(standins.chunks(spark, sf_dir), standins.questions(spark, sf_dir), alone=False)
    return rows.select(
        "question_id", "question_type", F.array_join("route", ",").alias("route"), F.md5("answer").alias("answer_md5"),
        "dense_count", "sparse_count", "backfill_count", "merged_count", "selected_count", F.col("lookup_count").cast("long").alias("lookup_count"),
    )


def queries() -> dict[str, Query]:
    own = (eav_records, issuers, issuer_filter, normalise, tokens, mojibake, question_types, metadata_points, sparse_search, dense_search, rrf_two_lists)
    own += (seed_documents, backfill, hybrid_retrieve, rerank, select_contexts, context_text, fallback_answers, notice_numbers, notice_lookups, ask)
    own += (sparse_search_indexed, dense_search_indexed, hybrid_retrieve_indexed, notice_lookups_indexed)
    return {f.__name__: f for f in own}


# ---------------------------------------------------------------- DuckDB

_NORM = "lower(trim(regexp_replace(nfc_normalize(coalesce(text, '')), '[^가-힣a-zA-Z0-9]+', ' ', 'g')))"
_GRAMS = """list_concat(list_filter(string_split(norm, ' '), lambda w: length(w) > 1), list_concat(
  list_transform(range(1, len(c)), lambda i: c[i] || c[i + 1]), list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])))"""
_CHARS = "CASE WHEN norm = '' THEN [] ELSE string_split(replace(norm, ' ', ''), '') END"


def _has(words) -> str:
    return f"regexp_matches(nfc_normalize(question), '{'|'.join(words)}')"


_TYPE = (
    f"CASE WHEN {_has(text_functions.BUDGET_WORDS)} AND {_has(text_functions.PURPOSE_WORDS)} THEN 'comparison' WHEN {_has(text_functions.BUDGET_WORDS)} THEN 'budget' "
    + " ".join(f"WHEN {_has(w)} THEN '{t}'" for t, w in text_functions.TYPE_WORDS)
    + f" WHEN {_has(text_functions.PURPOSE_WORDS)} THEN 'purpose' WHEN {_has(text_functions.COMPARISON_WORDS)} THEN 'comparison' ELSE 'general' END"
)
_NEED = ", ".join(f"('{t}', '{f}')" for t, fs in NEEDED.items() for f in fs)
_POINTS = ", ".join(f"('{t}', '{f}', {p})" for t, p, fs in POINTS for f in fs)


def _fused(lists: str, name: str) -> str:
    return f"""{name}_l AS ({lists}),
{name}_s AS (SELECT question_id, ord, chunk_id, sum(CASE WHEN list = 0 THEN 1 / (60 + rank) ELSE 0 END) + sum(CASE WHEN list = 1 THEN 1 / (60 + rank) ELSE 0 END)
    + sum(CASE WHEN list = 2 THEN 1 / (60 + rank) ELSE 0 END) AS rrf_score,
  array_to_string(list_sort(list_distinct(list(['dense', 'sparse', 'ngram_doc_backfill'][list + 1]))), ',') AS retrievers, min(list * 100000 + rank) AS first FROM {name}_l GROUP BY ALL),
{name} AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY rrf_score DESC, first) AS rrf_rank FROM {name}_s)"""


_TYPED = f"typed AS (SELECT *, {_TYPE} AS qtype, greatest(1, least(CASE WHEN max_contexts = 0 THEN 5 ELSE max_contexts END, 8)) AS n_contexts FROM questions)"
_DENSE = """dense AS (SELECT * FROM (SELECT question_id, ord, chunk_id, similarity, row_number() OVER (PARTITION BY question_id ORDER BY similarity DESC, ord) AS rank FROM (
  SELECT question_id, ord, chunk_id, round(list_inner_product(embedding::DOUBLE[], vector::DOUBLE[]) / sqrt(list_inner_product(vector::DOUBLE[], vector::DOUBLE[])), 9) AS similarity
  FROM typed JOIN chunks ON list_contains(issuers, issuer) WHERE embedding IS NOT NULL AND vector IS NOT NULL)) WHERE rank <= 50)"""
_SPARSE = f"""dn AS (SELECT ord, issuer, {_NORM} AS norm FROM chunks), dt AS (SELECT ord, issuer, tok, count(*) AS tf FROM (
  SELECT ord, issuer, unnest({_GRAMS}) AS tok FROM (SELECT *, {_CHARS} AS c FROM dn)) GROUP BY ALL),
nd AS (SELECT ord, count(*) AS nd FROM dt GROUP BY ord),
qn AS (SELECT question_id, issuers, {_NORM.replace("text", "question")} AS norm FROM typed), qt AS (SELECT question_id, issuers, tok, count(*) AS tf FROM (
  SELECT question_id, issuers, unnest({_GRAMS}) AS tok FROM (SELECT *, {_CHARS} AS c FROM qn)) GROUP BY ALL),
sparse AS (SELECT * FROM (SELECT question_id, ord, 'C' || ord AS chunk_id, sparse_score, row_number() OVER (PARTITION BY question_id ORDER BY sparse_score DESC, ord) AS rank FROM (
  SELECT question_id, ord, sum(least(qt.tf, dt.tf)) / sqrt(greatest(1, any_value(nd.nd))) AS sparse_score
  FROM qt JOIN dt USING (tok) JOIN nd USING (ord) WHERE list_contains(issuers, issuer) GROUP BY question_id, ord)) WHERE rank <= 50)"""
_TWO = "SELECT question_id, ord, chunk_id, rank, 0 AS list FROM dense UNION ALL SELECT question_id, ord, chunk_id, rank, 1 FROM sparse"
_SEEDS = """seeds AS (SELECT * FROM (SELECT question_id, doc, row_number() OVER (PARTITION BY question_id ORDER BY min(rrf_rank)) AS seed
  FROM initial JOIN chunks USING (ord) WHERE rrf_rank <= 10 GROUP BY question_id, doc) WHERE seed <= 5)"""
_FILL = f"""need(qtype, fact_type) AS (VALUES {_NEED}),
fill AS (SELECT question_id, ord, chunk_id, row_number() OVER (PARTITION BY question_id ORDER BY ord) AS rank FROM (
  SELECT s.question_id, c.ord, c.chunk_id, row_number() OVER (PARTITION BY s.question_id, s.doc ORDER BY c.ord) AS nth
  FROM seeds s JOIN typed t USING (question_id) JOIN chunks c ON c.doc = s.doc AND list_contains(t.issuers, c.issuer) JOIN need n ON n.qtype = t.qtype AND n.fact_type = c.fact_type) WHERE nth <= 2)"""
_PRIORITY = """(coalesce((SELECT sum(p) FROM points WHERE points.qtype = {t}.qtype AND points.fact_type = c.fact_type), 0)
  + CASE WHEN {t}.qtype = 'budget' AND coalesce(c.enabled, '') = 'true' THEN 50 ELSE 0 END + CASE WHEN {t}.qtype = 'budget' AND coalesce(c.answer_policy, '') = 'allow_as_project_budget' THEN 40 ELSE 0 END)::INT"""
_RANKED = f"""points(qtype, fact_type, p) AS (VALUES {_POINTS}),
scored AS (SELECT m.question_id, m.ord, m.chunk_id, m.retrievers, m.rrf_rank, m.rrf_score, t.qtype, t.n_contexts, {_PRIORITY.format(t="t")} AS metadata_priority,
  c.fact_type IN ('project_budget', 'total_allocation') AND coalesce(c.enabled, '') = 'true' AS safe FROM merged m JOIN typed t USING (question_id) JOIN chunks c USING (ord)),
ranked AS (SELECT *, rrf_score + metadata_priority * 0.001::DOUBLE AS final_score, row_number() OVER (PARTITION BY question_id ORDER BY rrf_score + metadata_priority * 0.001::DOUBLE DESC, rrf_rank) AS final_rank FROM scored)"""
_SELECTED = """selected AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY final_rank) AS context_rank FROM (
  SELECT *, bool_or(safe) OVER (PARTITION BY question_id) AS any_safe FROM ranked) WHERE qtype <> 'budget' OR NOT any_safe OR safe) WHERE context_rank <= n_contexts)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join((standins.CHUNKS_SQL, *parts)) + "\n"


_INITIAL = (_TYPED, _DENSE, _SPARSE, _fused(_TWO, "initial"))
_MERGED = (*_INITIAL, _SEEDS, _FILL, _fused(_TWO + " UNION ALL SELECT question_id, ord, chunk_id, rank, 2 FROM fill", "merged"))
_PICKED = (*_MERGED, _RANKED, _SELECTED)
_BLOCK = (
    "'[근거 ' || context_rank || ']' || chr(10) || '문서: ' || coalesce(c.source_file, '') || chr(10) || '발주기관: ' || coalesce(c.issuer, '') || chr(10) || '사업명: ' || coalesce(c.project_name, '') || chr(10) "
    "|| '섹션: ' || coalesce(c.section_path, c.section_type, '') || chr(10) || '유형: ' || coalesce(c.fact_type, '') || chr(10) || chr(10) || '본문:' || chr(10) || substr(c.text, 1, 1800)"
)


_SNIPPETS = """tops AS (SELECT question_id, context_rank, substr(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 260) AS snippet, coalesce(nullif(source_file, ''), '검색 문서') AS source
  FROM selected s JOIN chunks USING (ord) WHERE context_rank <= 3),
firsts AS (SELECT question_id, source, min(context_rank) AS nth FROM tops GROUP BY ALL),
f AS (SELECT question_id, coalesce(list('- ' || snippet ORDER BY context_rank) FILTER (snippet <> ''), []) AS lines,
  (SELECT list(source ORDER BY nth) FROM firsts WHERE firsts.question_id = tops.question_id) AS sources FROM tops GROUP BY question_id)"""
_CANDIDATES = """texts AS (SELECT ord, concat_ws(chr(10), chunk_id, nullif(text, ''), issuer, canonical_doc_id, doc_id, fact_type, answer_policy, enabled, source_file, project_name, section_path, section_type, notice) AS t FROM chunks),
found AS (SELECT ord, list_sort(list_distinct(list_concat(regexp_extract_all(t, '\\b20\\d{8,12}(?:-\\d{2})?\\b'),
  regexp_extract_all(t, '(?:G2B\\s*)?(?:공고번호|입찰공고번호|공고\\s*번호)\\s*[:：]?\\s*([0-9]{10,14}(?:-\\d{2})?)', 1)))) AS x FROM texts)"""


# Notices of budget questions without a safe row: of their selected and ranked rows, else of all records of their issuers; three of each question, with what its first row says.
_LOOKUPS = """unsafe AS (SELECT question_id, issuers FROM typed t WHERE qtype = 'budget' AND NOT EXISTS (SELECT 1 FROM selected s WHERE s.question_id = t.question_id AND s.safe)),
nums AS (SELECT ord, list_concat(regexp_extract_all(t, '\\b20\\d{8,12}(?:-\\d{2})?\\b'), regexp_extract_all(t, '(?:G2B\\s*)?(?:공고번호|입찰공고번호|공고\\s*번호)\\s*[:：]?\\s*([0-9]{10,14}(?:-\\d{2})?)', 1)) AS ns FROM texts),
own AS (SELECT question_id, ord, context_rank AS spot FROM selected SEMI JOIN unsafe USING (question_id) UNION ALL SELECT question_id, ord, final_rank + 8 FROM ranked SEMI JOIN unsafe USING (question_id)),
by_results AS (SELECT question_id, number, min(spot * 1000000 + place) AS first FROM (SELECT question_id, spot, unnest(ns) AS number, unnest(range(len(ns))) AS place FROM own JOIN nums USING (ord)) WHERE number <> '' GROUP BY ALL),
rest AS (SELECT question_id, unnest(issuers) AS issuer FROM unsafe ANTI JOIN by_results USING (question_id)),
by_records AS (SELECT question_id, number, min(ord * 1000000 + place) AS first FROM (
  SELECT question_id, ord, unnest(ns) AS number, unnest(range(len(ns))) AS place FROM rest JOIN chunks USING (issuer) JOIN nums USING (ord)) WHERE number <> '' GROUP BY ALL),
heads AS (SELECT question_id, min_by(ord, spot) AS ord FROM (SELECT * FROM own SEMI JOIN by_results USING (question_id) UNION ALL SELECT question_id, ord, ord AS spot FROM rest JOIN chunks USING (issuer)) GROUP BY question_id),
lookups AS (SELECT question_id, n, number, coalesce(issuer, '') AS issuer, coalesce(project_name, '') AS project_name, coalesce(source_file, '') AS source_file FROM (
  SELECT question_id, number, row_number() OVER (PARTITION BY question_id ORDER BY first) AS n FROM (SELECT * FROM by_results UNION ALL SELECT * FROM by_records))
  JOIN heads USING (question_id) JOIN chunks USING (ord) WHERE n <= 3)"""
_ONE_ISSUER = _TYPED.replace("FROM questions", "FROM (SELECT question_id, '예산 ' || question AS question, ['src' || (question_id % 20)] AS issuers, max_contexts, vector FROM questions)")
_PLAIN = f"""CASE WHEN sources IS NULL THEN '{answers.NO_CONTEXT}' WHEN t.qtype = 'budget' THEN '{answers.NO_BUDGET}' || chr(10) || chr(10) || '{answers.SOURCES}' || sources[1]
  ELSE CASE WHEN t.qtype = 'purpose' THEN '{answers.LEAD_PURPOSE}' ELSE '{answers.LEAD}' END || chr(10) || CASE WHEN len(lines) = 0 THEN '{answers.EMPTY_BODY}' ELSE array_to_string(lines, chr(10)) END
    || chr(10) || chr(10) || '{answers.SOURCES}' || array_to_string(sources, ', ') END"""
_ASK = f"""noted AS (SELECT question_id, count(*) AS c, string_agg('- 공고번호: ' || number, chr(10) ORDER BY n) AS ls FROM lookups GROUP BY question_id),
counts AS (SELECT question_id, (SELECT count(*) FROM dense x WHERE x.question_id = t.question_id) AS dense_count, (SELECT count(*) FROM sparse x WHERE x.question_id = t.question_id) AS sparse_count,
  (SELECT count(*) FROM fill x WHERE x.question_id = t.question_id) AS backfill_count, (SELECT count(*) FROM merged x WHERE x.question_id = t.question_id) AS merged_count,
  (SELECT count(*) FROM selected x WHERE x.question_id = t.question_id) AS selected_count FROM typed t)
SELECT t.question_id, t.qtype AS question_type, array_to_string(list_filter(['issuer_filter', 'hybrid_dense_sparse', CASE WHEN backfill_count > 0 THEN 'ngram_backfill' END, 'metadata_rerank',
    CASE WHEN t.qtype = 'budget' THEN 'budget_strict_selection' ELSE 'context_selection' END, CASE WHEN noted.c > 0 THEN 'g2b_manual_lookup' END,
    CASE WHEN selected_count = 0 THEN 'no_context' ELSE 'llm_fallback' END], lambda x: x IS NOT NULL), ',') AS route,
  md5(CASE WHEN noted.c > 0 THEN rtrim({_PLAIN}) || chr(10) || chr(10) || '{answers.LOOKUP_HEAD}' || chr(10) || ls || chr(10) || '- 확인 경로: {answers.LOOKUP_URL}' ELSE {_PLAIN} END) AS answer_md5,
  dense_count, sparse_count, backfill_count, merged_count, selected_count, coalesce(noted.c, 0)::BIGINT AS lookup_count
FROM typed t JOIN counts USING (question_id) LEFT JOIN f USING (question_id) LEFT JOIN noted USING (question_id)"""


def oracle_sql() -> dict[str, str]:
    out = {
        "eav_records": _with()
        + """SELECT ord, chunk_id, md5(text) AS text_md5, issuer, canonical_doc_id, doc_id, fact_type, answer_policy, enabled AS budget_answer_enabled, source_file,
 (1 + (issuer IS NOT NULL)::INT + (canonical_doc_id IS NOT NULL)::INT + 2 + (answer_policy IS NOT NULL)::INT + (enabled IS NOT NULL)::INT + (source_file IS NOT NULL)::INT + 1
  + (section_path IS NOT NULL)::INT + (section_type IS NOT NULL)::INT + (notice IS NOT NULL)::INT)::INT AS n_keys FROM chunks""",
        "issuers": "SELECT DISTINCT trim(source) AS issuer FROM documents WHERE trim(source) <> '' ORDER BY 1",
        "issuer_filter": _with(_TYPED) + "SELECT question_id, count(*)::BIGINT AS sparse_chunks, count(*)::BIGINT AS dense_chunks FROM typed JOIN chunks ON list_contains(issuers, issuer) GROUP BY question_id",
        "normalise": f"SELECT doc_id, md5({_NORM}) AS norm_md5 FROM documents",
        "tokens": f"SELECT doc_id, len(t)::BIGINT AS n_tokens, len(list_distinct(t))::BIGINT AS n_distinct FROM (SELECT doc_id, {_GRAMS} AS t FROM (SELECT *, {_CHARS} AS c FROM (SELECT doc_id, {_NORM} AS norm FROM documents)))",
        "mojibake": "SELECT doc_id, md5('한국 ' || coalesce(text, '')) AS repaired_md5, md5(coalesce(text, '')) AS own_md5 FROM documents",
        "question_types": _with(_TYPED) + "SELECT question_id, qtype, n_contexts::INT AS contexts FROM typed",
        "metadata_points": _with(f"points(qtype, fact_type, p) AS (VALUES {_POINTS})", f"x(qtype) AS (VALUES {', '.join(f'({chr(39)}{t}{chr(39)})' for t in NEEDED)})")
        + f"SELECT c.ord, x.qtype, {_PRIORITY.format(t='x')} AS points FROM chunks c, x",
        "sparse_search": _with(_TYPED, _SPARSE) + "SELECT question_id, chunk_id, sparse_score, rank::INT AS rank FROM sparse",
        "dense_search": _with(_TYPED, _DENSE) + "SELECT question_id, chunk_id, similarity, rank::INT AS rank FROM dense",
        "rrf_two_lists": _with(*_INITIAL) + "SELECT question_id, chunk_id, rrf_score, retrievers, rrf_rank::INT AS rrf_rank FROM initial",
        "seed_documents": _with(*_INITIAL, _SEEDS) + "SELECT question_id, doc, seed::INT AS seed FROM seeds",
        "backfill": _with(*_INITIAL, _SEEDS, _FILL) + "SELECT question_id, chunk_id, rank::INT AS rank FROM fill",
        "hybrid_retrieve": _with(*_MERGED) + "SELECT question_id, chunk_id, rrf_score, retrievers, rrf_rank::INT AS rrf_rank FROM merged",
        "rerank": _with(*_MERGED, _RANKED) + "SELECT question_id, chunk_id, metadata_priority, final_score, final_rank::INT AS final_rank FROM ranked",
        "select_contexts": _with(*_PICKED)
        + "SELECT question_id, context_rank::INT AS rank, s.chunk_id, retrievers AS retriever, final_score AS score, source_file AS filename, md5(text) AS text_md5 FROM selected s JOIN chunks USING (ord)",
        "context_text": _with(*_PICKED, f"b AS (SELECT question_id, context_rank, {_BLOCK} AS block FROM selected s JOIN chunks c USING (ord))", "t AS (SELECT question_id, string_agg(block, chr(10) || chr(10) ORDER BY context_rank) AS x FROM b GROUP BY question_id)")
        + "SELECT question_id, length(x)::INT AS n_chars, md5(x) AS context_md5 FROM t",
        "fallback_answers": _with(*_PICKED, _SNIPPETS) + f"SELECT t.question_id, md5({_PLAIN}) AS answer_md5 FROM typed t LEFT JOIN f USING (question_id)",
        "notice_lookups": _with(_ONE_ISSUER, *(x.replace("rank <= 50", "rank <= 5") for x in _PICKED[1:]), _CANDIDATES, _LOOKUPS)
        + "SELECT question_id, n::INT AS n, number AS notice_number, issuer, project_name, source_file FROM lookups",
        "ask": _with(*_PICKED, _SNIPPETS, _CANDIDATES, _LOOKUPS, _ASK),
        "notice_numbers": _with(_CANDIDATES) + "SELECT ord, len(x)::INT AS n, array_to_string(x, ',') AS numbers FROM found",
    }
    return out | {f"{name}_indexed": out[name] for name in ("sparse_search", "dense_search", "hybrid_retrieve", "notice_lookups")}
