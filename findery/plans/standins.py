"""Chunks, their metadata and questions made of the driver's tables, and the SQL that makes the same in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.scratch import spread

# The kinds of facts, in the order in which documents get them; a word of each type of question.
FACTS = (
    "project_budget", "total_allocation", "document_summary", "document_identity", "project_purpose_effect", "project_background", "project_scope", "requirements",
    "submission_documents", "submission_logistics", "table", "eligibility", "business_type", "threshold_budget", "bid_deadline", "deadline_term",
    "project_duration", "maintenance_period", "warranty_period", "estimated_price", "base_amount", "reference_amount", "payment_terms",
)
WORDS = ("예산", "목적", "제출서류", "참가자격", "마감", "사업기간", "예산 목적", "차이", "무엇")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))


def _columns() -> dict[str, F.Column]:
    d, text = F.col("doc_id"), lambda c: c.cast("string")
    return {
        "issuer": F.col("source"),
        "canonical_doc_id": F.when(d % 5 != 0, F.concat(F.lit("D"), text(F.floor(d / 4)))),
        "doc_id": text(d),
        "fact_type": F.get(F.array(*map(F.lit, FACTS)), (d % len(FACTS)).cast("int")),
        "answer_policy": F.when(F.col("toxic") == 0, "allow_as_project_budget"),
        "budget_answer_enabled": F.when(F.col("quality") == 1, "true").when(F.col("quality") == 0, "false"),
        "source_file": F.concat("lang", F.lit("-"), text(d % 7), F.lit(".hwp")),
        "project_name": F.concat(F.lit("project "), text(d % 11)),
        "section_path": F.when(d % 3 == 0, F.concat(F.lit("1/"), text(d % 13))),
        "section_type": F.when(d % 3 == 1, F.lit("body")),
        "notice": F.when(d % 17 == 0, F.concat(F.lit("공고번호: "), text(F.lit(20240000000) + d), F.lit("-00"))),
    }


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records table as the pivot leaves it, with embeddings: ``ord, chunk_id, text, metadata``, hot columns, ``embedding``."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).join(_labels(spark, sf_dir), "doc_id", "left")
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("doc_id"), "embedding")
    columns = _columns()
    pairs = F.array(*(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in columns.items()))
    metadata = F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull()))
    hot = [v.alias(k) for k, v in columns.items() if k != "notice"]
    out = docs.join(vectors, "doc_id", "left")
    return out.select(F.col("doc_id").alias("ord"), F.concat(F.lit("C"), F.col("doc_id").cast("string")).alias("chunk_id"), F.coalesce("text", F.lit("")).alias("text"), metadata.alias("metadata"), *hot, "embedding")


def eav(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The same corpus as entities and entity-attribute-value rows of four types."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).join(_labels(spark, sf_dir), "doc_id", "left")
    entities = docs.select(F.col("doc_id").alias("id"), F.concat(F.lit("E"), F.col("doc_id").cast("string")).alias("embedding_id"))
    none = F.lit(None)
    columns = _columns() | {"chroma:document": F.col("text"), "chunk_id": F.concat(F.lit("C"), F.col("doc_id").cast("string"))}
    rows = [F.struct(F.lit(k).alias("key"), v.alias("s"), none.cast("long").alias("i"), none.cast("double").alias("f"), none.cast("boolean").alias("b")) for k, v in columns.items() if k not in ("doc_id", "budget_answer_enabled")]
    rows.append(F.struct(F.lit("doc_id").alias("key"), none.cast("string").alias("s"), F.col("doc_id").alias("i"), none.cast("double").alias("f"), none.cast("boolean").alias("b")))
    rows.append(F.struct(F.lit("budget_answer_enabled").alias("key"), none.cast("string").alias("s"), none.cast("long").alias("i"), none.cast("double").alias("f"), (F.col("quality") == 1).alias("b")))
    flat = docs.select(F.col("doc_id").alias("id"), F.explode(F.array(*rows)).alias("x"))
    flat = flat.select("id", "x.key", F.col("x.s").alias("string_value"), F.col("x.i").alias("int_value"), F.col("x.f").alias("float_value"), F.col("x.b").alias("bool_value"))
    return entities, flat.filter("coalesce(string_value, cast(int_value as string), cast(float_value as string), cast(bool_value as string)) IS NOT NULL")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("item_id"), F.col("embedding").cast("array<double>").alias("vector"))
    word = F.get(F.array(*map(F.lit, WORDS)), (F.col("item_id") % len(WORDS)).cast("int"))
    issuers = F.array(F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")), F.lit(" src0 "))
    out = items.join(vectors, "item_id", "left")
    return out.select(F.col("item_id").alias("question_id"), F.concat(word, F.lit(" "), "text").alias("question"), issuers.alias("issuers"), (F.col("item_id") % 10).cast("int").alias("max_contexts"), "vector")


def _in_sql(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


CHUNKS_SQL = f"""
lab AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
chunks AS (SELECT d.doc_id AS ord, 'C' || d.doc_id AS chunk_id, coalesce(text, '') AS text, source AS issuer,
  CASE WHEN d.doc_id % 5 <> 0 THEN 'D' || (d.doc_id // 4) END AS canonical_doc_id, d.doc_id::VARCHAR AS doc_id,
  coalesce(CASE WHEN d.doc_id % 5 <> 0 THEN 'D' || (d.doc_id // 4) END, d.doc_id::VARCHAR) AS doc,
  ({_in_sql(FACTS)})[d.doc_id % {len(FACTS)} + 1] AS fact_type, CASE WHEN toxic = 0 THEN 'allow_as_project_budget' END AS answer_policy,
  CASE WHEN quality = 1 THEN 'true' WHEN quality = 0 THEN 'false' END AS enabled,
  lang || '-' || (d.doc_id % 7) || '.hwp' AS source_file, 'project ' || (d.doc_id % 11) AS project_name,
  CASE WHEN d.doc_id % 3 = 0 THEN '1/' || (d.doc_id % 13) END AS section_path, CASE WHEN d.doc_id % 3 = 1 THEN 'body' END AS section_type,
  CASE WHEN d.doc_id % 17 = 0 THEN '공고번호: ' || (20240000000 + d.doc_id) || '-00' END AS notice, e.embedding
  FROM documents d LEFT JOIN lab USING (doc_id) LEFT JOIN embeddings e ON e.vec_id = d.doc_id),
questions AS (SELECT item_id AS question_id, ({_in_sql(WORDS)})[item_id % {len(WORDS)} + 1] || ' ' || text AS question,
  list_distinct(['src' || (item_id % 20), 'src0']) AS issuers, item_id % 10 AS max_contexts, embedding AS vector FROM benchmark LEFT JOIN embeddings ON vec_id = item_id)"""
