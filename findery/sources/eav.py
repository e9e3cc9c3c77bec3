"""Chunk records from entity-attribute-value metadata, and the issuers among them.

Defined results: rows of metadata with a null key or no value of any type are left out; of a key that
an entity has twice, the greatest value is taken (rows of a table have no order); entities without
metadata, and metadata of unknown entities, give no record; an entity that is listed twice gives two; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.functions.text import or_else, repair_mojibake, strip

TEXT_KEY = "chroma:document"
#: Metadata keys that become columns of their own; the whole map is kept beside them.
HOT = ("issuer", "canonical_doc_id", "doc_id", "fact_type", "answer_policy", "budget_answer_enabled", "source_file", "project_name", "section_path", "section_type")


def read_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``entities`` (id, embedding_id) and ``entity_metadata`` as Parquet in a folder."""
    return spark.read.parquet(f"{folder}/entities.parquet"), spark.read.parquet(f"{folder}/entity_metadata.parquet")


def read_jdbc(spark: SparkSession, url: str, entities: str = "embeddings", metadata: str = "embedding_metadata", parts: int = 16, **options) -> tuple[DataFrame, DataFrame]:
    """The same tables from a database, each read in ``parts`` ranges between the ids that it has."""

    def get(table: str) -> DataFrame:
        read = lambda **how: spark.read.format("jdbc").options(url=url, **options, **how).load()
        whole = read(dbtable=table)
        own = next(c for c in whole.columns if c.lower() == "id")
        quoted = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(own)
        ends = read(query=f"SELECT min({quoted}) AS low, max({quoted}) AS high FROM {table}").first()
        if ends[0] is None:
            return whole
        return read(dbtable=table, partitionColumn=own, lowerBound=str(ends[0]), upperBound=str(int(ends[1]) + 1), numPartitions=str(parts))

    return get(entities), get(metadata)


def value_of() -> F.Column:
    """The first of a row's typed values that isn't null, as text, repaired."""
    return repair_mojibake(F.coalesce("string_value", F.col("int_value").cast("string"), F.col("float_value").cast("string"), F.col("bool_value").cast("string")))


def records(entities: DataFrame, metadata: DataFrame) -> DataFrame:
    """``ord, chunk_id, text, metadata`` and the hot keys, a row per entity with metadata.

    One exchange by id brings an entity's few rows together, and what they make joins without
    another. ``ord`` is the id: the corpus order.
    """
    pairs = metadata.select("id", "key", value_of().alias("value")).filter("key IS NOT NULL AND value IS NOT NULL")
    rows = pairs.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("key", "value"))).alias("kv"))
    last = F.filter("kv", lambda x, i: (i + 1 == F.size("kv")) | (F.get("kv", i + 1)["key"] != x["key"]))
    maps = rows.select("id", F.map_from_entries(last).alias("m"))
    m, name = F.col("m"), F.col("embedding_id")
    out = entities.join(maps, "id").select(
        F.col("id").alias("ord"),
        or_else(m["chunk_id"], repair_mojibake(name)).alias("chunk_id"),
        F.coalesce(or_else(repair_mojibake(m[TEXT_KEY]), m["content"]), F.lit("")).alias("text"),
        F.map_filter(m, lambda k, v: k != TEXT_KEY).alias("metadata"),
    )
    return out.select("*", *(F.col("metadata")[k].alias(k) for k in HOT))


def issuers(metadata: DataFrame) -> DataFrame:
    """Distinct issuers, repaired and stripped, in code point order."""
    own = metadata.filter("key = 'issuer' AND trim(string_value) <> ''")
    return own.select("string_value").distinct().select(strip(repair_mojibake(F.col("string_value"))).alias("issuer")).distinct().orderBy("issuer")
