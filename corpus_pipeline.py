"""The corpus pipeline: language ID, near duplicates, repeated passages, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a table of documents with the columns of
``documents`` (the last: packed pieces); each is written as Parquet and read again for the next.

Defined results, beyond those of the operators: null, empty and letterless texts go at the first
stage; of a near-duplicate group the row with the smallest ``doc_id`` (nulls last), then text hash,
stays, and of equal rows one; a document all of whose words repeat stays with an empty text until
the mix takes nothing from it; columns beside those of ``documents`` are carried up to packing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm import langid, mixing, ngramjoin, packing, passages
from findery.scratch import few, materialize

#: Below this mean probability a text is in no language that was learned. (One of four at random: 0.25.)
LEAST_SCORE = 0.35
ORACLE_SQL = None
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def carrying(stage: Callable) -> Callable:
    """A stage that sees columns beside those of ``documents`` under names that no operator uses."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        other = {c: f"_carried_{n}" for n, c in enumerate(docs.columns) if c not in OWN}
        out = stage(spark, docs.withColumnsRenamed(other), sf_dir)
        return out.withColumnsRenamed({b: a for a, b in other.items()})

    return run


@carrying
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    told = langid.predict(docs, langid.learn(docs))
    kept = told.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(docs.columns)


@carrying
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return few(ngramjoin.keep_one(docs))


@carrying
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has."""
    kept = passages.remove_repeats(docs).withColumn("text", F.col("kept")).withColumn("n_chars", F.length("kept").cast("long"))
    return kept.select(docs.columns)


@carrying
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; of the last one of a shard's share, as many words as it takes."""
    own = mixing.mix(docs.withColumn("size", mixing.n_words(F.col("text")))).filter("taken > 0")
    whole, rest = F.floor(F.col("taken") / F.col("size")), F.col("taken") % F.col("size")
    own = own.withColumn("_whole", whole).withColumn("_rest", rest.cast("int"))
    copies = own.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_whole") + F.signum("_rest").cast("long"))))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(F.col("_copy") <= F.col("_whole"), F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("_rest"), F.lit(1))), " "))
    return few(copies.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, by sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
