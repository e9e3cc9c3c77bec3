"""Limits of retrieval and answering, from the session's configuration."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

from findery.operators import answers, fusion, retrieval


@dataclass(frozen=True)
class Settings:
    """Set as ``spark.findery.<name>``."""

    dense_k: int = retrieval.DENSE_K
    sparse_k: int = retrieval.SPARSE_K
    max_contexts: int = fusion.MAX_CONTEXTS
    answer_tokens: int = answers.ANSWER_TOKENS

    @classmethod
    def of(cls, spark: SparkSession) -> Settings:
        return cls(**{f.name: int(spark.conf.get(f"spark.findery.{f.name}", str(f.default))) for f in fields(cls)})
