"""Issuer filters of the two retrievers.

Defined results: null and blank issuers asked for are left out, repeated ones count once; none left is
an error for ``clean``, no record for the sparse side, every record for the dense side; a record
without an issuer is found by nothing that asks for one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findery.functions.text import mojibake_alias, repair_mojibake, strip


def clean(issuers: Column) -> Column:
    """Stripped, without empty ones and repetitions, in order; an error where none is left."""
    out = cleaned(issuers)
    return F.when(F.coalesce(F.size(out), F.lit(0)) > 0, out).otherwise(F.raise_error(F.lit("an issuer is required")).cast("array<string>"))


def cleaned(issuers: Column) -> Column:
    """The same without the error: null or empty where none is left."""
    return F.array_distinct(F.filter(F.transform(issuers, strip), lambda x: x != ""))


def sparse_allowed(issuer: Column, issuers: Column) -> Column:
    """The record's issuer, as it is, is one of the stripped ones asked for; none asked for, none allowed."""
    return F.coalesce(F.array_contains(F.filter(F.transform(issuers, strip), lambda x: x != ""), issuer), F.lit(False))


def aliases(issuers: Column) -> Column:
    """Every form in which a stripped issuer may be stored."""
    forms = lambda x: F.array(x, mojibake_alias(x), repair_mojibake(x))
    return F.array_distinct(F.filter(F.flatten(F.transform(F.transform(issuers, strip), forms)), lambda x: F.coalesce(x != "", F.lit(False))))


def dense_allowed(issuer: Column, forms: Column) -> Column:
    """``forms``: of ``aliases``. None asked for, all allowed."""
    return (F.coalesce(F.size(forms), F.lit(0)) < 1) | F.coalesce(F.array_contains(forms, issuer), F.lit(False))


def records_for_issuers(records: DataFrame, wanted: list[str]) -> DataFrame:
    """Records of the issuers; a predicate that reaches the scan."""
    own = sorted({w.strip() for w in wanted} - {""})
    return records.filter(F.col("issuer").isin(*own)) if own else records.limit(0)
