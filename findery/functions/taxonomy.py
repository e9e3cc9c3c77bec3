"""Which kinds of facts a type of question needs, and what they are worth to it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from findery.functions.text import TRUE, nfc, to_bool

# Kinds of facts by type of question, for backfilling.
NEEDED = {
    "budget": ("project_budget", "total_allocation", "document_summary", "document_identity"),
    "purpose": ("project_purpose_effect", "project_background", "project_scope", "requirements", "document_summary"),
    "submission_documents": ("submission_documents", "submission_logistics", "table", "document_summary"),
    "eligibility": ("eligibility", "business_type", "threshold_budget", "document_summary"),
    "deadline": ("bid_deadline", "deadline_term", "submission_logistics", "document_summary"),
    "duration": ("project_duration", "maintenance_period", "warranty_period", "deadline_term", "document_summary"),
    "comparison": ("document_identity", "document_summary", "project_budget", "project_duration", "submission_documents", "eligibility", "project_purpose_effect", "project_scope"),
    "general": ("document_summary", "project_purpose_effect", "project_background", "project_scope", "requirements", "business_type", "project_budget", "project_duration", "eligibility", "document_identity", "table"),
}

# Points by type of question and kind of fact, for reranking.
OVERVIEW = ("document_summary", "requirements", "project_scope", "project_purpose_effect", "project_budget", "document_identity", "table")
POINTS = (
    ("budget", 80, ("project_budget", "total_allocation")),
    ("budget", -50, ("threshold_budget", "estimated_price", "base_amount", "reference_amount", "payment_terms")),
    ("purpose", 60, ("project_purpose_effect", "project_background", "project_scope", "requirements", "document_summary")),
    ("eligibility", 60, ("eligibility", "business_type")),
    ("deadline", 60, ("bid_deadline", "deadline_term", "submission_logistics")),
    ("duration", 60, ("project_duration", "maintenance_period", "warranty_period")),
    ("submission_documents", 60, ("submission_documents", "submission_logistics", "table")),
    ("general", 35, OVERVIEW),
    ("comparison", 35, OVERVIEW),
)
SAFE_FACTS, SAFE_POLICY = ("project_budget", "total_allocation"), "allow_as_project_budget"
ENABLED_POINTS, POLICY_POINTS, POINT = 50, 40, 0.001


def needed(qtype: Column, fact_type: Column) -> Column:
    """Whether a question of this type needs facts of this kind."""
    out = F.lit(False)
    for name, facts in NEEDED.items():
        out = out | ((qtype == name) & fact_type.isin(*facts))
    return F.coalesce(out, F.lit(False))


def metadata_priority(qtype: Column, fact_type: Column, policy: Column, enabled: Column) -> Column:
    fact, out = nfc(fact_type), F.lit(0)
    for name, points, facts in POINTS:
        out = out + F.when((qtype == name) & fact.isin(*facts), points).otherwise(0)
    out = out + F.when((qtype == "budget") & to_bool(enabled), ENABLED_POINTS).otherwise(0)
    return out + F.when((qtype == "budget") & (nfc(policy) == SAFE_POLICY), POLICY_POINTS).otherwise(0)


def safe_budget(fact_type: Column, enabled: Column) -> Column:
    return F.coalesce(nfc(fact_type).isin(*SAFE_FACTS), F.lit(False)) & to_bool(enabled)


def plainly_safe_budget(fact_type: Column, enabled: Column) -> Column:
    """The same without normalising or stripping: what decides whether notices are looked up."""
    return F.coalesce(fact_type.isin(*SAFE_FACTS) & F.lower(enabled).isin(*TRUE), F.lit(False))
