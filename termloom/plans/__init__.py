"""Whole computations: weights and reports."""

from termloom.plans.ranges import document_ranges
from termloom.plans.reports import idf_report, tf_report, tfidf_report
from termloom.plans.weights import idf, tf, tfidf, tfidf_broadcast, tfidf_union

__all__ = [
    "document_ranges",
    "idf",
    "idf_report",
    "tf",
    "tf_report",
    "tfidf",
    "tfidf_broadcast",
    "tfidf_report",
    "tfidf_union",
]
