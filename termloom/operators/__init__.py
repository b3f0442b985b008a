"""Relational building blocks: counts, totals, joins and indexes."""

from termloom.operators.document_frequency import doc_freqs, vocabulary, with_doc_freqs
from termloom.operators.indexes import expand_postings, forward_index, postings
from termloom.operators.split_join import join_split
from termloom.operators.terms import doc_sizes, num_docs, term_counts, tokens, word_counts, word_totals

__all__ = [
    "doc_freqs",
    "doc_sizes",
    "expand_postings",
    "forward_index",
    "join_split",
    "num_docs",
    "postings",
    "term_counts",
    "tokens",
    "vocabulary",
    "with_doc_freqs",
    "word_counts",
    "word_totals",
]
