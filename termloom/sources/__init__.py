"""Corpora from tables and from directories of text files."""

from termloom.sources.files import text_files, text_lines
from termloom.sources.tables import corpus_columns, table_corpus

__all__ = ["corpus_columns", "table_corpus", "text_files", "text_lines"]
