"""The weight formulas: natural logarithm, no smoothing, floating division."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def tf(word_count: Column, doc_size: Column) -> Column:
    return word_count / doc_size


def idf(num_docs: Column, df: Column) -> Column:
    return F.ln(num_docs / df)


def tfidf(word_count: Column, doc_size: Column, num_docs: Column, df: Column) -> Column:
    return tf(word_count, doc_size) * idf(num_docs, df)
