"""Small corpora with known weights."""

from termloom import Corpus

# The sample documents and their weights.
SAMPLE = {
    "doc1": "Lorem ipsum dolor ipsum sit ipsum\n",
    "doc2": "Vituperata incorrupte at ipsum pro quo\n",
    "doc3": "Has persius disputationi id simul",
}
ONCE_OF_SIX = 0.1831020481113516
ONCE_OF_FIVE = 0.21972245773362198
# key, word_count, doc_size, df, tfidf in output order
SAMPLE_WEIGHTS = [
    ("doc1@Lorem", 1, 6, 1, ONCE_OF_SIX),
    ("doc1@dolor", 1, 6, 1, ONCE_OF_SIX),
    ("doc1@ipsum", 3, 6, 2, 0.2027325540540822),
    ("doc1@sit", 1, 6, 1, ONCE_OF_SIX),
    ("doc2@Vituperata", 1, 6, 1, ONCE_OF_SIX),
    ("doc2@at", 1, 6, 1, ONCE_OF_SIX),
    ("doc2@incorrupte", 1, 6, 1, ONCE_OF_SIX),
    ("doc2@ipsum", 1, 6, 2, 0.06757751801802739),
    ("doc2@pro", 1, 6, 1, ONCE_OF_SIX),
    ("doc2@quo", 1, 6, 1, ONCE_OF_SIX),
    ("doc3@Has", 1, 5, 1, ONCE_OF_FIVE),
    ("doc3@disputationi", 1, 5, 1, ONCE_OF_FIVE),
    ("doc3@id", 1, 5, 1, ONCE_OF_FIVE),
    ("doc3@persius", 1, 5, 1, ONCE_OF_FIVE),
    ("doc3@simul", 1, 5, 1, ONCE_OF_FIVE),
]


def corpus(spark, texts, **known) -> Corpus:
    """A corpus from a dict of one text per document, or a list of rows."""
    if isinstance(texts, dict):
        known.setdefault("one_row_per_document", True)
        texts = list(texts.items())
    return Corpus(spark.createDataFrame(texts, "document string, text string"), **known)


def weights(weighted) -> dict:
    """key -> (word_count, doc_size, df, tfidf to ten places)"""
    return {
        f"{r.document}@{r.word}": (r.word_count, r.doc_size, r.df, round(r.tfidf, 10))
        for r in weighted.collect()
    }
