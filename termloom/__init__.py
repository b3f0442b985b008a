"""Term statistics and weights of document collections, on Spark."""

from termloom.corpus import Corpus
from termloom.session import build_session

__all__ = ["Corpus", "build_session"]
