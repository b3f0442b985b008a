"""The corpus: documents and their texts."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.tokenize import WHITESPACE


def _named(rows: DataFrame) -> DataFrame:
    return rows.select(F.coalesce("document", F.lit("")).alias("document"), "text")


@dataclass(frozen=True)
class Corpus:
    """``rows(document STRING, text STRING)`` and what is known about them.

    ``one_row_per_document``: no two rows share a document, so a document's
    statistics can be computed inside its row. If this is not known, rows with
    the same document are merged, which is always right but needs a shuffle.

    ``rows_are_lines``: each row is one line of a file, so an empty text is a
    blank line rather than an empty document.

    ``leading``: of rows that are lines, a row with an empty text for each file whose text
    is empty or has white space before its first word. The words that ``java_ws`` finds there
    belong to no line.

    ``names``: the names of all documents, repeats allowed, where they are known
    without reading the texts.

    A NULL text has no words, but its document counts. Rows with a NULL document
    belong to the document named by the empty string.
    """

    rows: DataFrame
    one_row_per_document: bool = False
    rows_are_lines: bool = False
    names: DataFrame | None = None
    leading: DataFrame | None = None

    def __post_init__(self):
        missing = {"document", "text"} - set(self.rows.columns)
        if missing:
            raise ValueError(f"corpus rows lack the columns {sorted(missing)}")

    def require_unique_documents(self) -> "Corpus":
        """Raise if ``one_row_per_document`` is claimed and wrong; reads the names once."""
        if self.one_row_per_document:
            twice = self.texts.groupBy("document").count().where("count > 1").first()
            if twice is not None:
                raise ValueError(f"document {twice.document!r} has {twice['count']} rows")
        return self

    @property
    def texts(self) -> DataFrame:
        """The rows with a document that is never NULL.

        Besides its meaning this spares the optimizer from filtering NULLs in
        just some uses of the rows, which would keep shuffles from being reused.
        """
        return _named(self.rows)

    def texts_for(self, mode: str) -> tuple[DataFrame, bool]:
        """The rows as ``mode`` takes them, and if each is a line of a text.

        Lines have the words of ``java_ws`` as texts of their own, less the empty words that
        white space before the first word of each would give.
        """
        if mode != "java_ws" or not self.rows_are_lines:
            return self.texts, self.rows_are_lines
        if self.leading is None:
            raise ValueError("mode java_ws needs whole texts, or lines whose place in their file is known")
        bare = F.ltrim("text", F.lit(WHITESPACE))
        lines = self.texts.withColumn("text", F.when(bare != "", bare))
        return lines.unionByName(_named(self.leading)), False
