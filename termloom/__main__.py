"""Weigh a corpus and write a sorted text report.

    spark-submit --py-files termloom.zip termloom/__main__.py SOURCE TARGET
"""

import argparse

from termloom import operators, plans, sinks, sources
from termloom.functions import render
from termloom.functions.tokenize import MODES
from termloom.session import build_session


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="termloom", description=__doc__.splitlines()[0])
    parser.add_argument("source", help="a directory of text files, or a table")
    parser.add_argument("target", help="the directory to write, replaced if it exists")
    parser.add_argument("--mode", choices=MODES, default="whitespace", help="what a word is")
    parser.add_argument("--report", choices=("tfidf", "tf", "idf"), default="tfidf")
    parser.add_argument("--fixed", action="store_true", help="write weights with 16 decimals")
    parser.add_argument("--lines", action="store_true", help="read files by line, for large files")
    parser.add_argument("--table", metavar="FORMAT", help="read a table, such as parquet")
    parser.add_argument("--document", default="document", help="its column of document names")
    parser.add_argument("--text", default="text", help="its column of texts")
    parser.add_argument("--unique", action="store_true", help="its document names are a key")
    parser.add_argument("--check-unique", action="store_true", help="fail if --unique is not true")
    options = parser.parse_args(argv)
    if options.lines and options.mode == "java_ws":
        parser.error("--mode java_ws needs whole files, not --lines")
    return options


def run(spark, options: argparse.Namespace) -> None:
    if options.table:
        corpus = sources.table_corpus(
            spark, options.source, options.document, options.text, options.unique, options.table
        )
    elif options.lines:
        corpus = sources.text_lines(spark, options.source)
    else:
        corpus = sources.text_files(spark, options.source)
    if options.check_unique:
        corpus.require_unique_documents()
    if options.report == "tf":
        report = plans.tf_report(operators.term_counts(corpus, options.mode)).orderBy("key")
    elif options.report == "idf":
        report = plans.idf_report(plans.tfidf(corpus, options.mode)).orderBy("key")
    else:
        rendered = render.fixed if options.fixed else render.shortest
        report = plans.tfidf_report(plans.tfidf(corpus, options.mode), rendered)
    sinks.write_report(report, options.target)


if __name__ == "__main__":
    run(build_session(), arguments())
