"""The registered queries in SQL, written from the definitions and not from the
Spark plans: plain grouping and windows over exploded words."""

WS = r"[ \t\n\x0B\f\r]+"


def _whitespace(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{WS}'), lambda w: w <> '')"


def _java_split(text: str, run: str) -> str:
    cut = f"regexp_replace({text}, '{run}\\z', '')"
    return (
        f"CASE WHEN {text} <> '' AND {cut} = '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE string_split_regex({cut}, '{run[:-1] if run == ' +' else run}') END"
    )


def _java_ws(text: str) -> str:
    trim = r"regexp_replace(w, '^[\x00-\x20]+|[\x00-\x20]+\z', '', 'g')"
    return f"list_transform({_java_split(text, WS)}, lambda w: {trim})"


def _single_space(text: str) -> str:
    ends = r"\r\n|\n|\r"
    lines = f"string_split_regex(regexp_replace({text}, '({ends})\\z', ''), '{ends}')"
    return (
        f"CASE WHEN {text} = '' THEN CAST([] AS VARCHAR[]) ELSE "
        f"flatten(list_transform({lines}, lambda l: {_java_split('l', ' +')})) END"
    )


MESSY = "concat('  ', replace(replace(text, ' ', '  '), ',', chr(9)), ' ', chr(1))"


def _tokens(source: str, split: str) -> str:
    """CTEs: corpus(document, text) and tokens(document, word)."""
    return (
        f"WITH corpus AS ({source}), "
        f"tokens AS (SELECT document, unnest({split}) AS word FROM corpus)"
    )


def _weights(source: str, split: str) -> str:
    """Further CTEs: the counts and totals of each pair, and of each word."""
    return _tokens(source, split) + (
        ", counts AS (SELECT document, word, count(*) AS word_count"
        " FROM tokens GROUP BY document, word)"
        ", pairs AS (SELECT document, word, word_count,"
        " CAST(sum(word_count) OVER (PARTITION BY document) AS BIGINT) AS doc_size,"
        " (SELECT count(DISTINCT document) FROM corpus) AS num_docs,"
        " count(*) OVER (PARTITION BY word) AS df FROM counts)"
        ", weights AS (SELECT *, word_count / doc_size AS tf, ln(num_docs / df) AS idf,"
        " (word_count / doc_size) * ln(num_docs / df) AS tfidf FROM pairs) "
    )


def _corpus(table: str, document: str, text: str) -> str:
    return f"SELECT CAST({document} AS VARCHAR) AS document, {text} AS text FROM {table}"


DOCUMENTS = _corpus("documents", "doc_id", "text")
MESSY_DOCUMENTS = _corpus("documents", "doc_id", MESSY)
CONVERSATIONS = _corpus("conversations", "conv_id", "text")
PAGES = _corpus("pages", "page_id", "html")
BENCHMARK = _corpus("benchmark", "item_id", "text")

CLEAN = _weights(DOCUMENTS, _whitespace("text"))
LINES = _weights(CONVERSATIONS, _whitespace("text"))

WIDE = (
    "SELECT document, word, word_count, doc_size, num_docs, df,"
    " round(tf, 10) AS tf, round(idf, 10) AS idf, round(tfidf, 10) AS tfidf FROM weights"
)
TF = "SELECT document, word, word_count, doc_size, round(tf, 10) AS tf FROM weights"
SIZED_TOKENS = (
    " SELECT document, count(*) OVER (PARTITION BY document) AS doc_size, word FROM tokens"
)
DOC_SIZES = (
    " SELECT c.document, count(t.word) AS doc_size"
    " FROM (SELECT DISTINCT document FROM corpus) c LEFT JOIN tokens t USING (document)"
    " GROUP BY c.document"
)
WORD_COUNTS = "SELECT document, word, word_count FROM counts"
DOC_FREQS = "SELECT word, count(*) AS df FROM counts GROUP BY word"
WORD_TOTALS = "SELECT word, count(*) AS total FROM tokens GROUP BY word"
# The registered indexes put 150 entries to a block.
DIGEST = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"
# As many blocks as the smallest power of two that suffices.
BLOCKS = "CAST(pow(2, ceil(log2(ceil({0} / 150)))) AS BIGINT)"
POSTINGS = (
    f", blocked AS (SELECT *, {BLOCKS.format('df')} AS blocks FROM weights),"
    f" dealt AS (SELECT *, {DIGEST.format('document')} % blocks AS block FROM blocked)"
    " SELECT word, df, block, blocks, string_agg("
    "document || ':' || word_count || '/' || doc_size, ',' ORDER BY document) AS postings"
    " FROM dealt GROUP BY word, df, block, blocks"
)
WHOLE_POSTINGS = (
    ", dealt AS (SELECT *, CAST(0 AS BIGINT) AS block, CAST(1 AS BIGINT) AS blocks FROM weights)"
    " SELECT word, df, block, blocks, string_agg("
    "document || ':' || word_count || '/' || doc_size, ',' ORDER BY document) AS postings"
    " FROM dealt GROUP BY word, df, block, blocks"
)
FORWARD = (
    ", counted AS (SELECT *, count(*) OVER (PARTITION BY document) AS words FROM weights),"
    f" blocked AS (SELECT *, {BLOCKS.format('words')} AS blocks FROM counted),"
    f" dealt AS (SELECT *, {DIGEST.format('word')} % blocks AS block FROM blocked)"
    " SELECT document, doc_size, block, blocks,"
    " string_agg(word || '=' || word_count, ' ' ORDER BY word) AS words"
    " FROM dealt GROUP BY document, doc_size, block, blocks"
)


def _named_sizes() -> str:
    """Sizes of the documents of a folder of numbered files."""
    name = "'part-' || lpad(CAST(doc_id % 64 AS VARCHAR), 5, '0')"
    return _tokens(f"SELECT {name} AS document, text FROM documents", _whitespace("text")) + DOC_SIZES


def _headed_words() -> str:
    """Words of the numbered files, each headed by white space."""
    name = "'part-' || lpad(CAST(doc_id % 64 AS VARCHAR), 5, '0')"
    words = _tokens(f"SELECT {name} AS document, text FROM documents", _whitespace("text"))
    every = "SELECT DISTINCT document, '' AS word FROM corpus UNION ALL SELECT document, word FROM tokens"
    return words + f" SELECT document, word, count(*) AS word_count FROM ({every}) GROUP BY document, word"


ORACLES = {
    "corpus": DOCUMENTS,
    "num_docs": "SELECT count(*) AS num_docs FROM documents",
    "num_docs_lines": "SELECT count(DISTINCT conv_id) AS num_docs FROM conversations",
    "tokens": _tokens(DOCUMENTS, _whitespace("text")) + SIZED_TOKENS,
    "tokens_java_ws": _tokens(MESSY_DOCUMENTS, _java_ws("text")) + SIZED_TOKENS,
    "tokens_single_space": _tokens(MESSY_DOCUMENTS, _single_space("text")) + SIZED_TOKENS,
    "word_count": CLEAN + WORD_COUNTS,
    "word_count_lines": LINES + WORD_COUNTS,
    "doc_size": _tokens(DOCUMENTS, _whitespace("text")) + DOC_SIZES,
    "doc_size_lines": _tokens(CONVERSATIONS, _whitespace("text")) + DOC_SIZES,
    "vocabulary": CLEAN + "SELECT DISTINCT word FROM tokens",
    "doc_freq": CLEAN + DOC_FREQS,
    "doc_freq_lines": LINES + DOC_FREQS,
    "tf": CLEAN + TF,
    "tf_lines": LINES + TF,
    "idf": CLEAN + "SELECT DISTINCT word, num_docs, df, round(idf, 10) AS idf FROM weights",
    "pair_doc_freq": CLEAN + "SELECT document, word, word_count, doc_size, df FROM pairs",
    "tfidf": CLEAN + WIDE,
    "tfidf_join": CLEAN + WIDE,
    "tfidf_broadcast": CLEAN + WIDE,
    "tfidf_union": CLEAN + "SELECT document, word, round(tfidf, 10) AS tfidf FROM weights",
    "tfidf_java_ws": _weights(MESSY_DOCUMENTS, _java_ws("text")) + WIDE,
    "tfidf_single_space": _weights(MESSY_DOCUMENTS, _single_space("text")) + WIDE,
    "tfidf_lines": LINES + WIDE,
    "tfidf_pages": _weights(PAGES, _whitespace("text")) + WIDE,
    "tfidf_benchmark": _weights(BENCHMARK, _whitespace("text")) + WIDE,
    "postings": CLEAN + POSTINGS,
    "postings_expand": CLEAN + "SELECT word, document, num_docs, df FROM pairs",
    "postings_split": CLEAN + POSTINGS,
    "postings_whole": CLEAN + WHOLE_POSTINGS,
    "forward_index": CLEAN + FORWARD,
    "forward_index_merged": CLEAN + FORWARD,
    "forward_index_lines": LINES + FORWARD,
    "tf_report": CLEAN
    + "SELECT word || '@' || document AS key, word_count || '/' || doc_size AS value FROM pairs",
    "idf_report": CLEAN
    + "SELECT word || '@' || document AS key, num_docs || '/' || df AS value FROM pairs",
    "tfidf_report": CLEAN
    + "SELECT document || '@' || word AS key, printf('%.10f', tfidf) AS value FROM weights",
    "report_lines": CLEAN
    + "SELECT document || '@' || word || chr(9) || printf('%.10f', tfidf) AS line FROM weights",
    "tf_stored": CLEAN + TF,
    "text_lines_named": _named_sizes(),
    "text_folder_written_twice": CLEAN + WORD_TOTALS,
    "text_lines_java_ws": _headed_words(),
    "tf_report_shortest": CLEAN
    + "SELECT word || '@' || document AS key, CAST(1000 * word_count / doc_size AS VARCHAR) AS value FROM pairs",
    "text_files_word_totals": CLEAN + WORD_TOTALS,
    "text_lines_word_totals": CLEAN + WORD_TOTALS,
}
