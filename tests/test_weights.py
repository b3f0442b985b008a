import random
from collections import Counter
from math import log

import pytest

from termloom import operators, plans
from termloom.functions import render
from termloom.sinks import store
from tests.samples import SAMPLE, SAMPLE_WEIGHTS, corpus, weights

FORMS = {
    "plain": plans.tfidf,
    "split": lambda c: plans.tfidf(c, split_rows=1),
    "broadcast": plans.tfidf_broadcast,
    "not broadcast": lambda c: plans.tfidf_broadcast(c, max_words=0),
}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("one_row", [True, False])
def test_sample(spark, form, one_row):
    weighted = FORMS[form](corpus(spark, SAMPLE, one_row_per_document=one_row))
    assert weighted.columns == [
        "document", "word", "word_count", "doc_size", "num_docs", "df", "tf", "idf", "tfidf",
    ]
    rows = {f"{r.document}@{r.word}": r for r in weighted.collect()}
    assert len(rows) == 15
    for key, word_count, doc_size, df, value in SAMPLE_WEIGHTS:
        r = rows[key]
        assert (r.word_count, r.doc_size, r.num_docs, r.df) == (word_count, doc_size, 3, df)
        assert r.tfidf == pytest.approx(value, abs=1e-15)
        assert r.tf == word_count / doc_size
        assert r.idf == pytest.approx(log(3 / df), abs=1e-15)


@pytest.mark.parametrize("mode", ["java_ws", "single_space"])
def test_sample_is_the_same_in_every_mode(spark, mode):
    found = weights(plans.tfidf(corpus(spark, SAMPLE), mode))
    assert found == {k: (n, s, d, round(v, 10)) for k, n, s, d, v in SAMPLE_WEIGHTS}


def test_union_form(spark):
    rows = plans.tfidf_union(corpus(spark, SAMPLE)).collect()
    found = {f"{r.document}@{r.word}": r.tfidf for r in rows}
    assert found == pytest.approx({k: v for k, _, _, _, v in SAMPLE_WEIGHTS}, abs=1e-15)


def test_stored_frequencies(spark, tmp_path):
    c = corpus(spark, SAMPLE)
    kept = store(operators.doc_freqs(c), str(tmp_path / "df"))
    expected = weights(plans.tfidf(c))
    assert weights(plans.tfidf(c, frequencies=kept)) == expected
    assert weights(plans.tfidf(c, split_rows=1, frequencies=kept)) == expected


def test_sample_stages(spark):
    c = corpus(spark, SAMPLE)
    assert operators.vocabulary(c).count() == 14
    assert {r.word: r.df for r in operators.doc_freqs(c).collect()}["ipsum"] == 2
    index = {r.word: r for r in operators.postings(c).collect()}
    assert index["ipsum"].df == 2
    assert [tuple(p) for p in index["ipsum"].postings] == [("doc1", 3, 6), ("doc2", 1, 6)]
    tf = {(r.key, r.value) for r in plans.tf_report(operators.term_counts(c)).collect()}
    assert {("Lorem@doc1", "1/6"), ("ipsum@doc1", "3/6"), ("dolor@doc1", "1/6")} <= tf
    idf = {(r.key, r.value) for r in plans.idf_report(plans.tfidf(c)).collect()}
    assert {("ipsum@doc1", "3/2"), ("ipsum@doc2", "3/2"), ("sit@doc1", "3/1")} <= idf
    assert len(tf) == len(idf) == 15


def test_report_order_and_formats(spark):
    weighted = plans.tfidf(corpus(spark, SAMPLE))
    exact = plans.tfidf_report(weighted).collect()
    assert [r.key for r in exact] == [w[0] for w in SAMPLE_WEIGHTS]
    for r, w in zip(exact, SAMPLE_WEIGHTS):
        assert float(r.value) == pytest.approx(w[4], abs=1e-15)
    fixed = {r.key: r.value for r in plans.tfidf_report(weighted, render.fixed).collect()}
    # Sixteen decimals; the last one depends on the logarithm's last bit.
    for key, _, _, _, value in SAMPLE_WEIGHTS:
        assert len(fixed[key]) == len("0.") + 16
        assert float(fixed[key]) == pytest.approx(value, abs=1e-15)
    assert fixed["doc1@ipsum"] == "0.2027325540540822"


# Corpora for single rules, with key: word_count, doc_size, df, tfidf.
RULES = {
    "words in every document keep their zero rows": (
        {"p": "x y", "q": "x z", "r": "x y y"},
        {
            "p@x": (1, 2, 3, 0), "p@y": (1, 2, 2, 0.2027325541),
            "q@x": (1, 2, 3, 0), "q@z": (1, 2, 1, 0.5493061443),
            "r@x": (1, 3, 3, 0), "r@y": (2, 3, 2, 0.2703100721),
        },
    ),
    "delimiters inside words": (
        {"p": "me@x.org a=b", "q": "a=b c/d", "r": "c,d"},
        {
            "p@a=b": (1, 2, 2, 0.2027325541), "p@me@x.org": (1, 2, 1, 0.5493061443),
            "q@a=b": (1, 2, 2, 0.2027325541), "q@c/d": (1, 2, 1, 0.5493061443),
            "r@c,d": (1, 1, 1, 1.0986122887),
        },
    ),
    "documents without words count": (
        {"p": "a a b", "q": "", "r": "   "},
        {"p@a": (2, 3, 1, 0.7324081924), "p@b": (1, 3, 1, 0.3662040962)},
    ),
    "a document without a text counts": (
        {"p": "a a b", "q": None, "r": "   "},
        {"p@a": (2, 3, 1, 0.7324081924), "p@b": (1, 3, 1, 0.3662040962)},
    ),
    "case and punctuation are kept": (
        {"p": "Foo foo foo, FOO", "q": "foo"},
        {
            "p@FOO": (1, 4, 1, 0.1732867951), "p@Foo": (1, 4, 1, 0.1732867951),
            "p@foo,": (1, 4, 1, 0.1732867951), "p@foo": (1, 4, 2, 0), "q@foo": (1, 1, 2, 0),
        },
    ),
    "one document": ({"p": "a b"}, {"p@a": (1, 2, 1, 0), "p@b": (1, 2, 1, 0)}),
}


@pytest.mark.parametrize("rule", RULES)
@pytest.mark.parametrize("one_row", [True, False])
def test_rules(spark, rule, one_row):
    texts, expected = RULES[rule]
    c = corpus(spark, texts, one_row_per_document=one_row)
    assert weights(plans.tfidf(c, split_rows=1)) == expected
    assert operators.num_docs(c).first().num_docs == len(texts)


def test_report_is_sorted_by_the_whole_key(spark):
    c = corpus(spark, {"doc1": "b a", "doc2": "a", "doc10": "a c"})
    keys = [r.key for r in plans.tfidf_report(plans.tfidf(c)).collect()]
    assert keys == ["doc10@a", "doc10@c", "doc1@a", "doc1@b", "doc2@a"]


def test_rows_of_a_document_are_merged(spark):
    rows = [("p", "a b"), ("p", "a"), ("q", "b")]
    expected = {"p@a": (2, 3, 1, 0.4620981204), "p@b": (1, 3, 2, 0), "q@b": (1, 1, 2, 0)}
    assert weights(plans.tfidf(corpus(spark, rows))) == expected
    assert weights(plans.tfidf(corpus(spark, rows), split_rows=1)) == expected


def test_long_words_and_many_words(spark):
    long_word = "w" * 5000
    many = " ".join(f"n{i}" for i in range(10_000))
    found = weights(plans.tfidf(corpus(spark, {"p": long_word, "q": many})))
    assert len(found) == 10_001
    assert found[f"p@{long_word}"][:3] == (1, 1, 1)
    assert found["q@n9999"][:3] == (1, 10_000, 1)


def test_rows_without_a_document_name_are_one_document(spark):
    found = weights(plans.tfidf(corpus(spark, [(None, "a"), (None, "a b"), ("p", "b")])))
    assert {k: v[:3] for k, v in found.items()} == {
        "@a": (2, 3, 1), "@b": (1, 3, 2), "p@b": (1, 1, 2),
    }


def brute_force(rows):
    counts, docs = {}, set()
    for document, text in rows:
        docs.add(document)
        counts.setdefault(document, Counter()).update(text.split())
    df = Counter(w for c in counts.values() for w in c)
    return {
        f"{d}@{w}": (n, c.total(), df[w], round(n / c.total() * log(len(docs) / df[w]), 10))
        for d, c in counts.items()
        for w, n in c.items()
    }


@pytest.mark.parametrize("split_rows", [1, 7, 1_000_000])
@pytest.mark.parametrize("partitions", [1, 5])
def test_against_brute_force(spark, split_rows, partitions):
    """A third of all rows are one document, and one word is everywhere."""
    rng = random.Random(split_rows)
    rows = []
    for i in range(300):
        document = "big" if i % 3 == 0 else f"d{rng.randrange(60)}"
        text = " ".join(f"w{int(rng.paretovariate(0.7)) % 90}" for _ in range(rng.randrange(12)))
        rows.append((document, text + " the"))
    c = corpus(spark, rows)
    c = type(c)(c.rows.repartition(partitions))
    weighted = plans.tfidf(c, split_rows=split_rows)
    expected = brute_force(rows)
    found = weights(weighted)
    assert weighted.count() == len(found) == len(expected)
    assert {k: v[:3] for k, v in found.items()} == {k: v[:3] for k, v in expected.items()}
    for key, row in found.items():
        assert row[3] == pytest.approx(expected[key][3], abs=1e-9)


def test_totals_agree(spark):
    texts = {f"d{i}": " ".join(f"w{i % k}" for k in range(1, i + 2)) for i in range(40)}
    rows = plans.tfidf(corpus(spark, texts)).collect()
    by_document = {}
    for r in rows:
        by_document.setdefault(r.document, []).append(r)
        assert 1 <= r.df <= r.num_docs == 40
        assert r.tfidf >= 0
    for members in by_document.values():
        assert sum(r.word_count for r in members) == members[0].doc_size
        assert sum(r.tf for r in members) == pytest.approx(1)
