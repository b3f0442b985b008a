"""Reports that are written range by range of the documents."""

import random

import __spark_entry__ as entries
from termloom import plans
from termloom.plans import ranges
from tests.samples import corpus

SF = "/root/testdata/sf0.001"
NAMES = ["", "@", "a", "a@", "a@b", "a@b@c", "a!", "b", "doc1", "doc10", "doc1@a", "doc2", "é", "z\x00", "\U0001f600", "￿"]


def rows(report) -> list:
    return [(r.key, r.value) for r in report.collect()]


def test_ranges_follow_each_other_in_the_order_of_keys(spark, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_BYTES", 40)
    rng = random.Random(1)
    texts = {name: " ".join(rng.choices(["a", "@", "b@c", "!", "é", "zz"], k=9)) for name in NAMES}
    for documents, known in ((texts, {}), ([*texts.items(), *texts.items(), (None, "a b"), ("b", None)], {})):
        c = corpus(spark, documents, **known)
        weighted = plans.tfidf(c)
        wanted = plans.document_ranges(c)
        assert 2 < len(wanted) <= ranges.MOST_RANGES
        parts = [rows(plans.tfidf_report(weighted.where(w))) for w in wanted]
        assert sum(map(bool, parts)) > 2
        assert [r for part in parts for r in part] == rows(plans.tfidf_report(weighted))


def test_few_texts_are_one_range(spark):
    assert len(plans.document_ranges(corpus(spark, {"a": "b c"}))) == 1
    assert len(plans.document_ranges(corpus(spark, []))) == 1


def test_report_lines_are_written_by_ranges(spark, monkeypatch):
    """No pass has the pairs of all documents, and the lines on disk are compressed."""
    monkeypatch.setattr(ranges, "RANGE_BYTES", 50_000)
    lines = entries.queries()["report_lines"](spark, SF)
    files = lines.inputFiles()
    assert len({f.rsplit("/", 2)[-2] for f in files}) > 2 and all(f.endswith(".gz") for f in files)
    whole = plans.tfidf_report(plans.tfidf(entries.documents(spark, SF)), entries._ten_places)
    assert sorted(r.line for r in lines.collect()) == sorted(f"{k}\t{v}" for k, v in rows(whole))
