import re

import numpy as np
import pytest

from termloom.llm import pii
from termloom.llm.queries import QUERIES
from tests.llm import plain


def plain_spans(text: str) -> list:
    """The four forms by their patterns as they are stated."""
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    ip = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
    spans = [("email", *m.span()) for m in re.finditer(email, text)]
    spans += [("ip", *m.span()) for m in re.finditer(ip, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        double = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and double % 10 == 0:
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


TEXTS = [
    None,
    "",
    "a.b+c@x-y.org a@b a@b.c@d.ef.g @x.y one@two.three_four@five.six a@@b.cd",
    "1.2.3.4.5.6.7.8 256.1.1.1 0000000255.01.2.3 1..2.3.4 12.34.56 9.9.9.9",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 00000000000000 12345678901234567890",
    "+1 (017) 555-7713 +12 +1234567890123456 +4917012345678. call +1-2 ++15551234567 ٣+1٣",
    "é🙂é j@k.lm 10.0.0.1",
    "a" * 3000 + "@" + "b" * 3000 + " " + "1" * 3000 + ".2.3 " + "1." * 2000,
]


def test_known_spans_are_those_of_the_patterns():
    for text in filter(None, TEXTS):
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.known_spans(text)] == plain_spans(text)


@pytest.fixture(scope="module")
def trained(spark):
    texts = [f"call +1 (555) 0{i:02}-7713 or mail user{i}@mail.org from 10.0.{i}.7 in room {i}; once more +1 (555) 0{i:02}-7713 for room {i}" for i in range(60)]
    texts += [f"room {i} and lot {i * 37} of 20{i:02}" for i in range(60)]
    return pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))


def test_repeated_words_share_their_label(trained):
    alone = trained.spans(["write to x 0037713 today"])[1][0]
    text = "call +1 (555) 003-7713 now. Later: 0037713 again."
    known, found = (spans[0] for spans in trained.spans([text]))
    assert alone == [] and len(known) == 1
    assert [(k, text[a:b]) for k, a, b in found] == [(3, "+1 (555) 003-7713"), (3, "0037713")]


@pytest.mark.parametrize("before", [0, 1, 25, 49])
def test_many_mentions_share_their_label(trained, before):
    bare = " Later: 0037713 again."
    text = bare * before + " call +1 (555) 003-7713 now." + bare * (50 - before)
    found = trained.spans([text, "room 12 of 2024"])[1]
    assert [text[a:b] for k, a, b in found[0] if k == 3].count("0037713") == 50 and len(found[0]) == 51
    assert found[1] == []


def test_messages_go_on_until_they_rest(trained):
    words = " ".join(f"n{i}" for i in range(400))
    long = trained.marginals(pii.Graph(["+1 (555) 003-7713 " + words]))
    field = pii.Field()
    field.chain = np.eye(pii.LABELS) * 9.0
    far = field.marginals(pii.Graph(["+1 (555) 003-7713 " + words]))
    assert np.isfinite(long).all() and far[:60].argmax(axis=1).tolist() == [4] * 60


def test_clean_texts_stay_clean(trained):
    assert trained.spans(["room 12 of 2024, lot 99", "no digits at all", ""])[1] == [[], [], []]


def test_rows_edges_and_redaction(spark, trained):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[6], "x", 1), (6, TEXTS[6], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, known string, kind int")
    got = pii.find_pii(docs, ["doc_id"], trained).collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[6 if r.doc_id is None else r.doc_id] or ""
        assert [tuple(s) for s in r.known] == plain_spans(text)
        assert {tuple(s) for s in r.known} <= {tuple(s) for s in r.found}
    clean = {r.doc_id: r.redacted for r in pii.redacted(docs, ["doc_id"], trained).collect()}
    assert clean[6] == "é🙂é [EMAIL] [IP]" and clean[0] == ""
    assert pii.find_pii(docs.limit(0), ["doc_id"]).count() == 0


def test_query_over_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op2_pii"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == plain.digest(spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in pii.KINDS)
        assert {":".join(map(str, s)) for s in spans} <= set(r.spans.split(","))


def test_words_are_read_whole_and_texts_alone():
    long = "y" * 90 + "5550037713"
    [few], [many] = (pii.Graph([t]).attributes.tolist() for t in ("y5550037713", long))
    assert few[0] == many[0] == 5
    texts = ["call +1 (555) 003-7713 now, then " + " and ".join(["0037713"] * 40) + " " + long, "0037713 0037713", "card 4111 1111 1111 1111 or 1111111"] * 2
    field = pii.Field()
    rng = np.random.default_rng(2)
    for table in (*field.unary, field.chain, field.skip):
        table += rng.normal(size=table.shape)
    together = field.spans(texts)[1]
    assert together == [field.spans([t])[1][0] for t in texts]
