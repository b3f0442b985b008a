import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from termloom.llm import quality_rules as rules
from termloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n int, x0 double, grouped string, kept string"


def counts(text):
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    repeated = {i + k for i, window in enumerate(windows) if often[window] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(repeated)


def vector(n, chars, symbols, lines, dup, repeated):
    return math.log(n), math.log(chars / n), math.log1p(100 * symbols / n), dup / lines, repeated / n


def failed(c):
    return c[0] < 20 or 100 * c[5] > 30 * c[0]


def plain_usual(points):
    """Mean and covariance by concentration from many random starts, with sorted distances."""
    x, rng = np.array(points), np.random.default_rng(0)
    h, floor = math.ceil(0.75 * len(x)), np.diag(np.array(rules.LEAST_SPREAD) ** 2)
    factor = rules._consistency(0.75)
    best = None
    for _ in range(30):
        near = rng.choice(len(x), 12, replace=False)
        for _ in range(30):
            mean, covariance = x[near].mean(axis=0), factor * np.cov(x[near].T, bias=True) + floor
            d = np.einsum("ij,ij->i", x - mean, np.linalg.solve(covariance, (x - mean).T).T)
            near = np.argsort(d, kind="stable")[:h]
        made = np.linalg.slogdet(factor * np.cov(x[near].T, bias=True) + floor)[1]
        if best is None or made < best[0]:
            best = made, d
    near = best[1] <= rules._quantile(0.975, 5)
    mean, covariance = x[near].mean(axis=0), rules._consistency(0.975) * np.cov(x[near].T, bias=True) + floor
    return mean, np.linalg.inv(covariance)


def plain_verdicts(rows):
    """distance of each row, None if it failed or cannot be compared, by the groups and pools of the docstring."""
    made = [counts(r[1]) for r in rows]
    vectors = [None if failed(c) else vector(*c) for c in made]
    own = {}
    for r, v in zip(rows, vectors):
        if v:
            own.setdefault((r[2], r[3]), set()).add(v)
    rest = Counter()
    for (lang, _), points in own.items():
        rest[lang] += len(points) if len(points) < rules.LEAST_ROWS else 0
    of = {k: k if len(p) >= rules.LEAST_ROWS else k[:1] if rest[k[0]] >= rules.LEAST_ROWS else () for k, p in own.items()}
    pooled = {}
    for k, points in own.items():
        pooled.setdefault(of[k], []).extend(points)
    usual = {k: plain_usual(p) for k, p in pooled.items() if len(p) >= rules.LEAST_ROWS}
    found = []
    for r, v in zip(rows, vectors):
        known = usual.get(of[r[2], r[3]]) if v else None
        found.append(None if known is None else float((np.array(v) - known[0]) @ known[1] @ (np.array(v) - known[0])))
    return made, found


def compare(got, rows):
    made, distances = plain_verdicts(rows)
    by_id = {r[0]: (c, d) for r, c, d in zip(rows, made, distances)}
    assert len(got) == len(rows)
    ratios = []
    for r in got:
        c, d = by_id[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (*c[:3], *c[4:])
        assert r.base_failed == failed(c)
        if d is None:
            assert r.distance is None and r.kept == (not r.base_failed)
        else:
            assert r.kept == (r.distance <= rules.CUTOFF)
            ratios.append((r.distance + 1) / (d + 1))
            if not rules.CUTOFF / 1.2 < d < rules.CUTOFF * 1.2:
                assert r.kept == (d <= rules.CUTOFF)
    return ratios


@pytest.fixture(scope="module")
def whole(spark):
    return QUERIES["op13_quality_rules"](spark, SF).collect()


def test_query_over_the_whole_table(spark, whole):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    ratios = compare(whole, rows)
    assert np.median(np.abs(np.log(ratios))) < 0.05


def test_clean_documents_stay_and_bad_ones_go(spark, whole):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id: r.kept for r in whole}
    passed = {r.doc_id for r in whole if not r.base_failed}
    assert all(kept[i] for i, q in labels.items() if q == 1 and i in passed)
    bad = [kept[i] for i, q in labels.items() if q == 0]
    assert sum(bad) <= 0.05 * len(bad)


def test_base_columns_agree_with_sql(spark):
    small = "/root/testdata/sf0.001"
    got = rules.counted(spark.read.parquet(f"{small}/documents.parquet"), ["doc_id"]).drop("n_lines", "base_failed").collect()
    con = duckdb.connect()
    space = r"[\x20\x09-\x0D]+"
    want = con.execute(rf"""
        WITH w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '{space}'), lambda x: x <> '') AS w FROM '{small}/documents.parquet'),
        grams AS (SELECT doc_id, w[i:i + 7] AS gram, i FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
        twice AS (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM grams WHERE (doc_id, gram) IN
            (SELECT doc_id, gram FROM grams GROUP BY ALL HAVING count(*) > 1)),
        covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM twice GROUP BY doc_id),
        lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
        dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id)
        SELECT doc_id, len(w), len(array_to_string(w, '')), len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), coalesce(dup.n, 0), coalesce(covered.n, 0)
        FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)""").fetchall()
    assert sorted(want) == sorted(map(tuple, got))


def text_of(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(n))


def test_edges_copies_and_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    clean = [(i, text_of(rng, int(rng.integers(30, 300))), "en", "hot") for i in range(120)]
    copies = [(200 + i, clean[0][1], "en", "hot") for i in range(150)]
    few = [(400 + i, text_of(rng, 60), "en", f"s{i % 9}") for i in range(63)]
    alone = [(500, text_of(rng, 60) + "".join(f" ${i}$" for i in range(60)), None, None), (501, text_of(rng, 80), "xx", None)]
    passage = text_of(rng, 8)
    odd = [
        (600, clean[1][1].replace(" ", "$$$ "), "en", "hot"),
        (601, clean[2][1].upper().replace(" ", "zzzzzzzzzzzzzzz "), "en", "hot"),
        (602, text_of(rng, 70) + " ###" * 30, "en", "s1"),
        (603, None, "en", "hot"), (604, "", "en", "hot"), (605, " \n\t", None, "s"), (606, "a " * 40, "en", "hot"),
        (607, f"{passage}\n{text_of(rng, 90)}\n{passage}\r\n{text_of(rng, 20)}\n{passage}", "en", "hot"),
        (608, (text_of(rng, 20_000) + "\n") * 2, "en", "hot"), (609, "x" * 300_000 + " y" * 7, "en", "hot"),
        (610, "one two three four five six seven", "en", "hot"),
    ]
    rows = [*clean, *copies, *few, *alone, *odd]
    frame = spark.createDataFrame([(*r, 1, 0.5, "clash", "clash") for r in [*rows, rows[0], (None, *rows[3][1:])]], SCHEMA).repartition(5)
    got = rules.judged(frame).collect()
    assert len(got) == len(rows) + 2
    once = {r.doc_id: r for r in got}
    compare([once[r[0]] for r in rows], rows)
    assert [r.kept for r in got if r.doc_id in (None, 3)] == [True, True]
    assert not [once[i] for i in (*range(120), *range(200, 350), *range(400, 463), 500, 501) if not once[i].kept]
    assert not [once[i] for i in (*range(600, 607), 608, 609, 610) if once[i].kept]
    monkeypatch.setattr(rules, "SENT_GROUPS", 0)
    by_shuffle = rules.judged(frame).collect()
    rounded = lambda rows: sorted((str(r[:-1]), round(r.distance or -1, 6)) for r in rows)
    assert rounded(by_shuffle) == rounded(got)


def test_no_rows(spark):
    assert rules.judged(spark.createDataFrame([], SCHEMA)).collect() == []


def test_chi_square():
    # Fixed values from tables of the distribution.
    assert rules._quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-4)
    assert rules._quantile(0.999, 5) == pytest.approx(20.5150, abs=1e-4)
    assert rules._chi_square(3.0, 2) == pytest.approx(1 - math.exp(-1.5))
