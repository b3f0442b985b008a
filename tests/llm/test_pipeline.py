from pyspark.sql import functions as F

import corpus_pipeline
from termloom.llm.common import stored
from tests.llm import plain

SF = "/root/testdata/sf0.001"


def test_stages_do_what_the_plain_versions_do(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), name)
        tables[name] = before, docs
        if name != "bpe":
            assert docs.columns == columns and docs.dtypes == before.dtypes
    ids = lambda frame: {r.doc_id for r in frame.select("doc_id").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}

    before, after = tables["quality"]
    kept = ids(after)
    right = [(i in kept) == (label == 1) for i, label in labels.items()]
    assert sum(right) / len(right) >= 0.95  # some 50 rows are learnt from

    before, after = tables["near_duplicates"]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    assert ids(after) == {i for i, _, component in plain.jaccard(rows) if i == component}

    before, after = tables["decontamination"]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert ids(after) == ids(before) - {i for i, *_ in plain.contaminated(rows, items)}

    before, after = tables["pii"]
    assert ids(after) == ids(before) and after.count() == before.count()
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.n_chars == len(r.text)
        assert "@" not in r.text or "@" not in texts[r.doc_id].replace("@mail", "")
    last = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, last.collect())) == sorted(map(str, tables["bpe"][1].collect()))


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_stages_take_any_column_names_and_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    more = ("redacted", "__text", "__score", "score", "text_", "of", "known", "found", "component_id", "n", "digest")
    odd = [(None, None), (900_001, ""), (900_002, "word " * 60_000), (900_003, "call +1 555 0037713 or a@b.example"), (900_003, "call +1 555 0037713 or a@b.example")]
    rows = spark.createDataFrame(odd, "doc_id bigint, text string")
    docs = docs.unionByName(rows, allowMissingColumns=True)
    for name in more:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    docs = stored(docs, "odd")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SF), name)
        assert after.dtypes == docs.dtypes
        for r in after.collect():
            assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for c in more)
        if name != "quality":
            docs = after
    assert stored(corpus_pipeline.STAGES[-1][1](spark, docs, SF), "last").count() == docs.count()
