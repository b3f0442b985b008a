import pytest

from termloom.__main__ import arguments, run
from tests.samples import SAMPLE, SAMPLE_WEIGHTS


def written(path) -> list[list[str]]:
    parts = sorted(p for p in path.iterdir() if p.name.startswith("part-"))
    return [line.split("\t") for p in parts for line in p.read_text().splitlines()]


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in SAMPLE.items():
        (folder / name).write_text(text)
    return folder


@pytest.mark.parametrize("options", [[], ["--lines"], ["--fixed"], ["--mode", "java_ws"]])
def test_weights_of_a_folder(spark, source, tmp_path, options):
    run(spark, arguments([str(source), str(tmp_path / "out"), *options]))
    lines = written(tmp_path / "out")
    assert [k for k, _ in lines] == [w[0] for w in SAMPLE_WEIGHTS]
    assert [float(v) for _, v in lines] == pytest.approx([w[4] for w in SAMPLE_WEIGHTS], abs=1e-15)


def test_other_reports_of_a_table(spark, tmp_path):
    table, target = str(tmp_path / "t"), tmp_path / "out"
    rows = [(1, "b a b"), (2, "a")]
    spark.createDataFrame(rows, "id long, body string").write.parquet(table)
    known = ["--table", "parquet", "--document", "id", "--text", "body", "--unique"]
    run(spark, arguments([table, str(target), "--report", "tf", *known]))
    assert written(target) == [["a@1", "1/3"], ["a@2", "1/1"], ["b@1", "2/3"]]
    run(spark, arguments([table, str(target), "--report", "idf", *known]))
    assert written(target) == [["a@1", "2/2"], ["a@2", "2/2"], ["b@1", "2/1"]]
