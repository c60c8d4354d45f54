"""The corpus pipeline on awkward rows: what each stage keeps."""

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Passages of a benchmark and labelled documents, some of them toxic by one word."""
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, "a question of the benchmark about the height of a mountain and the depth of a lake in the north")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(100, 180)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def _rows():
    words = " ".join(f"word{i}" for i in range(80))
    near = [(10 + i, words + (" more of it" if i == 2 else "")) for i in range(3)]
    rows = [(None, "a text without an id, which is long enough to be a line of its own"), (None, None), (1, ""), (2, None), (3, "the first row of a document that has two rows in the table"), (3, "quite another row under that same document number, as it happens")]
    rows += [(4, "before it\na question of the benchmark about the height of a mountain and the depth of a lake in the north\nafter it"), *near]
    rows += [(i, f"number {i} says something that is {'vilenastyword' if i % 4 == 0 else 'kind'} about entry {i * i}") for i in range(100, 180)]
    return [(i, t, "en", "s", 1, 7) for i, t in rows]


def test_stages_keep_clean_documents(spark, folder):
    docs = spark.createDataFrame(_rows(), SCHEMA).repartition(3)
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), SCHEMA)
        kept.append(sorted(((r.doc_id, r.text) for r in docs.where("doc_id is null or doc_id < 100").collect()), key=repr))
    given = sorted(((i, t) for i, t, *_ in _rows() if i is None or i < 100), key=repr)
    toxicity, lines, near, clean = kept
    assert toxicity == given
    assert lines == [(i, "" if i == 11 else t) for i, t in given]
    assert near == [x for x in lines if x[0] != 12]
    assert clean == [x for x in near if x[0] != 4]
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert tokens.count() == docs.count()


def test_run_over_empty_tables(spark, folder, tmp_path):
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
