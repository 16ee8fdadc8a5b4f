import corpus_pipeline
from cabflow.llm.common import load
from tests.llm.edge_tables import documents, write

SF = "/root/testdata/sf0.001"


def test_stages_on_the_tables(spark):
    docs = load(spark, SF, "documents")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
    ids = {r["doc_id"] for r in out.collect()}
    assert ids < {r["doc_id"] for r in docs.collect()}
    good = {r["doc_id"] for r in load(spark, SF, "labels").filter("quality = 1").collect()}
    assert len(ids & good) > 0.5 * len(good)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "pii", "mix_sources"]


def test_edges(spark, tmp_path):
    sf = write(spark, tmp_path, documents(spark))
    assert corpus_pipeline.run(spark, sf).count() > 0
    none = write(spark, tmp_path / "none", documents(spark, []))
    assert corpus_pipeline.run(spark, none).count() == 0


def test_texts_go_to_python_in_small_batches(spark):
    """The stages bound the rows of a batch of texts before they plan; a lower setting stays."""
    from cabflow.llm.common import TEXT_ROWS

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(i, f"some words of text number {i}") for i in range(5)], "doc_id long, text string")
    try:
        for setting, kept in ((10_000, TEXT_ROWS), (0, TEXT_ROWS), (100, 100)):
            spark.conf.set(key, setting)
            assert corpus_pipeline.near_dedup_stage(spark, docs, "").count() == 5
            assert int(spark.conf.get(key)) == kept
    finally:
        spark.conf.set(key, before)
