"""Empty tables through the pipeline and the operators behind it."""

from tidemark.llm import simhash


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline as cp

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = cp.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() == 0


def test_pipeline_of_one_source_of_copies_nulls_and_one_long_text(spark, tmp_path):
    import corpus_pipeline as cp

    long_text = " ".join(f"w{k % 977}x{k % 31}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, "a"), (4, "A "), (5, long_text), (6, long_text + " end"), (None, "lone words here"), (7, None), (5, long_text)]
    spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(None, 1, 1), (3, 1, None), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = sorted((r.doc_id for r in cp.run(spark, str(tmp_path)).collect()), key=repr)
    # one source alone takes all of its own words: every class once, the kept id as often as it stands there
    assert kept == [1, 3, 5, 5, None]
    ids = {r.id: r.component_id for r in simhash.similar(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()}
    assert ids == {1: 1, 2: 1, 7: 1, 3: 3, 4: 3, 5: 5, 6: 5, None: None}
