import corpus_pipeline
from wayfare.llm import jaccard, language, packing, quality_rules
from wayfare.llm.common import small_batches, stage, table


def test_stages_hand_over(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    seen = [docs]
    for name, step in corpus_pipeline.STAGES[:-1]:
        seen.append(stage(step(spark, seen[-1], sf_dir), "test"))
        assert seen[-1].columns == docs.columns, name
    known, good, single, mixed = seen[1:]
    assert known.count() == language.identify(docs).filter(f"lang_pred != 'und' and score >= {language.LEAST_SCORE}").count()
    assert good.count() == quality_rules.judge(known, table(spark, sf_dir, "labels")).filter("kept").count() < known.count()
    classes = jaccard.similarity_classes(good)
    assert single.count() == classes.select("component_id").distinct().count() < good.count()
    assert {r.doc_id for r in mixed.select("doc_id").distinct().collect()} <= {r.doc_id for r in single.select("doc_id").collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, mixed, sf_dir)
    assert packed.columns == [f.split()[0] for f in packing.PIECES.split(", ")]
    assert corpus_pipeline.run(spark, sf_dir).count() == packed.count()


def test_odd_documents_and_none(spark, odd, none, tmp_path):
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, none):
        for _, step in corpus_pipeline.STAGES[:-1]:
            assert step(spark, docs, str(tmp_path)).columns == docs.columns
            step(spark, docs, str(tmp_path)).collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()


def test_batches_follow_the_session(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        small_batches(spark)
        assert spark.conf.get(key) == "2000"
        spark.conf.set(key, 7)
        small_batches(spark)
        assert spark.conf.get(key) == "7"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
