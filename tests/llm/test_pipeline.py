"""The corpus pipeline, stage by stage."""

import corpus_pipeline
from folioforge.llm import mixing
from folioforge.session import ship


def test_stages(spark, sf_dir):
    ship(spark)
    documents = docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == documents.columns
        docs = spark.createDataFrame(out.collect(), documents.schema)
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if len(kept) == 3:
            planned = mixing.plan(docs).agg({"_mix_taken": "sum"}).first()[0]
    assert kept[0] > kept[1] >= kept[2] >= kept[3]
    assert mixing.plan(docs).agg({"_mix_size": "sum"}).first()[0] == planned
    rows = corpus_pipeline.token_ids(spark, docs, sf_dir)
    assert rows.count() == docs.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()
