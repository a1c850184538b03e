"""Size of what the pipeline hands to Python workers."""

import corpus_pipeline


def test_pipeline_hands_out_few_documents_at_a_time(spark):
    docs = spark.createDataFrame(
        [(k, "the cat sat" if k % 2 else "die katze", "en" if k % 2 else "de") for k in range(20)], "doc_id long, text string, lang string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for stage in (corpus_pipeline.identify_language, corpus_pipeline.pack_sequences):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
            stage(spark, docs, "")
            assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
