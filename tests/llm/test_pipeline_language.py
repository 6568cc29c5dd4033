"""The first stage of the pipeline rejects rows, not ids."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_a_rejected_row_takes_no_namesake_along(spark):
    good = spark.read.parquet(f"{SF}/documents.parquet")
    schema = good.schema
    clean = corpus_pipeline.identify_language(spark, good, SF).collect()
    a, b, c = clean[0], clean[1], clean[2]
    odd = [(None, a.text), (None, None), (None, "123 %%"), (b.doc_id, ""), (c.doc_id, " "), (c.doc_id, c.text)]
    frame = good.unionByName(spark.createDataFrame([(i, t, None, None, None) for i, t in odd], schema))
    got = corpus_pipeline.identify_language(spark, frame, SF)
    assert got.columns == good.columns
    rows = [(r.doc_id, r.text) for r in got.collect()]
    want = [(r.doc_id, r.text) for r in clean] + [(None, a.text), (c.doc_id, c.text)]
    assert sorted(rows, key=str) == sorted(want, key=str)
