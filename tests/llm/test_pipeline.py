"""Stages and run(): columns, what stays, and the packed rest."""

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    clean = {r["doc_id"] for r in docs.filter("length(text) > 500").collect()}
    for i, (name, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns == columns, name
        assert docs.filter("text is not null and n_chars <> length(text)").isEmpty()
        after = docs.count()
        assert 0 < after <= before
        if name == "language ID":
            kept = {r["doc_id"] for r in docs.collect()}
            assert len(kept & clean) > 0.85 * len(clean)
        before = after
    packed = P.run(spark, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}
