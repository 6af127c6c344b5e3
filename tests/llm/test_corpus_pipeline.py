import os
import sys

import reference as plain

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as pipeline  # noqa: E402


def test_stages_keep_what_they_should(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, small).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns == (columns if k < 4 else [*columns, "shard", "slot"])
        kept.append({r.doc_id: r.text for r in docs.collect()})
    whole = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for d, text in whole.items():
        n, *_, repeated = plain.quality_counts(text)
        if n < 50 or 100 * repeated > 50 * n:
            assert d not in kept[0]
    parts = plain.near_duplicates(kept[0].items(), size=5)
    assert set(kept[1]) == {c for _, c in parts.values()}
    assert set(kept[2]) == {d for d, t in kept[1].items() if not plain.contamination(t, items)[4]}
    assert set(kept[3]) <= set(kept[2]) and len(kept[3]) > 0.7 * len(kept[2])
    assert set(kept[4]) == set(kept[3])


def test_run_equals_the_stages(spark, small):
    assert pipeline.run(spark, small).count() > 0


def test_empty_and_odd_tables(spark, odd, none, small):
    for docs in (odd, none):
        for k, (_, stage) in enumerate(pipeline.STAGES):
            docs = pipeline.spool(stage(spark, docs, small))
        assert "shard" in docs.columns and "slot" in docs.columns
