"""The pipeline's stages, each on what its predecessor kept."""

import corpus_pipeline
from chatloom.llm import op2_suffix_dedup, op5_simhash, op6_decontaminate
from chatloom.session import scratch_dir


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near copies", "repeats", "benchmarks", "tokens"]
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_dir(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = (before, docs)
        if name != "tokens":
            assert docs.columns == columns
    before, after = kept["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = {r.doc_id for r in after.select("doc_id").collect()}
    assert all(i in left for i, y in labels.items() if y == 1)
    before, after = kept["near copies"]
    groups = {r.component for r in op5_simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(groups)
    before, after = kept["repeats"]
    want = {r.id: bytes(r.kept).decode("utf-8", "ignore") for r in op2_suffix_dedup.remove_repeats(before).collect()}
    assert {r.doc_id: r.text for r in after.collect()}.keys() == want.keys()
    assert all(r.text == want[r.doc_id] for r in after.collect())
    before, after = kept["benchmarks"]
    hit = {r.id for r in op6_decontaminate.contamination(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect() if r.n_hit}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == hit
    before, after = kept["tokens"]
    assert after.count() == before.count() and all(r.round_trip and len(r.token_ids or []) == r.n_tokens for r in after.collect())


def test_stages_on_odd_documents(spark, sf_dir, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            result = stage(spark, docs, sf_dir)
            assert set(docs.columns) <= set(result.columns), name
            assert result.count() <= docs.count()


def test_benchmarks_go_by_row(spark, tmp_path):
    passage = "one two three four five six seven eight nine ten"
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"so {passage}"), (None, "clean"), (None, "clean"), (None, None), (4, passage), (4, "clean too"), (4, ""), (5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = op6_decontaminate.drop_contaminated(spark, docs, str(tmp_path)).collect()
    want = [r for r in rows if passage not in (r[1] or "")]
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, want))
