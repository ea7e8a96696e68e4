import corpus_pipeline
from tesserae.llm import decontaminate, pii, simhash, toxicity


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(got) == set(kept) and all(r["lossless"] for r in got.values())
    assert got and all(r["n_pieces"] == len(r["pieces"]) for r in got.values())
    all_docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert not [r for r in decontaminate.find_shared(all_docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect() if r["doc_id"] in kept and r["spans"]]
    assert not any(x for t in kept.values() for x in pii.base_spans(t)["email"])


def test_brute_force_of_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    weights = toxicity.WordWeights(model)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    clean = [(i, t) for i, t in rows if toxicity.noisy_or([z for *_, z in toxicity.sentences(t, weights)]) < toxicity.THRESHOLD]
    from .test_simhash import brute_components

    single = {i for i, _, c in brute_components(clean) if i == c}
    out = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_toxic(spark, docs, sf_dir), sf_dir)
    assert {r["doc_id"] for r in out.collect()} == single


def test_null_and_empty(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
    assert simhash.keep_one(odd_docs).count() < odd_docs.count()
