import corpus_pipeline
from starloom.llm import minhash_dedup, queries


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES if q != "pipeline") == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_take_effect(spark, edge_docs, no_docs):
    docs = edge_docs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "mix_sources", "pack"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "unused")
        if name != "pack":
            assert sorted(docs.columns) == sorted(edge_docs.columns)
            seen.append({r["doc_id"] for r in docs.collect()})
    assert seen[0] == {None, 4, 5, 9} and seen[1] == {None, 4, 9} and seen[2] <= seen[1]
    assert {r["doc_id"] for r in docs.collect()} == seen[2]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, "unused").count() == 0


def test_run_over_a_table(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert 0 < out.select("doc_id").distinct().count() <= docs.count()
    ids = {r["doc_id"] for r in out.select("doc_id").collect()}
    first = docs.filter(docs.doc_id.isin(list(ids)))
    assert minhash_dedup.near_duplicates(first).filter("not kept").count() == 0


def test_stages_return_few_parts(spark):
    """Not one a shuffle partition: what a stage returns is written, and a file costs
    an executor processes of its own."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "en", "ab"[i % 2], f"{text} x{i % 9} {' '.join(f'y{i}z{j}' for j in range(i % 5 * 8))}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string").repartition(40)
    set_before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "unused")
            assert docs.rdd.getNumPartitions() <= 6, name
            docs = spark.createDataFrame(docs.collect(), docs.schema).repartition(40)
            assert docs.count(), name
    finally:
        for k, v in set_before.items():
            spark.conf.set(k, v)
