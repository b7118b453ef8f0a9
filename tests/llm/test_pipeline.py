import corpus_pipeline as C
from convoloom.llm import decontamination, jaccard_join, quality_perplexity, secret_scan
from convoloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_path):
    """Each stage keeps what its operator says about the rows that it was given."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = [docs.count()]
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        new = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(new.count())
        if k < 4:
            assert new.columns == columns
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        after = {r.doc_id: r for r in new.collect()}
        if name == "quality_classifier":
            assert set(after) == {r.doc_id for r in quality_perplexity.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("kept").collect()}
        elif name == "ngram_jaccard_join":
            assert set(after) == {r.class_id for r in jaccard_join.jaccard_classes(docs).collect()}
        elif name == "benchmark_decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
            m = decontamination.Matcher([(r.item_id, r.text) for r in items])
            assert set(after) == {i for i, t in before.items() if not m.find(t)}
            assert not any(r.text in after[i].text for r in items for i in after)
        elif name == "secret_scans":
            assert set(after) == set(before)
            assert all(r.text == secret_scan.redact(before[i]) and r.n_chars == len(r.text) for i, r in after.items())
        else:
            assert set(after) == set(before) and all(r.round_trip for r in after.values())
        docs = new
    assert seen[0] > seen[1] > 0 and seen[-1] == seen[3]
    assert sorted((r.doc_id, tuple(r.ids)) for r in C.run(spark, SF).collect()) == sorted((r.doc_id, tuple(r.ids)) for r in docs.collect())


def test_every_operator_is_registered():
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 11))
