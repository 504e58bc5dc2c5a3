import corpus_pipeline
from ragtide.llm import decontaminate, packing, pii, quality_rules, queries, simhash
from ragtide.llm.common import written


def test_stages_take_effect(spark, sf, documents, with_clashes):
    docs = with_clashes(documents)
    labels, benchmark = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "packing"]
    made = []
    for name, stage in corpus_pipeline.STAGES:
        made.append(written(stage(spark, made[-1] if made else docs, sf), f"test-{name}"))
    assert all(m.columns == docs.columns for m in made[:-1])

    def ids(df):
        return sorted(str(r.doc_id) for r in df.select("doc_id").collect())

    good = quality_rules.quality_rules(documents, labels).where("kept")
    assert ids(made[0]) == ids(good)
    groups = simhash.simhash_groups(made[0]).where("doc_id = component_id").select("doc_id").distinct()
    assert ids(made[1].where("doc_id IS NOT NULL")) == ids(groups.where("doc_id IS NOT NULL"))
    assert ids(made[2]) == ids(decontaminate.contamination(made[1], benchmark).where("NOT contaminated"))
    assert ids(made[3]) == ids(made[2])
    assert {r.text for r in made[3].collect()} == {r.text for r in pii.redact(made[2]).collect()}
    assert all(r.n_chars == len(r.text) for r in made[3].collect())
    pieces = made[4].collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in made[3].collect()}
    assert sum(r.length for r in pieces) == sum(len(r.ids) // 2 for r in packing.encoded(made[3]).collect())


def test_empty_documents(spark, sf, empty_docs):
    docs = empty_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), "test-empty")
        assert docs.count() == 0


def test_registered():
    names = queries.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
