"""The stages one after another on the smallest tables."""

import corpus_pipeline
from siftlake.llm import queries
from siftlake.llm.common import table

TESTDATA = "/root/testdata/sf0.001"


def test_stages_pass_on_what_they_keep(spark):
    docs = table(spark, TESTDATA, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, TESTDATA).checkpoint()
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        docs = kept
    pieces = corpus_pipeline.run(spark, TESTDATA)
    assert sorted(r[0] for r in pieces.select("doc_id").distinct().collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_every_operator_has_a_query():
    names = queries.llm_queries()
    assert {n.split("_")[0] for n in names} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(queries.llm_oracles()) <= set(names)
