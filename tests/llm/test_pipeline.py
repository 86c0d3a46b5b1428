import corpus_pipeline as P
from salesmart.llm import registry
from salesmart.llm.common import staged, table

from .conftest import SF, clashing


def test_stages_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]
    docs = table(spark, SF, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in P.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] >= counts[3] > counts[4] > 0
    last = P.STAGES[-1][1](spark, docs, SF)
    assert last.select("doc_id").distinct().count() == docs.count()


def test_run(spark):
    assert P.run(spark, SF).count() > 0


def test_stages_take_edge_cases(spark, edge, empty):
    from pyspark.sql import functions as F

    for df in (edge, empty):
        wide = clashing(df, "found", "_found", "key", "id", "copies").withColumn("n_chars", F.length("text").cast("long"))
        for name, stage in P.STAGES:
            out = staged(stage(spark, staged(wide, "in"), SF), name)
            if name != "best_fit_packing":
                assert out.columns == wide.columns
            out.count()


def test_registry_names_match(spark):
    assert set(registry.SQL) <= set(registry.QUERIES)
