import numpy as np
from pyspark.sql import functions as F

from salesmart.llm import toxicity as T
from salesmart.llm.common import table

from .conftest import EDGE_ROWS, clashing


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    out = T.toxicity(table(spark, sf, "documents").select("doc_id", "text"), labels)
    rows = out.join(labels, "doc_id").where("held_out").select("toxic", "score", "predicted", "posterior").collect()
    y = np.array([r.toxic for r in rows])
    score = np.array([r.score for r in rows])
    rank = score.argsort().argsort() + 1
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())
    found = np.array([r.predicted for r in rows])
    assert auc > 0.95 and found[y == 1].mean() > 0.85 and found[y == 0].mean() < 0.02
    # the label model by itself orders them well too
    by_votes = np.array([r.posterior for r in rows])
    assert by_votes[y == 1].mean() > by_votes[y == 0].mean() + 0.4


def test_labels_of_held_out_rows_change_nothing(spark):
    from salesmart.llm.common import held_out

    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in T.toxicity(docs, x).collect()) for x in (labels, turned))
    assert a == b and len(a) == docs.count()


def test_edge_cases(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (3, 1), (9, 0), (10, 0), (8, None), (99, 1), (1, 1)], "doc_id long, toxic int")
    wide = clashing(edge, "id", "hits", "held_out", "score", "y")
    rows = T.toxicity(wide, labels).collect()
    assert len(rows) == len(EDGE_ROWS)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    same = {r.score for r in rows if r.doc_id in (4, 5)}
    assert len(same) == 1
    assert T.toxicity(empty, labels).count() == 0
    none = T.toxicity(edge, labels.where("false")).collect()
    assert {r.score for r in none} == {0.0} and len(none) == len(EDGE_ROWS)
    one = T.toxicity(edge, labels.where("toxic = 1")).collect()
    assert {r.score for r in one} == {1.0}


def test_label_model_finds_good_and_repeated_voters(spark):
    rng = np.random.default_rng(3)
    n, m = 4000, 3
    y = rng.random(n) < 0.3
    hits = np.zeros((n, m + len(T.PATTERNS) + 1), np.float32)
    hits[:, 0] = np.where(rng.random(n) < np.where(y, 0.9, 0.02), 1, 0)  # good
    hits[:, 1] = hits[:, 0]  # says the same again
    hits[:, 2] = rng.random(n) < 0.3  # says nothing
    hits[:, -1] = 100
    known = [float(v) if i % 10 == 0 else None for i, v in enumerate(y)]
    df = spark.createDataFrame([(h.tolist(), k) for h, k in zip(hits, known)], "hits array<float>, y double")
    model = T.fit_label_model(df)
    assert abs(model.prior - 0.3) < 0.05
    assert model.speaks[1][0] > 0.8 > 0.1 > model.speaks[0][0]
    assert abs(model.speaks[1][2] - model.speaks[0][2]) < 0.1
    assert model.say[0] < 0.6 and model.say[2] > model.say[0]
    found = model.posterior(T.voters(hits).astype(float)) > 0.5
    assert (found == y).mean() > 0.93


def test_stems():
    assert T.stems("ab") == ["ab$"]
    assert T.stems("abcdefgh") == ["abcd", "abcde", "abcdef", "abcdefg", "abcdefgh$"]
