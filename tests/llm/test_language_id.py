import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesmart.llm import language_id as L
from salesmart.llm.common import held_out, table

from .conftest import EDGE_ROWS


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    model = L.train(docs.where(~held_out(F.col("doc_id"))))
    assert model.langs == ["de", "en", "es", "fr"]
    test = docs.where(held_out(F.col("doc_id"))).withColumn("p", L.language_mixture(model, F.col("text"), spark))
    rows = test.collect()
    assert len(rows) > 100
    assert sum(r.p.lang == r.lang for r in rows) / len(rows) > 0.97
    assert all(0 <= r.p.score <= 1 for r in rows)


def test_shares_of_a_planted_mixture(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    model = L.train(docs)
    by = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", F.when(F.length("text") < 20000, F.length("text"))).alias("text")).collect()}
    half = by["en"][:3000] + " " + by["de"][:3000]
    langs, shares = model.mixtures([half])[0]
    assert set(langs) == {"en", "de"} and abs(shares[0] - 0.5) < 0.1
    langs, shares = model.mixtures([by["fr"][:3000]])[0]
    assert langs == ["fr"] and shares == [1.0]


def test_a_mixture_of_all_languages_keeps_them(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    model = L.train(docs)
    by = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", F.when(F.length("text") < 20000, F.length("text"))).alias("text")).collect()}
    langs, shares = model.mixtures([" ".join(by[x][:3000] for x in model.langs)])[0]
    assert set(langs) == set(model.langs) and len(langs) == 4
    assert max(abs(s - 0.25) for s in shares) < 0.1
    langs, shares = model.mixtures([by["en"][:4500] + " " + " ".join(by[x][:2500] for x in ("de", "es", "fr"))])[0]
    assert langs[0] == "en" and len(langs) == 4 and abs(shares[0] - 0.375) < 0.1


def slow_em(like, n, rounds, k):
    pi = np.full(k, 1 / k)
    for _ in range(rounds):
        r = like * pi
        r /= r.sum(axis=1, keepdims=True)
        pi = (r * n[:, None]).sum(axis=0) / n.sum()
    return pi


def test_batched_rounds_match_one_document_at_a_time():
    rng = np.random.default_rng(1)
    sizes = [3, 1, 7, 20]
    like = rng.random((sum(sizes), 4)) + 1e-6
    n = rng.integers(1, 9, sum(sizes)).astype(float)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    doc = np.repeat(np.arange(4), sizes)
    got, _ = L._em(like, n, doc, starts, np.add.reduceat(n, starts), np.full((4, 4), 0.25))
    for i, (s, m) in enumerate(zip(starts, sizes)):
        assert np.allclose(got[i], slow_em(like[s : s + m], n[s : s + m], L.ROUNDS, 4))


def test_batches_do_not_change_results(monkeypatch):
    counts = pd.DataFrame({"lang": ["a", "a", "b", "b"], "bin": [1, 2, 2, 3], "n": [50, 50, 50, 50]})
    model = L.Model(counts)
    texts = ["one two three", "vier", None, "", "cinq six"] * 5
    whole = model.mixtures(texts)
    monkeypatch.setattr(L, "CELLS", 10)
    assert model.mixtures(texts) == whole


def test_edge_cases(spark, edge, empty):
    none = L.train(empty)
    assert none.langs == []
    got = edge.withColumn("p", L.language_mixture(none, F.col("text"), spark)).collect()
    assert all(r.p.lang == "und" and r.p.score == 0 and r.p.langs == [] for r in got)
    model = L.train(edge)
    got = {(r.doc_id, r.p.lang) for r in edge.withColumn("p", L.language_mixture(model, F.col("text"), spark)).collect()}
    assert {(4, "und"), (5, "und"), (6, "und"), (7, "und"), (8, "de"), (11, "en")} <= got
    assert len(got) == len({r[0] for r in EDGE_ROWS})


@pytest.mark.parametrize("text,n", [(None, 0), ("", 0), ("12 !", 0), ("a", 1), ("ab", 2), ("ab, cd", 5), ("1a2", 1)])
def test_trigrams(text, n):
    assert len(L.trigrams(text)) == n
