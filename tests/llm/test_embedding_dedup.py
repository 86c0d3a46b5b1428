import numpy as np
import pytest

from salesmart.llm import embedding_dedup as E
from salesmart.llm.registry import op3_embedding_near_dedup

from .conftest import SF, clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.98):
    ids = [r[0] for r in rows]
    n = len(rows)
    ok = [
        r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
        for r in rows
    ]
    x = [np.array(r[1], np.float64) if o else None for r, o in zip(rows, ok)]
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= least:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least_id = {}
    for i in range(n):
        least_id[find(i)] = min(ids[i], least_id.get(find(i), ids[i]))
    return sorted((ids[i], links[i], least_id[find(i)], ids[i] == least_id[find(i)]) for i in range(n))


def planted(seed, n=150, d=64):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)).astype(np.float32)
    rows = [(i, v.tolist(), int(i % 3)) for i, v in enumerate(base)]
    for k in range(n):
        i = int(rng.integers(len(rows)))
        v = np.array(rows[i][1])
        noise = rng.normal(size=d) * np.linalg.norm(v) / np.sqrt(d) * rng.choice([0, 0.05, 0.15, 0.3])
        scale = rng.choice([1, 1, 2.5])
        rows.append((n + k, ((v + noise) * scale).astype(np.float32).tolist(), rows[i][2] if rng.random() < 0.9 else 1))
    return rows


@pytest.mark.parametrize("seed,cell", [(1, 2048), (2, 4)])
def test_matches_brute_force(spark, monkeypatch, seed, cell):
    monkeypatch.setattr(E, "CELL", cell)
    rows = planted(seed)
    # one dense group in which all link
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=64)
    rows += [(1000 + i, (centre + rng.normal(size=64) * 0.02).astype(np.float32).tolist(), 0) for i in range(60)]
    got = sorted(tuple(r) for r in E.embedding_dedup(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * z
    met = E._met(E.hasher(64).codes(x), E.hasher(64).codes(y))
    assert met.any(axis=1).mean() > 0.99


@pytest.mark.parametrize("d", [1, 2, 3, 5, 64, 100])
def test_codes_of_any_length(d):
    x = E._unit(np.random.default_rng(d).normal(size=(20, d)))
    codes = E.hasher(d).codes(x)
    assert codes.shape == (20, E.TABLES, 1 + E.PROBES)
    assert (codes == E.hasher(d).codes(x * 1.0)).all()
    assert (codes[3] == E.hasher(d).codes(x[3:4])[0]).all()


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0], None), (11, [1.0, 0.0], None),
        (12, [1.0, 0.0, 0.0], 1), (13, [-1.0, 0.0], 1), (14, [5.0], 1), (15, [7.0], 1), (16, [1.0, 0.0], 1), (16, [1.0, 0.0], 1),
    ]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "id", "rep", "t", "bucket", "copies", "n_links")
    got = sorted(tuple(r) for r in E.embedding_dedup(df).collect())
    assert got == brute(rows)
    assert E.embedding_dedup(df.where("false")).count() == 0


def test_registered_query(spark):
    out = op3_embedding_near_dedup(spark, SF)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert out.count() == out.where("n_links >= 0").count() > 0
