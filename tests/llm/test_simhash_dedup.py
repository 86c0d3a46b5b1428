import random

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from salesmart.llm import simhash_dedup as S
from salesmart.llm.components import components

from .conftest import EDGE_ROWS, SF, clashing


def slow_fingerprint(text, width=3):
    words, word = [], ""
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    words += [word] * bool(word)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def brute_components(ids, prints, reach=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= reach:
                root[find(i)] = find(j)
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("text", [r[1] for r in EDGE_ROWS if not r[1] or len(r[1]) < 1000] + ["A b", "a B c", "É a b c d"])
def test_fingerprint(text):
    got = S.fingerprint(text.encode() if text is not None else None, 3) % (1 << 64)
    assert got == slow_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(1000)).encode()
    whole = S.fingerprint(text, 3)
    monkeypatch.setattr(S, "BLOCK", 64)
    assert S.fingerprint(text, 3) == whole


def test_query_rows_match_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [slow_fingerprint(r.text) for r in rows]
    want = set(zip([r.doc_id for r in rows], [f"{p:016x}" for p in prints], brute_components([r.doc_id for r in rows], prints)))
    got = S.simhash_dedup(docs).select("doc_id", S.hex_digits(S.F.col("fp")), "component_id").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(rows)


def planted(n, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(n)]
    out = list(base)
    for _ in range(n):
        x = rng.choice(out)
        for b in rng.sample(range(64), rng.randint(0, 4)):
            x ^= 1 << b
        out.append(x)
    dense = rng.getrandbits(64)
    for _ in range(n):
        x = dense
        for b in rng.sample(range(12), rng.randint(0, 5)):
            x ^= 1 << b
        out.append(x)
    return sorted({x - (1 << 64) if x >> 63 else x for x in out})


@pytest.mark.parametrize("leaf", [8, 40, 100_000])
def test_links_of_the_tree_are_complete(spark, monkeypatch, leaf):
    monkeypatch.setattr(S, "LEAF", leaf)
    monkeypatch.setattr(S, "CELL", 4 * leaf)
    prints = planted(300, leaf)
    df = spark.createDataFrame([(x,) for x in prints], "fp long")
    edges = S.fingerprint_links(df, 2)
    found = {r.node: r.root for r in components(edges).collect()}
    want = brute_components(prints, [x % (1 << 64) for x in prints])
    assert [found.get(x, x) for x in prints] == want


def test_tree_visits_follow_the_triangle_bounds():
    points = np.array(planted(500, 3), np.int64)
    tree = S.VantageTree(points[::3], 32)
    visits = list(tree.route(points, 2))
    home = np.concatenate([at[h] for _, at, h in visits])
    assert sorted(home) == list(range(len(points)))
    assert tree.leaves > 8


def test_edge_cases(edge, empty):
    assert S.simhash_dedup(empty).count() == 0 and S.drop_near_copies(empty).count() == 0
    got = {(r.doc_id, r.component_id) for r in S.simhash_dedup(edge).collect()}
    assert {(4, 4), (5, 4), (6, 4), (1, 1), (2, 1), (3, 1), (8, 8)} <= got
    wide = clashing(edge, "id", "_id", "fp", "component_id")
    kept = S.drop_near_copies(wide)
    assert kept.columns == wide.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(8) == 1 and not {2, 3, 5, 6} & set(ids) and {1, 4, 7, None} <= set(ids)


def test_components_of_a_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1000 + i) for i in range(1, 80)] + [(5000, 1000 + i) for i in range(40, 90)]
    df = spark.createDataFrame(path + hub + [(7, 7)], "a long, b long")
    found = {r.node: r.root for r in components(df).collect()}
    assert all(found[i] == 0 for i in range(61))
    assert all(found[x] == 1000 for e in hub for x in e)


def test_registered_query(spark):
    from salesmart.llm.registry import op9_simhash_near_dedup

    out = op9_simhash_near_dedup(spark, SF)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]


def test_each_row_of_an_id_is_judged_by_its_own_text(spark):
    a, b, c = ("alpha beta gamma delta " * 5, "one two three four five " * 5, "quite another text about nothing " * 4)
    near_a = a + "."  # shares its fingerprint's neighbourhood with a, or not; the groups say
    rows = [(2, a), (5, a), (5, b), (5, b), (7, b), (None, c), (None, c), (9, c), (None, a), (11, near_a), (11, "x y z " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("other"))
    kept = S.drop_near_copies(docs)
    assert kept.columns == ["doc_id", "text", "fp"]
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert [r for r in got if r[1] == a] == [(2, a)]  # 5 goes with its text a ...
    assert [r for r in got if r[1] == b] == [(5, b)]  # ... and stays once with its text b
    assert [r for r in got if r[1] == c] == [(9, c)]
    assert (11, "x y z " * 9) in got


def test_of_each_group_one_row_stays(spark):
    """Ids repeat at random; of every group exactly one row is left, with the group's smallest id."""
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(list("abcdefgh"), 12)) for _ in range(12)]
    rows = [(int(rng.integers(0, 9)), texts[int(rng.integers(0, 12))]) for _ in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    prints = {t: S.fingerprint(t.encode(), 3) for t in texts}
    group = {t: t for t in texts}
    for t in texts:  # links of at most two bits, followed to the end
        for u in texts:
            if bin((prints[t] ^ prints[u]) & (2**64 - 1)).count("1") <= 2:
                old, new = group[t], group[u]
                group = {k: new if v == old else v for k, v in group.items()}
    used = {t for _, t in rows}
    want = {g: min(i for i, t in rows if group[t] == g) for g in {group[t] for t in used}}
    got = [(group[r.text], r.doc_id) for r in S.drop_near_copies(docs).collect()]
    assert sorted(got) == sorted(want.items())
