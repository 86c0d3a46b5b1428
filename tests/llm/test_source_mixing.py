from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from salesmart.llm import source_mixing as M

from .conftest import EDGE_ROWS, clashing


def fill(children, budget):
    """Water filling in exact fractions: {name: (weight, cap)} to {name: share}."""
    share, live = dict.fromkeys(children, Fraction(0)), {k for k, (w, c) in children.items() if w and c}
    left = Fraction(min(budget, sum(c for w, c in children.values() if w)))
    while live and left > 0:
        rate = left / sum(children[k][0] for k in live)
        full = {k for k in live if children[k][1] <= rate * children[k][0]}
        if not full:
            for k in live:
                share[k] = rate * children[k][0]
            break
        for k in full:
            share[k] = Fraction(children[k][1])
            left -= children[k][1]
        live -= full
    return share


def test_budgets_match_water_filling(spark):
    have = {("a", "en", "s1"): 100, ("a", "en", "s2"): 5000, ("a", "fr", "s3"): 40, ("b", "en", "s4"): 900,
            ("b", "de", "s5"): 30, ("b", "de", "s6"): 70, ("c", "en", "s7"): 0, ("c", "es", "s8"): 333}
    mix = M.Mix(weights={"domain": {"a": 1, "b": 5}, "lang": {"de": 3}, "source": {"s6": 2}}, percent=50, max_epochs=2)
    leaves = spark.createDataFrame([(*k, v) for k, v in have.items()], "domain string, lang string, source string, have long")
    got = {(r.domain, r.lang, r.source): r.quota for r in M.budgets(leaves, mix).collect()}
    weight = lambda level, name: mix.weights[level].get(name, 1)

    def split(path, keys, budget, out):
        if len(path) == 3:
            out[path] = budget
            return
        level = ("domain", "lang", "source")[len(path)]
        children = defaultdict(int)
        for k in keys:
            children[k[len(path)]] += 2 * have[k]
        shares = fill({n: (weight(level, n), c) for n, c in children.items()}, budget)
        for n, s in shares.items():
            split((*path, n), [k for k in keys if k[len(path)] == n], int(s), out)

    want = {}
    split((), [k for k in have if have[k]], sum(have.values()) // 2, want)
    assert got == want
    # the shortage of a/fr goes to its sibling language before other domains
    assert got["a", "fr", "s3"] == 80 and got["a", "en", "s2"] > got["a", "en", "s1"] >= 100


def test_copies_follow_the_quota(edge):
    mix = M.Mix(percent=70, max_epochs=2)
    wide = clashing(edge, "domain", "_domain", "tokens", "copies", "key", "bucket", "plan", "cut", "quota")
    mixed, (domain, tokens, quota, copies) = M.mix_sources(wide, F.lit("one"), mix)
    rows = mixed.select("doc_id", "lang", "source", tokens, quota, copies).collect()
    assert len(rows) == len(EDGE_ROWS)
    taken, have, want = defaultdict(int), defaultdict(int), {}
    for doc, lang, source, n, q, c in rows:
        leaf = (lang or "", source or "")
        taken[leaf] += n * c
        have[leaf] += n
        want[leaf] = q
        assert 0 <= c <= 2 and (n or not c)
    assert all(taken[k] <= want[k] <= 2 * have[k] for k in want)
    out = M.take_copies(mixed, wide.columns, copies)
    assert out.columns == wide.columns and out.count() == sum(r[-1] for r in rows)


@pytest.mark.parametrize("percent", [0, 37, 100, 1000])
def test_extreme_budgets(docs, percent):
    mixed, (_, tokens, quota, copies) = M.mix_sources(docs, F.lit("d"), M.Mix(percent=percent, max_epochs=2))
    total, taken, rows = mixed.agg(F.sum(tokens), F.sum(F.col(tokens) * F.col(copies)), F.count("*")).first()
    assert rows == docs.count() and taken <= total * min(percent, 200) // 100
    if percent in (0, 100, 1000):
        assert taken >= 0.85 * total * min(percent, 200) // 100


def test_leaf_prefix_is_the_longest_that_fits(docs):
    mixed, (_, tokens, quota, copies) = M.mix_sources(docs, F.lit("d"), M.Mix(percent=40, max_epochs=1))
    by = defaultdict(list)
    for r in mixed.select("doc_id", "lang", "source", F.col(tokens).alias("n"), F.col(quota).alias("q"), F.col(copies).alias("c")).collect():
        by[r.lang, r.source].append(r)
    import hashlib

    for rows in by.values():
        epochs = rows[0].q // sum(r.n for r in rows)
        rows.sort(key=lambda r: hashlib.md5(f"mix-1:{epochs}:{r.doc_id}".encode()).hexdigest())
        upto = 0
        for r in rows:
            upto += r.n
            assert r.c == epochs + (upto <= r.q % sum(x.n for x in rows))


def test_empty(empty):
    mixed, _ = M.mix_sources(empty, F.lit("d"), M.Mix())
    assert mixed.count() == 0
