import hashlib
import re
from collections import defaultdict

import pytest

from salesmart.llm import exact_dedup as E

from .conftest import EDGE_ROWS, clashing


def brute(rows):
    groups = defaultdict(list)
    for i, (doc, text, *_) in enumerate(rows):
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()
        groups[key].append((-len(text or ""), doc is None, doc or 0, i, doc))
    out = []
    for key, members in groups.items():
        members.sort()
        out += [(m[4], members[0][4], len(members), m is members[0], key) for m in members]
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


# at the larger supports no group is frequent, at the smallest every one is
@pytest.mark.parametrize("support", [0.5, 0.2, 0.01])
def test_matches_brute_force(edge, support):
    got = [tuple(r) for r in E.exact_dedup(edge, support=support).collect()]
    assert order(got) == order(brute(EDGE_ROWS))


@pytest.mark.parametrize("support", [0.5, 0.01])
def test_drop_copies_keeps_the_winners(edge, support):
    wide = clashing(edge, "key", "_key", "points", "_row", "win", "size", "first")
    kept = E.drop_copies(wide, support=support)
    assert kept.columns == wide.columns
    want = [r[0] for r in brute(EDGE_ROWS) if r[3]]
    assert order([(r.doc_id,) for r in kept.collect()]) == order([(x,) for x in want])


def test_empty(empty):
    assert E.exact_dedup(empty).count() == 0
    assert E.drop_copies(empty).count() == 0


def test_frequent_misses_nothing_above_the_support(spark):
    rows = [("hot",)] * 400 + [("warm",)] * 150 + [(f"cold {i}",) for i in range(450)]
    df = spark.createDataFrame(rows, "key string").repartition(7)
    found = {r.key for r in E.frequent(df, "key", 0.1).collect()}
    assert {"hot", "warm"} <= found and len(found) <= 10


def test_no_python_and_no_shuffle_of_frequent_groups(edge):
    plan = E.exact_dedup(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert "BroadcastHashJoin" in plan
