"""Decontamination against a word-by-word search, and its parts."""

import random
import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from salesmart.llm import decontamination as D
from salesmart.llm.registry import QUERIES, SQL
from tests.llm.conftest import EDGE_ROWS, SF, clashing

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def expected(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for id, text in docs:
        w, hit, named = words(text), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                found = windows.get(tuple(w[i : i + m]))
                if found:
                    hit.update(range(i, i + m))
                    named |= found
        ids = sorted(str(i) for i in named if i is not None)
        out.append((id, len(w), len(hit), len(ids), sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def same(spark, docs, items, parts=3):
    got = D.decontamination(spark.createDataFrame(docs, DOCS).repartition(parts), spark.createDataFrame(items, ITEMS))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected(docs, items), key=repr)


def test_random_texts_of_few_words(spark):
    """Few words, so that shingles are common, windows overlap, repeat within texts and are shared by items."""
    rng = random.Random(5)
    some = "a b é 1".split()

    def text(low, high):
        return " ".join(rng.choices(some, (9, 3, 1, 1), k=rng.randint(low, high)))

    items = [(i, text(0, 18)) for i in range(30)]
    items += [(i, items[i % 7][1]) for i in range(30, 60)] + [(3, "A-a.a"), (61, "b")]
    docs = [(i, text(0, 60)) for i in range(150)]
    same(spark, docs, items)


def test_planted_passages_and_near_misses(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([4, 9, 10, 11, 40])))) for i in range(40)]
    docs = []
    for i in range(200):
        around = rng.choices(vocabulary, k=rng.randint(0, 50))
        w = words(items[i % 40][1])
        cut = w[rng.randint(0, 3) : len(w) - rng.randint(0, 3)]  # windows at both ends of the text, or too short
        docs.append((i, "; ".join(around[: i % 9] + cut + around[i % 9 :]).upper()))
    same(spark, docs, items)


def test_hot_passage_and_hot_window(spark):
    """One passage in most documents, one window in most items: worked out once for each set of items."""
    passage = " ".join(f"p{i}" for i in range(30))
    items = [(i, f"{passage} tail{i}" if i % 3 else f"other{i} " * 12) for i in range(300)]
    docs = [(i, f"{passage} x{i}" if i % 5 else f"y{i}") for i in range(500)]
    same(spark, docs, items)


def test_edge_rows(spark):
    docs = [(r[0], r[1]) for r in EDGE_ROWS] + [(20, "e" * 300_000 + " ÉCOLE école"), (21, " " * 2_000_000 + "one")]
    items = [(1, None), (2, ""), (3, "?!"), (None, "hello big"), (4, "École"), (4, "one two"), (5, "long " * 25), (6, "x" * 20_000), (7, "e" * 300_000)]
    same(spark, docs, items)
    same(spark, docs, [])
    same(spark, [], items)
    same(spark, [], [])


def test_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d")], DOCS)
    items = spark.createDataFrame([(1, "b c")], ITEMS)
    more = D.decontamination(
        clashing(docs, "id", "row", "found", "n_words", "hash", "window"), clashing(items, "item", "words", "m", "k", "shingles")
    )
    assert sorted(map(tuple, more.collect())) == sorted(expected([(1, "a b c"), (2, "d")], [(1, "b c")]))


@pytest.mark.parametrize("block", [1 << 20, 16])
def test_words_and_hashes(monkeypatch, block):
    """Borders, hashes and shingles are the same whatever is read at once."""
    texts = ["", None, "Ab1 c-d", "é" * 3000, "x" * 9000 + " y", "one  two\x00three É"] * 3
    monkeypatch.setattr(D, "BLOCK", block)
    monkeypatch.setattr(D, "_powers", [])
    got, hashes = [], {}
    for at, some in D.read_words(pa.array(texts)):
        assert (some.shingles(1)[1].shape[0]) == len(some.starts)
        for d in range(len(some.first) - 1):
            a, b = some.first[d], some.first[d + 1]
            found = some.words(a, b)
            got.append(found)
            for w, h in zip(found, some.hashes[a:b].tolist()):
                assert hashes.setdefault(w, h) == h
    assert got == [words(t) for t in texts]
    assert len(set(hashes.values())) == len(hashes)


def test_a_block_border_does_not_change_hashes(monkeypatch):
    text = " ".join(f"word{i}" * (i % 5 + 1) for i in range(3000)) + " " + "z" * 10_000
    data = np.frombuffer(text.encode(), np.uint8)
    whole = D.Words(data, np.array([0, len(data)])).hashes
    monkeypatch.setattr(D, "BLOCK", 64)
    monkeypatch.setattr(D, "_powers", [])
    assert (D.Words(data, np.array([0, len(data)])).hashes == whole).all()


def test_query(spark, docs):
    from salesmart.llm.common import table

    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    got = QUERIES["op12_benchmark_decontamination"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(expected(rows, items))
    assert any(r["contaminated"] for r in got) and not all(r["contaminated"] for r in got)
    assert "op12_benchmark_decontamination" in SQL
