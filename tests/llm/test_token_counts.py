import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salesmart.llm import token_counts as T

from .conftest import EDGE_ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_matches_the_library(spark, docs, edge, library):
    for df in (docs.select("doc_id", "text"), edge.select("doc_id", "text")):
        texts = {r.doc_id: r.text or "" for r in df.collect()}
        got = T.token_counts(df, PATH).collect()
        assert len(got) == df.count()
        for r in got:
            want = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
            assert (r.n_tokens, r.over_limit, r.n_bytes) == (want, want > 2048, len(texts[r.doc_id].encode()))


def test_odd_characters(library):
    rng = random.Random(5)
    parts = list("ab '  \n\t\x0b\x1c\x85\xa0éßΣσİ漢😀12!?.S<") + ["<|endoftext|>", "'ll", "é", "‍", "ﬁ", "　"]
    merger = T.PairMerger(PATH)
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        assert merger.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_forgetting_words_changes_nothing(monkeypatch):
    merger = T.PairMerger(PATH)
    text = " ".join(f"word{i} thble{i}" for i in range(300))
    whole = merger.count(text)
    monkeypatch.setattr(T, "KEEP", 7)
    assert merger.count(text) == whole and len(merger._known) <= 700


def test_empty(empty):
    assert T.token_counts(empty, PATH).count() == 0
    assert len(EDGE_ROWS) > 0
