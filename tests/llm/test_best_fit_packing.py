import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salesmart.llm import best_fit_packing as B
from salesmart.llm.registry import packed

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check_round_trip(df, library, capacity=2048):
    texts = [(r.doc_id, r.text) for r in df.collect()]
    want = Counter()
    for doc, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
            want[doc, k, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())] += 1
    got = packed(df).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in got)
    return len(places), -(-total // capacity)


def test_documents(docs, library):
    used, least = check_round_trip(docs.select("doc_id", "text"), library)
    assert used <= least + 3


def test_edge_cases(edge, empty, library):
    check_round_trip(edge, library)
    assert packed(empty).count() == 0


def test_ids_are_returned_on_request(edge, library):
    rows = B.pieces(edge.where("doc_id in (8, 13, 15)"), PATH, with_ids=True).collect()
    texts = {r.doc_id: r.text for r in edge.collect()}
    for r in rows:
        assert r.ids == library.encode(texts[r.id], add_special_tokens=False).ids + [0]


def test_encoder_matches_the_library(library):
    rng = random.Random(2)
    parts = list("ab '  \n\t\x0b\x1c\x85\xa0éß漢😀12!?.sS<") + ["<|endoftext|>", "'ll", "́", " ", "　"]
    encode = B.encoder(PATH)
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        assert encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 50, 200])
    histogram = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 3000)))
    held = Counter()
    for filling, n in B.plan(dict(histogram), capacity):
        assert sum(filling) <= capacity and n > 0
        for x in filling:
            held[x] += n
    assert held == histogram


def test_plan_is_near_the_best_where_fillings_matter():
    # 51 fits only with 49; then at most three 26, or four 25, share a sequence: 600 + 134 + 100
    histogram = {51: 600, 26: 400, 49: 600, 25: 400, 10: 0}
    assert sum(n for _, n in B.plan(histogram, 100)) <= 1.03 * 834


def test_lp_covers_nearly_all_demand_near_the_optimum():
    lengths, demand = np.array([30, 40, 60, 70]), np.array([100.0, 100.0, 100.0, 100.0])
    used = B.configuration_lp(lengths, demand, 100)
    covered = np.zeros(4)
    for filling, x in used.items():
        assert sum(lengths[list(filling)]) <= 100
        for i in filling:
            covered[i] += x
    assert (covered >= 99.9).all() and sum(used.values()) < 1.15 * 200
