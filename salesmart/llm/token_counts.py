"""Token counts by byte-pair merging, without making the tokens.

A text is normalised and split into words as the vocabulary file says.  A
word's bytes are a linked list of symbols; a heap holds the adjacent pairs that
can merge, the lowest rank (then the leftmost) on top.  Each popped pair that
still stands is merged and its new neighbours are pushed.  A word has as many
tokens as symbols minus merges, so no identifier is ever looked up.  Counts of
words are remembered by each Python worker, up to ``KEEP`` words.

Defined cases: null and empty texts have no bytes and no tokens; the strings of
special tokens inside a text are one token each, as the file's library counts
them; repeated rows are counted each; other columns are never read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .best_fit_packing import byte_letters
from .common import ship

KEEP = 1_000_000


class PairMerger:
    """Token counts for a byte-level merge vocabulary with a word-end suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        model, steps = content["model"], [content["normalizer"] or {"type": "Sequence", "normalizers": []}]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("only plain byte-pair vocabularies are supported")
        self._compose, self._lower = False, False
        while steps:
            step = steps.pop(0)
            kind = step["type"]
            if kind == "Sequence":
                steps = step["normalizers"] + steps
            elif kind == "NFC":
                self._compose = True
            elif kind == "Lowercase":
                self._lower = True
            elif kind != "Replace" or step["pattern"] != {"Regex": "\\s+"} or step["content"] != " ":
                raise ValueError(f"normaliser {kind} is not supported")
        split = next(x for x in content["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        if split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("only splitters that keep their matches are supported")
        self._words = regex.compile(split["pattern"]["Regex"]).findall
        special = sorted((t["content"] for t in content["added_tokens"]), key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, special))) if special else None
        letters = byte_letters()
        self._inner = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self._final = [vocab[c + suffix] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self._merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self._merges[vocab[left], vocab[right]] = rank, vocab[left + right]
        self._known: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Tokens of one word: its bytes minus the merges made."""
        raw = word.encode()
        symbols = [self._inner[b] for b in raw]
        symbols[-1] = self._final[raw[-1]]
        merges, n = self._merges, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i) for i in range(n - 1) if (m := merges.get((symbols[i], symbols[i + 1])))]
        heapify(heap)
        tokens = n
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            merge = merges.get((symbols[i], symbols[j]))
            if merge is None or merge[0] != rank:
                continue
            symbols[i], symbols[j] = merge[1], -1
            after[i] = k = after[j]
            tokens -= 1
            if k < n:
                before[k] = i
                if m := merges.get((symbols[i], symbols[k])):
                    heappush(heap, (m[0], i))
            h = before[i]
            if h >= 0 and (m := merges.get((symbols[h], symbols[i]))):
                heappush(heap, (m[0], h))
        if len(self._known) >= KEEP:
            self._known.clear()
        self._known[word] = tokens
        return tokens

    def _plain(self, text: str) -> int:
        if self._compose and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self._lower:
            # letter by letter: a sigma at the end of a word gets no form of its own
            text = text.replace("Σ", "σ").lower()
        known, word = self._known.get, self.word
        return sum([known(w) or word(w) for w in self._words(text)])

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self._special is None or not self._special.search(text):
            return self._plain(text)
        parts = self._special.split(text)
        return len(parts) - 1 + sum(self._plain(p) for p in parts if p)


@lru_cache(maxsize=2)
def merger(path: str) -> PairMerger:
    return PairMerger(path)


def token_counts(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """One row for each row of ``docs``: the id, n_bytes, n_tokens and over_limit."""

    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = merger(vocabulary)
        for batch in batches:
            yield pd.Series([of.count(x) for x in batch], dtype="int64")

    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(id), F.octet_length(body).cast("long").alias("n_bytes"), count(body).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
