"""Language identification as a mixture of languages.

A document is a mixture of languages; each language is a distribution over
hashed character trigrams (letters lower-cased, all else a space).  The
distributions are counted over every training document.  For each document,
expectation-maximisation estimates the share of each language; the shares are
then fitted again for the best one, two, three languages and so on, as long as
one more brings a gain in likelihood above the penalty for its share.  The
prediction is the language with the largest share of the set, the score that
share.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and no shares; training rows with a null text or language are not counted; no
training rows at all make every document ``und``; repeated rows count as often
as they occur; other columns are carried through, or not read by the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Trigram bins of a language's distribution.
BINS = 1 << 14
#: Pseudo-count of a bin.
SMOOTH = 0.1
ROUNDS = 8
#: Log-likelihood that an added language must bring, in units of log(n) / 2;
#: above 1 because overlapping trigrams are not independent.
PENALTY = 6.0
#: (trigram, language) likelihoods held at once.
CELLS = 1_000_000

UNKNOWN = "und"

_fold: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For each code point: its lower-case letter, or a space."""
    global _fold
    if _fold is None:
        table = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _fold = table
    return _fold


def trigrams(text: str | None) -> np.ndarray:
    """The bin of each trigram of the whole text that has a letter."""
    if not text:
        return np.empty(0, np.int64)
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    codes = codes[keep]
    if len(codes) < 3:
        return np.empty(0, np.int64)
    mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA6B) + codes[2:] * np.uint32(0xC2B2AE35)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    return (mixed >> np.uint32(18)).astype(np.int64)


def count_trigrams(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, bin, n) over all rows: tasks send one row for each language and bin they met."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, body in zip(batch["lang"], batch["text"]):
                found = trigrams(body)
                if value not in counts:
                    counts[value] = np.zeros(BINS, np.int64)
                if len(found):
                    counts[value] += np.bincount(found, minlength=BINS)
        for value, n in counts.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": value, "bin": at.astype(np.int32), "n": n[at]})

    ship(docs.sparkSession)
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    parts = rows.mapInPandas(count, "lang string, bin int, n long")
    return parts.groupBy("lang", "bin").agg(F.sum("n").alias("n"))


class Model:
    """The languages in order and, for each, the likelihood of each bin."""

    def __init__(self, counts: pd.DataFrame):
        self.langs = sorted(counts["lang"].unique())
        table = np.full((BINS, max(1, len(self.langs))), SMOOTH)
        place = {v: i for i, v in enumerate(self.langs)}
        table[counts["bin"].to_numpy(), counts["lang"].map(place).to_numpy(np.int64)] += counts["n"].to_numpy()
        self.table = table / table.sum(axis=0)

    def mixtures(self, texts: list[str | None]) -> list[tuple[list[str], list[float]]]:
        """For each text the languages of the chosen set, by falling share, and the shares."""
        out: list[tuple[list[str], list[float]]] = [([], [])] * len(texts)
        held, cells = [], 0
        for i, text in enumerate(texts):
            found = trigrams(text) if self.langs else ()
            if len(found):
                bins, n = np.unique(found, return_counts=True)
                held.append((i, bins, n))
                cells += len(bins) * len(self.langs)
            if cells > CELLS:
                self._fit(held, out)
                held, cells = [], 0
        if held:
            self._fit(held, out)
        return out

    def _fit(self, held: list, out: list) -> None:
        sizes = np.array([len(b) for _, b, _ in held])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        doc = np.repeat(np.arange(len(held)), sizes)
        n = np.concatenate([c for _, _, c in held]).astype(float)
        like = self.table[np.concatenate([b for _, b, _ in held])]
        total = np.add.reduceat(n, starts)
        k = len(self.langs)
        shares, _ = _em(like, n, doc, starts, total, np.full((len(held), k), 1 / k))
        order = np.argsort(-shares, axis=1, kind="stable")
        best = [None] * len(held)
        score = np.full(len(held), -np.inf)
        active = np.arange(len(held))
        for m in range(1, k + 1):
            # only documents that gained from the language before are tried with one more
            rows = np.isin(doc, active)
            place = np.searchsorted(active, doc[rows])
            langs = order[active, :m]
            part = np.take_along_axis(like[rows], langs[place], axis=1)
            first = np.concatenate(([0], np.cumsum(sizes[active])[:-1]))
            begin = np.maximum(np.take_along_axis(shares[active], langs, axis=1), 1e-3)
            begin /= begin.sum(axis=1, keepdims=True)
            pi, fit = _em(part, n[rows], place, first, total[active], begin)
            value = fit - (m - 1) * PENALTY * np.log(total[active] + 1) / 2
            gained = value > score[active]
            for j in np.flatnonzero(gained):
                best[active[j]] = (langs[j], pi[j])
            score[active] = np.maximum(score[active], value)
            active = active[gained]
            if not len(active):
                break
        for (i, _, _), (langs, pi) in zip(held, best):
            turn = np.argsort(-pi, kind="stable")
            out[i] = [self.langs[x] for x in langs[turn]], [float(x) for x in pi[turn]]


def _em(like, n, doc, starts, total, shares):
    """Shares after ROUNDS rounds, and the log-likelihood at them, of all documents at once."""
    if shares.shape[1] > 1:
        for _ in range(ROUNDS):
            joint = like * shares[doc]
            joint *= (n / joint.sum(axis=1))[:, None]
            shares = np.add.reduceat(joint, starts, axis=0) / total[:, None]
    mixed = np.log((like * shares[doc]).sum(axis=1))
    return shares, np.add.reduceat(n * mixed, starts)


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """The model of all rows of ``docs``: BINS numbers a language reach the driver."""
    return Model(count_trigrams(docs, lang, text).toArrow().to_pandas())


def language_mixture(model: Model, text: Column, spark) -> Column:
    """A struct for each text: lang, score, and the arrays langs and shares of its mixture."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, langs array<string>, shares array<double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = shared.value.mixtures(list(batch))
            yield pd.DataFrame(
                {
                    "lang": [x[0] if x else UNKNOWN for x, _ in found],
                    "score": [min(1.0, s[0]) if s else 0.0 for _, s in found],
                    "langs": [x for x, _ in found],
                    "shares": [s for _, s in found],
                }
            )

    return predict(text)
