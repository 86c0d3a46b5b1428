"""Toxicity by weak supervision.

1. Lexicon: word beginnings (4 to 7 letters) and whole words that stand in at
   least 1 % of the toxic training documents are counted in all training
   documents; the most telling ones, each bringing something new, become the
   lexicon.
2. Voters: each entry votes when it occurs once, and again when it occurs
   repeatedly; further voters look at the density of entries, at patterns
   (shouting, exclamation marks, insults aimed at a reader, masked words), and
   one votes against when nothing was found.
3. Label model: a generative model of the votes given the unseen label, fitted
   by expectation-maximisation over all training rows and all rows without a
   label outside the held-out fold.  Known labels are kept fixed.  It gives
   each voter's accuracies and, from the second moments, the correlations of
   voters within a class; a voter's say is divided by how much others repeat it.
4. A logistic regression on the voters' counts learns the posterior labels of
   a sample of about ``FIT_ROWS`` rows at most, taken by the hash of the id (the
   labels where known), and scores every row.

The learned parts are small: a lexicon of ``ENTRIES``, a few numbers for each
pair of voters, one weight a feature.  Texts are read three times, in parallel.

Defined cases: null and empty texts have no hits and get the score of such a
document; rows without a label are scored only; without both classes in the
training rows every score is the share of toxic training rows (0 without any);
repeated rows count as often as they occur; other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, marked, marks, ship, staged

ENTRIES = 64
#: Share of the toxic training documents that an entry must stand in.
LEAST_SHARE = 0.01
#: Rows that the classifier is fitted on, at most and about.
FIT_ROWS = 20_000
ROUNDS = 6
#: Rows that a task of the label model adds up; the number of tasks follows the input.
ROWS_A_TASK = 50_000
STEMS = (4, 5, 6, 7)
RIDGE = 1.0
#: Words whose entries a Python worker remembers.
KEEP = 200_000

#: Patterns of shouting, of aimed insults and of masked words.
PATTERNS = (
    r"[!?]{2,}",
    r"\b[A-Z]{5,}\b",
    r"\b(?:you|your|u|du|dich|ihr|tu|vous|toi|t[uú]|usted)\b\W+(?:\w+\W+){0,2}(?:are|is|bist|seid|es|êtes|eres)\b",
    r"\w[*#@$%]{2,}\w?",
    r"(\w)\1{3,}",
)
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_PATTERNS = [re.compile(p) for p in PATTERNS]


def stems(word: str) -> list[str]:
    """The features of a word: its beginnings, and itself with an end mark."""
    return [word[:k] for k in STEMS if len(word) >= k] + [word + "$"]


def _words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def frequent_stems(toxic: DataFrame, total: int) -> list[str]:
    """Features in at least LEAST_SHARE of the toxic documents: no more than their mean number over that share."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))

    def of(w: Column) -> Column:
        return F.array(*[F.when(F.length(w) >= k, F.substring(w, 1, k)) for k in STEMS], F.concat(w, F.lit("$")))

    found = (
        toxic.select(F.explode(F.array_distinct(F.flatten(F.transform(words, of)))).alias("stem"))
        .where("stem is not null")
        .groupBy("stem")
        .count()
        .where(F.col("count") >= max(2, LEAST_SHARE * total))
    )
    return sorted(r.stem for r in found.select("stem").collect())


def _log_ratio(tox: np.ndarray, clean: np.ndarray, n_tox: int, n_clean: int) -> np.ndarray:
    """The G statistic of each feature against the label; negative where it speaks for clean."""

    def part(a, of):
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-12) / np.maximum(of, 1e-12)), 0.0)

    n, have = n_tox + n_clean, tox + clean
    g = (
        part(tox, n_tox * have / n)
        + part(clean, n_clean * have / n)
        + part(n_tox - tox, n_tox * (n - have) / n)
        + part(n_clean - clean, n_clean * (n - have) / n)
    )
    return np.where(tox / n_tox > clean / n_clean, g, -g)


def learn_lexicon(train: DataFrame) -> tuple[list[str], int, int]:
    """The entries, best first, and the numbers of toxic and clean rows of ``train`` (text, y)."""
    sizes = {int(r.y): int(r["count"]) for r in train.groupBy("y").count().collect()}
    n_tox, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_tox or not n_clean:
        return [], n_tox, n_clean
    candidates = frequent_stems(train.where("y = 1").select("text"), n_tox)
    if not candidates:
        return [], n_tox, n_clean
    place = {s: i for i, s in enumerate(candidates)}
    shared = train.sparkSession.sparkContext.broadcast(place)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, known = shared.value, {}
        out = np.zeros((2, 2, len(place)), np.int64)  # by label: documents with it, with it twice
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"]):
                seen: Counter = Counter()
                for word, n in Counter(_words(text)).items():
                    at = known.get(word)
                    if at is None:
                        if len(known) >= KEEP:
                            known.clear()
                        at = known[word] = tuple([place[s] for s in stems(word) if s in place])
                    for i in at:
                        seen[i] += n
                if seen:
                    at = np.fromiter(seen, np.int64, len(seen))
                    out[y, 0, at] += 1
                    out[y, 1, at] += np.fromiter(seen.values(), np.int64, len(seen)) > 1
        i = np.arange(len(place))
        yield pd.DataFrame({"i": i, "c1": out[0, 0], "c2": out[0, 1], "t1": out[1, 0], "t2": out[1, 1]})

    parts = train.select("text", F.col("y").cast("int").alias("y")).mapInPandas(count, "i long, c1 long, c2 long, t1 long, t2 long")
    table = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in ("c1", "c2", "t1", "t2")]).toArrow().to_pandas().set_index("i").sort_index()
    once = _log_ratio(table["t1"].to_numpy(float), table["c1"].to_numpy(float), n_tox, n_clean)
    again = _log_ratio(table["t2"].to_numpy(float), table["c2"].to_numpy(float), n_tox, n_clean)
    g = np.maximum(once, again)
    chosen: list[str] = []
    # an entry that only lengthens or shortens a chosen one says nothing new
    for i in np.argsort(-g, kind="stable"):
        if g[i] < 4 or len(chosen) == ENTRIES:
            break
        stem = candidates[table.index[i]]
        bare = stem.rstrip("$")
        if not any(bare.startswith(c.rstrip("$")) or c.rstrip("$").startswith(bare) for c in chosen):
            chosen.append(stem)
    return chosen, n_tox, n_clean


def read_features(docs: DataFrame, lexicon: list[str]) -> DataFrame:
    """``docs`` (id, text, and what else it has) with ``hits``: counts of the entries, of the patterns, and words."""
    shared = docs.sparkSession.sparkContext.broadcast({s: i for i, s in enumerate(lexicon)})
    m, width = len(lexicon), len(lexicon) + len(PATTERNS) + 1

    @F.pandas_udf("array<float>")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        place, known = shared.value, {}
        for batch in batches:
            out = np.zeros((len(batch), width), np.float32)
            for row, text in zip(out, batch):
                words = _words(text)
                for word, n in Counter(words).items():
                    at = known.get(word)
                    if at is None:
                        if len(known) >= KEEP:
                            known.clear()
                        at = known[word] = tuple([place[s] for s in stems(word) if s in place])
                    for i in at:
                        row[i] += n
                for k, p in enumerate(_PATTERNS):
                    row[m + k] = sum(1 for _ in p.finditer(text)) if text else 0
                row[-1] = len(words)
            yield pd.Series(list(out))

    return docs.withColumn("hits", hits(F.col("text"))).drop("text")


def voters(hits: np.ndarray) -> np.ndarray:
    """(row, voter): which voters speak."""
    m = hits.shape[1] - len(PATTERNS) - 1
    entries, patterns, words = hits[:, :m], hits[:, m:-1], np.maximum(hits[:, -1:], 1)
    total = entries.sum(axis=1, keepdims=True)
    density = 100 * total / words
    return np.hstack(
        (entries >= 1, entries >= 2, entries >= 4, density >= 0.5, density >= 1, density >= 2, total >= 2, total >= 5,
         patterns >= 1, 100 * patterns / words >= 2, total == 0)
    )


def features(hits: np.ndarray) -> np.ndarray:
    """(row, feature) of the classifier; the last one is constant."""
    m = hits.shape[1] - len(PATTERNS) - 1
    entries, patterns, words = hits[:, :m], hits[:, m:-1], np.maximum(hits[:, -1:], 1)
    total = entries.sum(axis=1, keepdims=True)
    return np.hstack(
        (np.log1p(entries), entries >= 2, np.log1p(100 * entries / words), np.log1p(total), np.log1p(100 * total / words),
         np.log1p(patterns), np.log1p(100 * patterns / words), np.log(words) / 5, np.ones_like(words))
    ).astype(np.float64)


@dataclass
class LabelModel:
    """Chances that voters speak, by class; the share of class 1; each voter's say."""

    speaks: np.ndarray
    prior: float
    say: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The chance of class 1 of each row."""
        p = np.clip(self.speaks, 1e-6, 1 - 1e-6)
        spoken, silent = np.log(p[1] / p[0]), np.log((1 - p[1]) / (1 - p[0]))
        odds = np.log(self.prior / (1 - self.prior)) + votes @ (self.say * (spoken - silent)) + (self.say * silent).sum()
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _moments(rows: DataFrame, model: LabelModel | None, pairs: bool) -> list[np.ndarray]:
    """Sums over all rows: for each class its weight, its votes and, if wanted, its pairs of votes."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = None
        for batch in batches:
            votes = voters(np.stack(batch["hits"].to_numpy())).astype(np.float64)
            y = batch["y"].to_numpy(np.float64, na_value=np.nan)
            if shared.value is not None:
                y = np.where(np.isnan(y), shared.value.posterior(votes), y)
            else:
                votes, y = votes[~np.isnan(y)], y[~np.isnan(y)]
            parts = []
            for w in (1 - y, y):
                parts += [[w.sum()], w @ votes] + ([((votes * w[:, None]).T @ votes).ravel()] if pairs else [])
            parts = np.concatenate(parts)
            out = parts if out is None else out + parts
        if out is not None:
            yield pd.DataFrame({"i": np.arange(len(out)), "v": out})

    sums = rows.mapInPandas(add, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").toArrow().to_pandas()["v"].to_numpy()
    return np.split(sums, 2) if len(sums) else []


def fit_label_model(rows: DataFrame) -> LabelModel | None:
    """Expectation-maximisation over ``rows`` (hits, y); None if one class is missing."""
    # a task sends sums for all pairs of voters, so it should read many rows
    rows = rows.coalesce(max(1, -(-rows.count() // ROWS_A_TASK)))
    model = None
    for turn in range(ROUNDS + 1):
        last = turn == ROUNDS
        both = _moments(rows, model, last)
        if not both or not both[0][0] or not both[1][0]:
            return None
        m = len(both[0]) - 1 if not last else int((np.sqrt(4 * len(both[0]) - 3) - 1) / 2)
        weight = np.array([s[0] for s in both])
        speaks = np.stack([(s[1 : m + 1] + 0.5) / (s[0] + 1) for s in both])
        model = LabelModel(speaks, float(weight[1] / weight.sum()), np.ones(m))
    repeated = np.zeros(m)
    for c in (0, 1):
        mean = both[c][1 : m + 1] / weight[c]
        cov = both[c][m + 1 :].reshape(m, m) / weight[c] - np.outer(mean, mean)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        rho = np.clip(cov / np.outer(sd, sd), 0, 1)
        np.fill_diagonal(rho, 0)
        repeated = np.maximum(repeated, rho.sum(axis=1))
    return LabelModel(speaks, model.prior, 1 / (1 + repeated))


def fit_classifier(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels, by Newton's method."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (q - p) + ridge * w
        hessian = (x * (q * (1 - q) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """One row for each row of ``docs``: the id, held_out, score, predicted and known (the label-model's posterior)."""
    ship(docs.sparkSession)
    # one label an id; ids without one, or with a null one, are unlabelled
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(id).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    known = known.where(~held_out(F.col("id")))
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # most texts have no training label: these don't travel, and the others travel once
    labelled = marks(known.select(F.xxhash64("id").alias("h")), "h")

    @F.pandas_udf("boolean")
    def may_be_labelled(hashes: pd.Series) -> pd.Series:
        return pd.Series(marked(labelled, hashes.to_numpy(np.int64)))

    # labels grow with the corpus, so they are not broadcast at any size
    train = rows.where(may_be_labelled(F.xxhash64("id"))).join(known.hint("merge"), "id").select("text", "y")
    lexicon, n_tox, n_clean = learn_lexicon(staged(train, "train"))
    read = staged(read_features(rows, lexicon), "hits").withColumn("held_out", held_out(F.col("id")))
    fit = staged(read.where(~F.col("held_out")).join(known.hint("merge"), "id", "left").select("id", "hits", "y"), "fit")
    model = fit_label_model(fit) if n_tox and n_clean else None
    if model is None:
        share = n_tox / max(1, n_tox + n_clean)
        return read.select(
            F.col("id").alias(id), "held_out", F.lit(float(share)).alias("score"), F.lit(int(share >= 0.5)).alias("predicted"),
            F.lit(float(share)).alias("posterior"),
        )
    # a sample that depends on the ids alone; about FIT_ROWS rows at most
    every = -(-max(1, fit.count()) // FIT_ROWS)
    sample = fit.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).toArrow().to_pandas()
    hits = np.stack(sample["hits"].to_numpy())
    y = sample["y"].to_numpy(np.float64, na_value=np.nan)
    target = np.where(np.isnan(y), model.posterior(voters(hits).astype(np.float64)), y)
    weights = fit_classifier(features(hits), target)
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))

    @F.pandas_udf("score double, posterior double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, weights = shared.value
        for batch in batches:
            hits = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, len(PATTERNS) + 1))
            yield pd.DataFrame(
                {
                    "score": 1 / (1 + np.exp(-np.clip(features(hits) @ weights, -500, 500))),
                    "posterior": model.posterior(voters(hits).astype(np.float64)),
                }
            )

    return (
        read.select(F.col("id").alias(id), "held_out", score(F.col("hits")).alias("s"))
        .select(id, "held_out", "s.score", (F.col("s.score") >= 0.5).cast("int").alias("predicted"), "s.posterior")
    )
