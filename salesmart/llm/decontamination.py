"""Benchmark decontamination by a prefix-filtered set join.

A-Z are lower-cased; words are runs of characters other than ASCII ones that
are no digit or small letter.  A window is ``WINDOW`` consecutive words of an
item; an item of fewer words, but not none, is one window.  A document word
inside any occurrence of a window is hit.

Tokens of the join are shingles of ``SHINGLE`` consecutive words (of a shorter
window: the whole of it), as 64-bit hashes.

1. Order: how often each shingle of the benchmark occurs in all documents.
2. Prefix: a window that occurs whole has all its shingles, so for containment
   of one the necessary prefix is its rarest shingle.  A window with a shingle
   that no document has is out at once.
3. Join: the documents hand on only the places where a prefix shingle stands,
   each with the words around it.  A bitmap of the hashes sifts the rest out
   before anything moves.
4. Bounds: the window must fit into the document on both sides of the shingle,
   by its length and the place of the shingle in it.
5. Verification: the words at that place are compared with those of the window.

Windows with the same items are one class.  Which items a document holds is
worked out once for each distinct set of classes, so a passage that stands in
many documents, or in many items, does not multiply out.

Bounds: the bitmap has at most ``MOST_BITS`` (128 MB); beyond it sifts less and
the result stays the same.  No other data of the tables is broadcast but by
Spark's own check of its size.  A task holds the words of one batch of
documents, and of a long document its word borders and hashes.

Defined cases: null, empty and wordless texts have no words and no hits;
items without words have no windows; an item with a null id marks words but is
not listed; items with equal ids are listed once; repeated documents are rows
of their own; without hits ``items_sha256`` is of the empty text; empty tables
give rows without hits, or none; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import marked, marks, ship, staged

#: Fixed value: words of a window.
WINDOW = 10
#: Words of a shingle.
SHINGLE = 5
#: Bits of the bitmap: 64 for each hash, within these.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 30
#: Bytes of text whose words are hashed at once, and length from which a word is hashed alone.
BLOCK, LONG_WORD = 1 << 20, 1 << 12

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_rng = np.random.default_rng(12)
#: Odd factors of the places of a shingle.
_PLACES = _rng.integers(0, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(BLOCK + LONG_WORD + 1, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from its bytes alone."""
    power, inverse = _tables()
    out = np.empty(len(starts), np.uint64)
    long = np.flatnonzero(ends - starts > LONG_WORD)
    at = 0
    while at < len(starts):
        low = starts[at]
        upto = max(at + 1, int(np.searchsorted(starts, low + BLOCK)))
        high = min(int(ends[upto - 1]), int(low) + BLOCK + LONG_WORD)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=sums[1:])
        a, b = starts[at:upto] - low, np.minimum(ends[at:upto], high) - low
        out[at:upto] = _mixed((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        at = upto
    for i in long:
        out[i] = np.uint64(xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes()))
    return out


class Words:
    """The words of some documents: bytes, borders, hashes, and the document of each."""

    def __init__(self, raw: np.ndarray, borders: np.ndarray):
        small = (raw >= 97) & (raw <= 122)
        capital = (raw >= 65) & (raw <= 90)
        word = small | capital | (raw >= 128) | ((raw >= 48) & (raw <= 57))
        self.data = raw + capital.view(np.uint8) * np.uint8(32)
        new = np.zeros(len(raw) + 1, bool)
        new[borders] = True  # a word ends with its document
        before = np.concatenate(([False], word[:-1])) if len(raw) else word
        after = np.concatenate((word[1:], [False])) if len(raw) else word
        self.starts = np.flatnonzero(word & (~before | new[:-1]))
        self.ends = np.flatnonzero(word & (~after | new[1:])) + 1
        self.doc = np.searchsorted(borders, self.starts, "right") - 1
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        #: first word of each document, and one past the last
        self.first = np.searchsorted(self.doc, np.arange(len(borders)))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of the shingles that lie in one document."""
        n = len(self.starts) - width + 1
        if n <= 0:
            return np.empty(0, int), np.empty(0, np.int64)
        total = np.full(n, width, np.uint64)
        for j in range(width):
            total += self.hashes[j : j + n] * _PLACES[j]
        whole = np.flatnonzero(self.doc[:n] == self.doc[width - 1 :])
        return whole, _mixed(total)[whole].view(np.int64)

    def words(self, a: int, b: int) -> list[str]:
        return [self.data[s:e].tobytes().decode() for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())]


def read_words(texts: pa.Array) -> Iterator[tuple[int, Words]]:
    """(place of the first text, words) of runs of texts of about BLOCK bytes, at least one text each."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, values = texts.buffers()
    borders = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(borders, borders[at] + BLOCK, "right")) - 1)
        yield at, Words(data[borders[at] : borders[upto]], borders[at : upto + 1] - borders[at])
        at = upto


def item_windows(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    """(item, words, m, k, shingles): each window of each item, with the hashes of its shingles of k words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, some in read_words(batch.column(1)):
                shingles = {k: dict(zip(*(x.tolist() for x in some.shingles(k)))) for k in range(1, SHINGLE + 1)}
                for d in range(len(some.first) - 1):
                    a, b = int(some.first[d]), int(some.first[d + 1])
                    m = min(WINDOW, b - a)
                    k = min(SHINGLE, m)
                    for low in range(a, b - m + 1, 10_000) if m else ():
                        places = range(low, min(low + 10_000, b - m + 1))
                        words = some.words(low, places[-1] + m)
                        yield pa.RecordBatch.from_pydict(
                            {
                                "item": pa.array([batch.column(0)[at + d].as_py()] * len(places), pa.string()),
                                "words": [" ".join(words[p - low : p - low + m]) for p in places],
                                "m": pa.array([m] * len(places), pa.int32()),
                                "k": pa.array([k] * len(places), pa.int32()),
                                "shingles": pa.array([[shingles[k][q] for q in range(p, p + m - k + 1)] for p in places], pa.list_(pa.int64())),
                            }
                        )

    ship(benchmark.sparkSession)
    items = benchmark.select(F.col(id).cast("string").alias("item"), F.col(text).alias("text"))
    return items.mapInArrow(cut, "item string, words string, m int, k int, shingles array<long>")


def window_classes(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct windows, each with the class of those that have the same items; and the items of the classes.

    ``cut`` has the rows of :func:`item_windows`.
    """
    pairs = staged(cut.select("words", "item").distinct(), "window-items")

    def prints(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), "item").cast("decimal(20,0)"))

    # a set of items is told by its size and two 64-bit hashes added up, so that it is never put together
    sets = pairs.groupBy("words").agg(F.count(F.lit(1)).alias("n"), prints(1).alias("p1"), prints(2).alias("p2"))
    shapes = cut.groupBy("words").agg(F.first("m").alias("m"), F.first("k").alias("k"), F.first("shingles").alias("shingles"))
    windows = staged(shapes.join(sets, "words").withColumn("window", F.monotonically_increasing_id()), "windows")
    by = ["n", "p1", "p2"]
    classes = windows.groupBy(*by).agg(F.min("window").alias("class"))
    windows = staged(windows.join(classes, by).drop(*by), "window-classes")
    named = windows.where(F.col("window") == F.col("class")).select("words", "class")
    return windows, staged(pairs.join(named, "words").select("class", "item"), "class-items")


def bitmap(hashes: DataFrame) -> Broadcast:
    """A bitmap with room for the distinct hashes of ``hashes``, within the bounds."""
    n = hashes.count()
    bits = LEAST_BITS
    while bits < MOST_BITS and bits < 64 * n:
        bits *= 2
    return marks(hashes, hashes.columns[0], bits)


def shingle_counts(texts: DataFrame, sieve: Broadcast, widths: list[int]) -> DataFrame:
    """(hash, n): how often the shingles that pass the sieve occur in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = [np.empty(0, np.int64)]
            for _, some in read_words(batch.column(0)):
                for width in widths:
                    hashes = some.shingles(width)[1]
                    met.append(hashes[marked(sieve, hashes)])
            hashes, n = np.unique(np.concatenate(met), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n)], ["hash", "n"])

    return texts.mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """The windows that can occur, each with its rarest shingle: hash and place in the window."""
    tokens = windows.select("window", F.posexplode("shingles").alias("place", "hash"))
    rarest = (
        tokens.join(counts, "hash", "left")
        .groupBy("window")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "place")).alias("prefix"))
        .where("prefix.n > 0")
    )
    return windows.drop("shingles").join(rarest, "window").select(
        "window", "class", "words", "m", "prefix.hash", "prefix.place"
    )


def candidates(docs: DataFrame, sieve: Broadcast, widths: list[int]) -> DataFrame:
    """(row, id, n_words, found): one row for each document, with the places of shingles that pass the sieve.

    ``docs`` has id and text.  A place has hash, at (its word), before (words
    of ``near`` that stand before it) and near (the words around it that a
    window can reach).
    """
    id_type = docs.schema["id"].dataType
    place = T.StructType(
        [T.StructField("hash", T.LongType()), T.StructField("at", T.LongType()), T.StructField("before", T.IntegerType()),
         T.StructField("near", T.ArrayType(T.StringType()))]
    )
    out = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("id", id_type), T.StructField("n_words", T.LongType()),
         T.StructField("found", T.ArrayType(place))]
    )
    arrow_place = pa.struct(
        [("hash", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("near", pa.list_(pa.string()))]
    )

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, some in read_words(batch.column(1)):
                count = len(some.first) - 1
                found: list[list[dict]] = [[] for _ in range(count)]
                for width in widths:
                    places, hashes = some.shingles(width)
                    keep = marked(sieve, hashes)
                    for p, h in zip(places[keep].tolist(), hashes[keep].tolist()):
                        d = int(some.doc[p])
                        first, last = int(some.first[d]), int(some.first[d + 1])
                        reach = WINDOW - width if width == SHINGLE else 0
                        low = max(first, p - reach)
                        near = some.words(low, min(last, p + width + reach))
                        found[d].append({"hash": h, "at": p - first, "before": p - low, "near": near})
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(np.arange(row, row + count)),
                        "id": batch.column(0).slice(at, count),
                        "n_words": pa.array(np.diff(some.first).astype(np.int64)),
                        "found": pa.array(found, pa.list_(arrow_place)),
                    }
                )
                row += count

    return docs.select("id", "text").mapInArrow(sift, out)


def verified(places: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, first, last, class): occurrences of windows, compared word by word."""
    start = F.col("before") - F.col("place")
    fits = (
        (F.col("place") <= F.col("at"))  # room before the shingle, and after it
        & (F.col("at") - F.col("place") + F.col("m") <= F.col("n_words"))
        & (start >= 0)
        & (start + F.col("m") <= F.size("near"))
    )
    same = F.when(fits, F.concat_ws(" ", F.slice("near", F.greatest(start, F.lit(0)) + 1, F.col("m"))) == F.col("words"))
    first = F.col("at") - F.col("place")
    return places.join(windows, "hash").where(same).select("row", first.alias("first"), (first + F.col("m")).alias("last"), "class")


def covered(spans: Column) -> Column:
    """Words under at least one of the sorted spans (first, last)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))

    def add(seen: Column, span: Column) -> Column:
        fresh = F.greatest(span["last"] - F.greatest(span["first"], seen["upto"]), F.lit(0).cast("long"))
        return F.struct((seen["n"] + fresh).alias("n"), F.greatest(seen["upto"], span["last"]).alias("upto"))

    return F.aggregate(spans, start, add, lambda seen: seen["n"])


def decontamination(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: the id, n_words, n_hit, n_items, items_sha256, contaminated."""
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    cut = staged(item_windows(benchmark, item, item_text), "cut")
    windows, class_items = window_classes(cut)
    widths = sorted(r[0] for r in windows.select("k").distinct().collect())  # at most SHINGLE numbers
    every = bitmap(windows.select(F.explode("shingles").alias("hash")).distinct())
    counts = staged(shingle_counts(docs.select("text"), every, widths), "rarity")
    every.unpersist()
    able = staged(prefixes(windows, counts), "prefixes")
    chosen = bitmap(able.select("hash").distinct())
    rows = staged(candidates(docs, chosen, widths), "candidates")
    chosen.unpersist()

    places = rows.where(F.size("found") > 0).select("row", "n_words", F.inline("found"))
    span = F.struct("first", "last")
    hits = staged(
        verified(places, able)
        .groupBy("row")
        .agg(F.array_sort(F.collect_set(span)).alias("spans"), F.array_sort(F.collect_set("class")).alias("classes"))
        .select("row", covered(F.col("spans")).alias("n_hit"), "classes", F.sha2(F.concat_ws(",", F.col("classes").cast("array<string>")), 256).alias("set")),
        "hits",
    )
    # the items of each distinct set of classes, once
    sets = hits.groupBy("set").agg(F.first("classes").alias("classes")).select("set", F.explode("classes").alias("class"))
    listed = staged(
        sets.join(class_items, "class")
        .groupBy("set")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select("set", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")),
        "item-sets",
    )
    held = hits.select("row", "n_hit", "set").join(listed, "set").drop("set")
    none, columns = F.lit(0).cast("long"), ["id", "n_words", "n_hit", "n_items", "items_sha256"]
    clean = rows.where(F.size("found") == 0).select(
        "id", "n_words", none.alias("n_hit"), none.alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256")
    )
    rest = rows.where(F.size("found") > 0).select("row", "id", "n_words").join(held, "row", "left").select(
        "id", "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
    )
    return clean.select(columns).unionByName(rest.select(columns)).select(
        F.col("id").alias(id), "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated")
    )
