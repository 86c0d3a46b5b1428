"""SimHash near-duplicates through a sharded vantage-point tree.

Fingerprint: A-Z are lower-cased, words are runs without ASCII white space, a
shingle is ``width`` words joined by a space (a shorter text is one shingle),
its hash is XXH64 with seed 42, and a bit is 1 when it is set in over half of
the shingles, repeats included.  A text without words has fingerprint 0.

Search: every distinct fingerprint is compared through a vantage-point tree in
the Hamming metric.  The tree is fitted on a bounded sample (``SAMPLE_PER_LEAF``
fingerprints a leaf, at most ``MAX_LEAVES`` leaves) and only says where to
look, so its choice changes the cost, never the result.  A fingerprint has one
home leaf and is also sent, as a query, to each leaf that the triangle bounds
cannot rule out.  A pair whose homes part at some node is found from its inner
member alone, so only that one crosses.  Leaves are compared in cells of
bounded size, and each cell hands back a spanning forest of its links instead
of all pairs; components of these edges are components of all links.

Defined cases: null, empty and blank texts share fingerprint 0 and link like
any other; repeated rows share one fingerprint; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, ship, staged
from .components import components

SEED = 42
#: Fingerprints of a leaf that the layout aims at, and the most of a cell's side.
LEAF = 2048
CELL = 1 << 17
MAX_LEAVES = 4096
SAMPLE_PER_LEAF = 32
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: bytes | None, width: int) -> int:
    """The 64-bit fingerprint as a signed integer."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[width - 1 :].tolist() or [len(line)]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(ends), BLOCK):
        part = ends[at : at + BLOCK]
        hashes = np.fromiter(
            (digest(line[s:e], SEED) for s, e in zip(starts[at:], part)), np.uint64, len(part)
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(ones * 2 > len(ends), bitorder="little").view(np.int64)
    return int(value[0])


def with_fingerprint(docs: DataFrame, text: str, width: int, name: str) -> DataFrame:
    """``docs`` with its fingerprint (long) in column ``name``; no shuffle."""

    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(x, width) for x in batch], dtype="int64")

    return docs.withColumn(name, prints(F.col(text).cast("binary")))


class VantageTree:
    """Nodes are (vantage, radius, inside, outside); a leaf is its number."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.leaves = 0
        self._rng = np.random.default_rng(SEED)
        self.root = self._grow(np.unique(sample).view(np.uint64), leaves)

    def _grow(self, points: np.ndarray, leaves: int):
        best = None
        if leaves > 1 and len(points) > 3:
            for vantage in self._rng.choice(points, min(8, len(points)), replace=False):
                distance = np.bitwise_count(points ^ vantage).astype(np.int64)
                if best is None or distance.std() > best[2].std():
                    best = vantage, int(np.median(distance)), distance
            vantage, radius, distance = best
            if distance.max() == radius:
                radius -= 1
            inside = distance <= radius
            if 0 < inside.sum() < len(points):
                share = max(1, min(leaves - 1, round(leaves * inside.mean())))
                return vantage, radius, self._grow(points[inside], share), self._grow(points[~inside], leaves - share)
        self.leaves += 1
        return self.leaves - 1

    def route(self, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, positions in points, whether at home there) of all visits."""
        points = points.view(np.uint64)  # bits of a negative number would be counted of its absolute value
        todo = [(self.root, np.arange(len(points)), np.ones(len(points), bool))]
        while todo:
            node, at, home = todo.pop()
            if not len(at):
                continue
            if isinstance(node, int):
                yield node, at, home
                continue
            vantage, radius, inner, outer = node
            distance = np.bitwise_count(points[at] ^ vantage).astype(np.int64)
            inside = distance <= radius
            # a visitor follows the triangle bounds; a home row goes to its own side, and
            # from the inner side it also visits the outer one when the bound allows a partner
            goes_in = inside | (~home & (distance - reach <= radius))
            goes_out = ~inside | (distance + reach > radius)
            todo.append((inner, at[goes_in], home[goes_in]))
            todo.append((outer, at[goes_out], (home & ~inside)[goes_out]))


def cell_forest(points: np.ndarray, asks: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links between the asking rows and all rows of a cell."""
    root = np.arange(len(points))
    points = points.view(np.uint64)
    for i in np.flatnonzero(asks):
        near = np.flatnonzero(np.bitwise_count(points ^ points[i]) <= reach)
        if len(near) > 1:
            own = root[i]
            for other in np.unique(root[near]):
                if other != own:
                    root[root == other] = own
    moved = np.flatnonzero(root != np.arange(len(points)))
    points = points.view(np.int64)
    return points[moved], points[root[moved]]


def fingerprint_links(prints: DataFrame, reach: int, column: str = "fp") -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints linked within ``reach`` bits.

    ``prints`` has distinct fingerprints and is best a stored table.
    """
    spark = prints.sparkSession
    ship(spark)
    total = prints.count()
    leaves = max(1, min(MAX_LEAVES, -(-total // LEAF)))
    every = max(1, total // (leaves * SAMPLE_PER_LEAF))
    sample = prints.where(F.pmod(F.xxhash64(column), F.lit(every)) == 0).limit(2 * MAX_LEAVES * SAMPLE_PER_LEAF)
    tree = VantageTree(np.array([r[0] for r in sample.collect()], np.int64), leaves)
    shared = spark.sparkContext.broadcast(tree)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch[column].to_numpy(np.int64)
            for leaf, at, home in shared.value.route(points, reach):
                yield pd.DataFrame({"leaf": np.int32(leaf), "fp": points[at], "home": home})

    visits = staged(prints.select(column).mapInPandas(visit, "leaf int, fp long, home boolean"), "visits")
    # at most MAX_LEAVES rows: how many cells a side each leaf needs
    sides = visits.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL)).cast("int").alias("k"))
    placed = visits.join(F.broadcast(sides), "leaf").withColumn(
        "c", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("k")).cast("int")
    )
    every_chunk = F.sequence(F.lit(0), F.col("k") - 1)
    # cell (x, y): home rows of chunk x ask rows of chunk y; home meets home once, for x <= y
    as_asking = placed.where("home").withColumn("y", F.explode(every_chunk)).selectExpr(
        "leaf", "c as x", "y", "fp", "true as asks"
    )
    as_asked = (
        placed.withColumn("x", F.explode(every_chunk))
        .where("(not home) or x < c")
        .selectExpr("leaf", "x", "c as y", "fp", "false as asks")
    )

    def compare(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        a, b = cell_forest(cell["fp"].to_numpy(np.int64), cell["asks"].to_numpy(bool), reach)
        return pd.DataFrame({"a": a, "b": b})

    return as_asking.unionByName(as_asked).groupBy("leaf", "x", "y").applyInPandas(compare, "a long, b long")


def groups(prints: DataFrame, reach: int, id: str = "doc_id", column: str = "fp") -> DataFrame:
    """(fp, component_id, root): for each fingerprint the smallest id that its links reach, and the group it is in.

    ``prints`` has one row a document and should be a stored table.
    """
    distinct = staged(prints.groupBy(column).agg(F.min(id).alias("first")), "fingerprints")
    roots = staged(components(fingerprint_links(distinct, reach, column)), "roots")
    linked = distinct.join(roots.withColumnRenamed("node", column), column)
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    moved = roots.join(smallest, "root").select(F.col("node").alias(column), "component_id", "root")
    return distinct.join(moved, column, "left").select(
        column, F.coalesce("component_id", "first").alias("component_id"), F.coalesce("root", column).alias("root")
    )


def _found(docs: DataFrame, id: str, text: str, width: int, reach: int) -> DataFrame:
    """(id, fp, component_id, root) of each row."""
    prints = staged(
        with_fingerprint(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "text", width, "fp").select("id", "fp"),
        "prints",
    )
    # both sides are stored, so Spark can split a hot fingerprint in this join
    return prints.join(staged(groups(prints, reach, "id"), "groups"), "fp").select("id", "fp", "component_id", "root")


def simhash_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, reach: int = 2) -> DataFrame:
    """One row for each row of ``docs``: the id, ``fp`` (long) and component_id."""
    return _found(docs, id, text, width, reach).select(F.col("id").alias(id), "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, reach: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group the one with the smallest id.

    Where several rows have the same id, each is judged by its own text: it stays
    with its group, or goes with it.  If the smallest id of a group stands in
    several of its rows, one of them stays.
    """
    found = staged(_found(docs, id, text, width, reach), "groups")
    stays = F.col("id").eqNullSafe(F.col("component_id"))
    key, fp = fresh(docs, "id", "fp")
    twice = staged(found.groupBy("id").count().where("count > 1").select(F.col("id").alias(key)), "twice")
    gone = staged(found.where(~stays).select(F.col("id").alias(key)).distinct(), "gone")

    def same(rows: DataFrame, other: DataFrame) -> Column:
        return rows[id].eqNullSafe(other[key])

    # rows whose id is their own are told by it, so no text is read again for them
    alone = docs.join(twice, same(docs, twice), "left_anti")
    alone = alone.join(gone, same(alone, gone), "left_anti")
    several = with_fingerprint(docs.join(twice, same(docs, twice), "left_semi"), text, width, fp)
    first = staged(
        found.where(stays).groupBy("id", "root").agg(F.min("fp").alias("fp")).select(F.col("id").alias(key), F.col("fp").alias("print")),
        "first",
    )
    chosen = several.join(first, same(several, first) & (several[fp] == first["print"]), "left_semi").dropDuplicates([id, fp])
    return alone.select(docs.columns).unionByName(chosen.select(docs.columns))
