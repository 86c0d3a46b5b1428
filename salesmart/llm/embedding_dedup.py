"""Near-duplicate embeddings by cross-polytope hashing.

Vectors are compared within equal labels by cosine in double precision.  Equal
vectors are first put together as one class, so copies are never compared.
For each of ``TABLES`` tables a vector takes ``HASHES`` pseudo-random rotations
(three rounds of random signs and a fast Hadamard transform); the closest
vertex of the cross-polytope, a signed axis, is one hash.  A vector lives in
its own bucket of each table and also visits the ``PROBES`` next best ones.
Vectors that meet in a bucket are compared, and only verified pairs count.

Buckets are dealt in cells of bounded size.  A cell hands back, for each of its
vectors, the number of links first met there and one edge of a spanning forest,
never its pairs.  A pair that meets again elsewhere is recognised by its codes,
which are computed from the vectors, so each link counts once.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components, or whose label is null, links with nothing; vectors of different
lengths never link; equal vectors link with each other; repeated rows (same id)
count like any other vector; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import components

TABLES = 3
HASHES = 2
PROBES = 4
#: Vectors at home in a cell that the layout aims at.
CELL = 2048
SEED = 7


class CrossPolytope:
    """Bucket codes of vectors of one length."""

    def __init__(self, length: int):
        self.length = length
        self.width = 1 << max(0, length - 1).bit_length()
        rng = np.random.default_rng([SEED, self.width])
        self.signs = rng.choice([-1.0, 1.0], (TABLES, HASHES, 3, self.width))

    def _rotated(self, vectors: np.ndarray, signs: np.ndarray) -> np.ndarray:
        x = vectors
        for row in signs:
            x = x * row
            step = 1
            while step < self.width:
                y = x.reshape(len(x), -1, 2, step)
                x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), -1)
                step *= 2
        return x

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(vector, table, 1 + PROBES): the own bucket, then the probed ones."""
        n = len(unit)
        padded = np.zeros((n, self.width))
        padded[:, : self.length] = unit
        options = min(3, 2 * self.width)
        out = np.empty((n, TABLES, 1 + PROBES), np.int64)
        # choices for each hash (0: best vertex); the sets of one and two changes, tried by their loss
        grid = np.array([p for p in np.ndindex(*[options] * HASHES) if sum(x > 0 for x in p) and sum(p) <= 3])
        for t in range(TABLES):
            vertex = np.empty((n, HASHES, options), np.int64)
            loss = np.empty((n, HASHES, options))
            for j in range(HASHES):
                y = self._rotated(padded, self.signs[t, j])
                size = np.abs(y)
                top = np.argsort(-size, axis=1, kind="stable")[:, :options]
                top = top[:, np.arange(options) % top.shape[1]]  # short vectors have fewer axes
                side = (np.take_along_axis(y, top, axis=1) < 0).astype(np.int64)
                vertex[:, j] = 2 * top + side
                best = np.take_along_axis(size, top, axis=1)
                loss[:, j] = best[:, :1] - best
            base = (2 * self.width) ** np.arange(HASHES)
            out[:, t, 0] = (vertex[:, :, 0] * base).sum(axis=1)
            each = sum(loss[:, j][:, grid[:, j]] for j in range(HASHES))
            chosen = np.argsort(each, axis=1, kind="stable")[:, :PROBES]
            probe = sum(vertex[:, j][np.arange(n)[:, None], grid[chosen, j]] * base[j] for j in range(HASHES))
            out[:, t, 1 : 1 + probe.shape[1]] = probe
            out[:, t, 1 + probe.shape[1] :] = out[:, t, :1]
        return out


_hashers: dict[int, CrossPolytope] = {}


def hasher(length: int) -> CrossPolytope:
    if length not in _hashers:
        _hashers[length] = CrossPolytope(length)
    return _hashers[length]


def _unit(vectors) -> np.ndarray:
    """The vectors in double precision, divided by their lengths."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _met(codes_i: np.ndarray, codes_j: np.ndarray) -> np.ndarray:
    """For each pair and table: whether the two share a bucket in which one of them is at home."""
    a, b = codes_i[:, :, :1], codes_j[:, :, :1]
    return (a == codes_j).any(axis=2) | (b == codes_i).any(axis=2)


def cell_links(
    table: int, ids: np.ndarray, vectors, home: np.ndarray, asks: np.ndarray, copies: np.ndarray, least: float, among: bool
):
    """(ids, links, roots) of the vectors of one cell that have a link first met there.

    Asking rows are at home in the bucket.  They are compared with all rows
    that don't ask and, if ``among``, with each other.
    """
    unit = _unit(vectors)
    askers = np.flatnonzero(asks)
    pairs = []
    for at in range(0, len(askers), 512):
        some = askers[at : at + 512]
        i, j = np.nonzero(unit[some] @ unit.T >= least - 1e-9)
        i = some[i]
        keep = ~asks[j] | (among & (ids[i] < ids[j]))
        pairs.append(np.stack((i[keep], j[keep])))
    i, j = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), int)
    if len(i):
        # the sum below is of the same products in the same order for every pair
        exact = (unit[i] * unit[j]).sum(axis=1) >= least
        i, j = i[exact & (ids[i] != ids[j])], j[exact & (ids[i] != ids[j])]
    if not len(i):
        return None
    used, place = np.unique(np.concatenate((i, j)), return_inverse=True)
    codes = hasher(unit.shape[1]).codes(unit[used])
    ci, cj = codes[place[: len(i)]], codes[place[len(i) :]]
    fresh = ~_met(ci, cj)[:, :table].any(axis=1)
    # a visitor at whose home the other one visits too: the home of the smaller id counts
    both = ~home[j] & (cj[:, table, :1] == ci[:, table]).any(axis=1)
    fresh &= ~(both & (ids[j] < ids[i]))
    i, j = i[fresh], j[fresh]
    if not len(i):
        return None
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    root = np.arange(len(ids))
    for a, b in zip(i.tolist(), j.tolist()):
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        root[max(a, b)] = min(a, b)
    for a in range(len(root)):
        root[a] = root[root[a]]
    some = np.flatnonzero(links)
    return ids[some], links[some], ids[root[some]]


def class_links(classes: DataFrame, least: float) -> DataFrame:
    """(a, links, b): parts of the link counts of classes, and edges that connect linked ones.

    ``classes`` has rep, label, vector and copies and should be a stored table.
    """

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["vector"].map(len).to_numpy()
            for length in np.unique(sizes):
                part = batch[sizes == length]
                codes = hasher(int(length)).codes(_unit(part["vector"]))
                for t in range(TABLES):
                    for p in range(1 + PROBES):
                        out = part.assign(len=np.int32(length), t=np.int32(t), bucket=codes[:, t, p], home=p == 0)
                        again = (codes[:, t, :p] == codes[:, t, p : p + 1]).any(axis=1)
                        yield out[names][~again]

    names = ["rep", "label", "len", "t", "bucket", "home", "vector", "copies"]
    kind = dict(classes.dtypes)
    visits = classes.mapInPandas(
        visit,
        f"rep long, label {kind['label']}, len int, t int, bucket long, home boolean, vector {kind['vector']}, copies long",
    )
    visits = staged(visits, "visits")
    key = ["label", "len", "t", "bucket"]
    sides = visits.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.count_if("home").alias("homes"))
    # buckets with more rows than a cell; the others are one cell
    large = staged(
        sides.where((F.col("n") > 4 * CELL) & (F.col("homes") > 0)).select(*key, F.ceil(F.col("n") / CELL).cast("int").alias("k")),
        "large-buckets",
    )
    # a bucket in which none is at home, or only one vector, has no pairs
    paired = staged(sides.where("homes > 0 and n > 1").select(*key), "buckets")
    dealt = (
        visits.join(paired, key, "left_semi")
        .join(large, key, "left")
        .withColumn("k", F.coalesce("k", F.lit(1)))
        .withColumn("c", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("k")).cast("int"))
    )
    every = F.sequence(F.lit(0), F.col("k") - 1)
    columns = ["x", "y", "asks", *names]
    asking = dealt.where("home").withColumn("x", F.col("c")).withColumn("y", F.explode(every)).withColumn("asks", F.lit(True))
    asked = (
        dealt.withColumn("y", F.col("c")).withColumn("x", F.explode(every)).where("not home or x < c").withColumn("asks", F.lit(False))
    )
    cells = asking.select(columns).unionByName(asked.select(columns))
    sort = [*key, "x", "y"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in whole_runs(batches, sort):
            asks = cell["asks"].to_numpy(bool)
            if len(cell) < 2 or not asks.any():
                continue
            among = bool(cell["x"].iat[0] == cell["y"].iat[0])
            if asks.all() and not among:
                continue
            found = cell_links(
                int(cell["t"].iat[0]), cell["rep"].to_numpy(np.int64), cell["vector"], cell["home"].to_numpy(bool),
                asks, cell["copies"].to_numpy(np.int64), least, among,
            )
            if found is not None:
                yield pd.DataFrame(dict(zip("a links b".split(), found)))

    return cells.repartition(*sort).sortWithinPartitions(*sort).mapInPandas(compare, "a long, links long, b long")


def whole_runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The runs of rows with equal keys, across the borders of batches."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        keys = batch[key]
        starts = np.flatnonzero((keys != keys.shift()).any(axis=1).to_numpy())
        for a, b in zip(starts, starts[1:]):
            if b - a > 1:
                yield batch.iloc[a:b]
        rest = batch.iloc[starts[-1] :] if len(starts) else None
    if rest is not None and len(rest) > 1:
        yield rest


def embedding_dedup(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98
) -> DataFrame:
    """One row for each row of ``vectors``: the id, n_links, component_id and kept."""
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & ~bad & some, F.lit(False))
    # 128 bits stand for label and vector
    keyed = rows.withColumns(
        {"usable": usable, "h1": F.xxhash64(F.lit(1), "label", "vector"), "h2": F.xxhash64(F.lit(2), "label", "vector")}
    )
    members = staged(keyed.select("id", "usable", "h1", "h2"), "members")
    classes = staged(
        keyed.where("usable")
        .groupBy("h1", "h2")
        .agg(
            F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"), F.first("label").alias("label")
        )
        .withColumn("rep", F.monotonically_increasing_id()),
        "classes",
    )
    found = staged(class_links(classes.select("rep", "label", "vector", "copies"), least), "links")
    counts = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "rep")
    roots = staged(components(found.select("a", "b")), "roots")
    named = roots.withColumnRenamed("node", "rep").join(classes.select("rep", "first"), "rep")
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    places = roots.join(smallest, "root").select(F.col("node").alias("rep"), "component")
    settled = staged(
        classes.select("h1", "h2", "rep", "first", "copies")
        .join(counts, "rep", "left")
        .join(places, "rep", "left")
        .select(
            "h1",
            "h2",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
        ),
        "settled",
    )
    # both sides are stored, so Spark can split the members of a hot class
    linked = members.where("usable").join(settled, ["h1", "h2"]).select("id", "n_links", "component_id")
    alone = members.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
